"""Clock and time-text functions.

The clock functions take an optional ``now`` in epoch milliseconds, so a result can be
repeated; without it they read Spark's query-constant clock.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The default pattern, the pattern of record and message times, and the
# pattern in which a parsed date is printed.
DEFAULT_FORMAT = "yyyy-MM-dd HH:mm:ss"
MESSAGE_TIME_FORMAT = "yyyyMMdd HH:mm:ss.SSS"
DATE_PRINT_FORMAT = "EEE MMM dd HH:mm:ss zzz yyyy"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def parse_time(c: Column | str, fmt: str, out_fmt: str = DATE_PRINT_FORMAT) -> Column:
    """Reads text with ``fmt`` and prints the moment with ``out_fmt``; null if unreadable."""
    return F.date_format(F.try_to_timestamp(_col(c), F.lit(fmt)), out_fmt)


def now_ms(now: int | None = None) -> Column:
    if now is not None:
        return F.lit(now).cast("long")
    return F.unix_millis(F.current_timestamp())


def now_minus(ms: Column | str | int, now: int | None = None) -> Column:
    return now_ms(now) - _offset(ms)


def now_plus(ms: Column | str | int, now: int | None = None) -> Column:
    return now_ms(now) + _offset(ms)


def _offset(ms: Column | str | int) -> Column:
    return (F.lit(ms) if isinstance(ms, int) else _col(ms)).cast("long")


def text_to_ms(c: Column | str, fmt: str = DEFAULT_FORMAT) -> Column:
    """Epoch milliseconds of a time text; null if unreadable."""
    return F.unix_millis(F.try_to_timestamp(_col(c), F.lit(fmt)))


def ms_to_text(c: Column | str, fmt: str = DEFAULT_FORMAT) -> Column:
    return F.date_format(F.timestamp_millis(_col(c).cast("long")), fmt)
