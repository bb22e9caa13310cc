"""Join of two streams whose rows belong together within a time (2.9)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

_LEFT, _RIGHT = "_left_time", "_right_time"


def within(
    left: DataFrame,
    right: DataFrame,
    on: Sequence[str],
    left_time: str,
    right_time: str,
    *,
    after_ms: int,
    before_ms: int = 0,
    delay_ms: int = 0,
    how: str = "inner",
) -> DataFrame:
    """Pairs with equal ``on`` whose right time is in [left - ``before_ms``, left + ``after_ms``].

    Times are epoch milliseconds; apart from ``on`` the two sides have different column names.
    ``how`` is ``inner``, ``left_outer``, ``right_outer`` or ``full_outer``. On streams each
    side's rows may be late by ``delay_ms``; state is kept only as long as a partner can come,
    and a row without one comes out once none can come any more. Tables are joined alike.
    """
    sides = []
    for df, time, stamp in ((left, left_time, _LEFT), (right, right_time, _RIGHT)):
        timed = df.withColumn(stamp, F.timestamp_millis(F.col(time)))
        if df.isStreaming:
            timed = timed.withWatermark(stamp, f"{delay_ms} milliseconds")
        sides.append(timed)
    one, two = sides
    renamed = two.select(
        *[F.col(c).alias(f"_r_{c}") if c in on else F.col(c) for c in two.columns]
    )
    condition = F.expr(
        f"{_RIGHT} >= {_LEFT} - INTERVAL '{before_ms / 1000:.3f}' SECOND"
        f" AND {_RIGHT} <= {_LEFT} + INTERVAL '{after_ms / 1000:.3f}' SECOND"
    )
    for c in on:
        condition = condition & (F.col(c) == F.col(f"_r_{c}"))
    joined = one.join(renamed, condition, how)
    keys = [F.coalesce(F.col(c), F.col(f"_r_{c}")).alias(c) for c in on]
    rest = [c for c in [*left.columns, *right.columns] if c not in on]
    return joined.select(*keys, *rest)
