"""Event rows as keyed text messages."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sigweave.functions.codes import java_string_hash
from sigweave.functions.times import MESSAGE_TIME_FORMAT, ms_to_text, now_ms


def _key(keys: Sequence[str]) -> Column:
    # The key is null, not "", if every part is null.
    parts = [F.col(k).cast("string") for k in keys]
    joined = F.concat_ws(",", *[F.coalesce(p, F.lit("")) for p in parts])
    return F.when(F.coalesce(*parts).isNotNull(), joined)


def keyed_message(
    df: DataFrame,
    keys: Sequence[str],
    columns: Sequence[str],
    *,
    delim: str = ",",
    topic: str | None = None,
    now: int | None = None,
    skip_nulls: bool = False,
) -> DataFrame:
    """(key, value[, topic]): the columns and the emission time joined by ``delim``.

    A null column keeps its position as an empty text unless ``skip_nulls`` is set.
    """
    parts = [F.col(c).cast("string") for c in columns]
    if not skip_nulls:
        parts = [F.coalesce(p, F.lit("")) for p in parts]
    stamp = ms_to_text(now_ms(now), MESSAGE_TIME_FORMAT)
    key = _key(keys) if keys else F.lit(None).cast("string")
    message = [key.alias("key"), F.concat_ws(delim, *parts, stamp).alias("value")]
    if topic is not None:
        message.append(F.lit(topic).alias("topic"))
    return df.select(*message)


def all_columns_message(
    df: DataFrame,
    key_column: str | None,
    *,
    delim: str = ",",
    topic: str | None = None,
    now: int | None = None,
) -> DataFrame:
    """Message of all columns in order, keyed by one of them; no key if it is absent."""
    keys = [key_column] if key_column in df.columns else []
    return keyed_message(df, keys, df.columns, delim=delim, topic=topic, now=now)


def key_partition(df: DataFrame, n: int, *, key: str = "key", value: str = "value") -> DataFrame:
    """Adds the target ``partition`` of a message among ``n``.

    It follows the absolute JVM hash of the key. Messages without a key are spread by the
    hash of their text.
    """
    by_key = F.abs(java_string_hash(key)) % n
    spread = F.pmod(F.xxhash64(value), F.lit(n))
    return df.withColumn(
        "partition", F.when(F.col(key).isNotNull(), by_key).otherwise(spread).cast("int")
    )
