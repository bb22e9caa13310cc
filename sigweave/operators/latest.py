"""One row per key (K5, K6, K8)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def latest_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The key's last row by ``order``.

    Spark keeps at most one row per key on the map side before the shuffle
    (``WindowGroupLimit``), so a hot key sends one row per map task.
    """
    window = Window.partitionBy(*keys).orderBy(*[F.col(c).desc() for c in order])
    return (
        df.withColumn("_rank", F.row_number().over(window))
        .filter(F.col("_rank") == 1)
        .drop("_rank")
    )


def merge_latest(
    table: DataFrame | None, rows: DataFrame, keys: Sequence[str], order: Sequence[str]
) -> DataFrame:
    """Latest-row table after ``rows`` were put in; a later row replaces an earlier one."""
    if table is None:
        return latest_per_key(rows, keys, order)
    return latest_per_key(table.unionByName(rows), keys, order)


def greatest_payload(df: DataFrame, keys: Sequence[str], payload: str = "value") -> DataFrame:
    """The greatest payload of a key in text order; partial maxima are taken map-side."""
    return df.groupBy(*keys).agg(F.max(payload).alias(payload))
