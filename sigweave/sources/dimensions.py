"""Dimension tables for the look-up rules."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def read_dimension(
    spark: SparkSession,
    kind: str,
    *,
    path: str | None = None,
    options: Mapping[str, str] | None = None,
    columns: Sequence[str] | None = None,
    key: Sequence[str] = (),
    prefix: str | None = None,
) -> DataFrame:
    """Reads a dimension table; only ``columns`` are read if given.

    For stores whose keys are one text ``prefix:part:part``, ``key`` names the parts and
    ``prefix`` selects the entries; the parts become columns.
    """
    reader = spark.read.options(**(options or {}))
    if kind == "jdbc":
        table = reader.format("jdbc").load()
    elif kind in ("parquet", "orc", "json", "csv"):
        table = reader.format(kind).load(path)
    else:
        raise ValueError(f"dimension kind {kind!r} is not supported")
    if prefix is not None:
        table = table.filter(F.col("key").startswith(f"{prefix}:"))
        parts = F.split("key", ":", len(key) + 1)
        table = table.select(
            "*", *[parts[i + 1].alias(name) for i, name in enumerate(key)]
        ).drop("key")
    return table.select(*columns) if columns else table
