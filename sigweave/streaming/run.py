"""Starting streams."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery


def trigger_options(interval_s: float | None) -> dict:
    """A micro-batch every ``interval_s`` seconds; all present data, then stop, if None."""
    if interval_s is None:
        return {"availableNow": True}
    return {"processingTime": f"{interval_s} seconds"}


def start_batches(
    df: DataFrame,
    checkpoint: str,
    handle: Callable[[DataFrame, int], None],
    interval_s: float | None = None,
) -> StreamingQuery:
    """Hands every micro-batch to ``handle``."""
    return (
        df.writeStream.foreachBatch(handle)
        .option("checkpointLocation", checkpoint)
        .trigger(**trigger_options(interval_s))
        .start()
    )


def run_to_table(df: DataFrame, checkpoint: str, path: str) -> DataFrame:
    """Processes all data present in the stream's source and reads the result back."""
    query = (
        df.writeStream.format("parquet")
        .option("checkpointLocation", checkpoint)
        .option("path", path)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return df.sparkSession.read.schema(df.schema).parquet(path)
