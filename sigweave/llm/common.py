"""What several operators share: tables between steps, text batches, connected components."""

from __future__ import annotations

import ctypes
import gc
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from sigweave.session import run_dir

# A task handles its texts in slices of about this many bytes, however long a batch is.
SLICE_BYTES = 4 << 20
# Larger ones where the work goes by different words, as larger slices repeat more.
WORD_SLICE_BYTES = 6 << 20
ROW_GROUP_BYTES = 32 << 20


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written below the shared folder and read again: lineage ends here.

    Unlike a cached table it survives lost executors, and later steps read only the columns
    that they use.
    """
    path = run_dir(df.sparkSession, name)
    # A task buffers a row group: small ones, as texts and ids fill them up.
    df.write.option("parquet.block.size", ROW_GROUP_BYTES).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def texts_of(docs: DataFrame, *more: Column) -> DataFrame:
    """doc_id, text and ``more`` of ``docs``; ``session.prepare`` bounds a batch for Python."""
    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"), *more)


def slices(
    batches: Iterator[pa.RecordBatch], column: str, size: int | None = None
) -> Iterator[pa.RecordBatch]:
    """Arrow batches cut so that ``column`` holds at most about ``size`` bytes in each.

    With a ``size`` given, small batches are first put together up to it.
    """
    # Code travels with the tasks and refers to itself, so what the task before held (words of an
    # encoder, tables of bits) stays until it is looked for.
    gc.collect()
    give_back()
    for batch in batches if size is None else _together(batches, column, size):
        if not batch.num_rows:
            continue
        mean = max(1, batch.column(column).nbytes // batch.num_rows)
        step = max(1, (size or SLICE_BYTES) // mean)
        for start in range(0, batch.num_rows, step):
            yield batch.slice(start, step)
    give_back()


def give_back() -> None:
    """Free memory goes back to the machine: a worker waits for its next task for a long time, and
    the driver for its next step."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)


def _together(
    batches: Iterator[pa.RecordBatch], column: str, size: int
) -> Iterator[pa.RecordBatch]:
    held, total = [], 0
    for batch in batches:
        more = batch.column(column).nbytes
        if held and total + more > size:
            yield pa.concat_batches(held)
            held, total = [], 0
        held.append(batch)
        total += more
    if held:
        yield pa.concat_batches(held)


def last_place(rows: int, n: int) -> int:
    """Greatest of the 64-bit hashes (signed) that draws about ``rows`` of ``n`` different ones."""
    return min((1 << 64) * rows // n, 1 << 64) - 1 - (1 << 63)


def components(edges: DataFrame) -> DataFrame:
    """Root (smallest node) of every node that has an edge: columns node, root.

    ``edges`` has the long columns a and b. Alternating large-star and small-star steps keep
    the edges a set of at most the input's size and need about log(n) rounds; each round is
    joins and grouped minima, so a node with a third of all edges is combined map-side and
    its join is split by adaptive execution.
    """
    edges, before = _stored_edges(
        edges.filter("a <> b").select(
            F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")
        ).distinct()
    )
    while before["n"]:
        edges, after = _stored_edges(_small_star(_large_star(edges)))
        if after == before:
            break
        before = after
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root"))


def _stored_edges(edges: DataFrame) -> tuple[DataFrame, dict]:
    """``edges`` stored, and a digest of them that the same query gathers as it writes."""
    digest = Observation()
    seen = edges.observe(
        digest,
        F.count("*").alias("n"),
        F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("total"),
        F.bit_xor(F.xxhash64("b", "a")).alias("mixed"),
    )
    return stored(seen, "edges"), digest.get


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
    return (
        both.filter("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    ).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    least = edges.groupBy("a").agg(F.min("b").alias("m"))
    moved = (
        edges.join(least, "a")
        .filter("b <> m")
        .select(F.col("b").alias("a"), F.col("m").alias("b"))
    )
    return moved.union(least.select("a", F.col("m").alias("b"))).distinct()
