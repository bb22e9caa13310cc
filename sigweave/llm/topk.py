"""Exact top-k by inner product: columnar branch-and-bound over blocks.

Vectors are quantised to integers. Queries and candidates are packed into blocks, candidates
in vertical layout (one row per dimension). A cell is one query block against one candidate
block: scores accumulate a few dimensions at a time, the rest of a score is bounded by the
remaining mass of both vectors (Cauchy-Schwarz), and pairs whose bound stays below the
query's k-th best score so far are compacted away. Every cell yields its k best per query;
a window merges the cells.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

SCALE = 64
# Rows of a block: a cell holds one block of either side, whatever the table's size.
QUERY_ROWS = 4096
BLOCK_ROWS = 8192
DIM_BLOCK = 8
CHUNK = 128
_LONG = 2**63 - 1


def quantised(rows: DataFrame, scale: int = SCALE) -> DataFrame:
    """vec_id and q, the integers floor(scale * x); rows that take no part are left out.

    Left out: a null vec_id, a null or empty vector, one with a null or non-finite component.
    A value beyond 64 bits is held at their end.
    """
    x = F.col("embedding").cast("array<double>")
    good = F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    return (
        rows.select(F.col("vec_id").cast("long"), F.col("embedding"))
        .filter(F.col("vec_id").isNotNull() & F.col("embedding").isNotNull())
        .filter(good & (F.size("embedding") > 0))
        .select("vec_id", F.transform(x, lambda v: F.floor(v * float(scale)).cast("long")).alias("q"))
    )


def top_k(
    rows: DataFrame, queries: DataFrame, k: int = 20, scale: int = SCALE
) -> DataFrame:
    """The ``k`` rows with the highest score for every query: query_id, rank, vec_id, score.

    Both tables have vec_id and embedding. All rows but those with the query's own vec_id are
    candidates, a repeated row as often as it comes. A vec_id that several query rows share is
    asked once, with the smallest of its vectors. Ties go to the smaller vec_id; equal pairs
    of score and vec_id take neighbouring ranks. Vectors of another length are padded with
    zeros. Other columns are not read; without queries or candidates the result is empty.
    """
    packed = quantised(rows, scale)
    asked = quantised(queries, scale).groupBy("vec_id").agg(F.min("q").alias("q"))
    n_rows, n_asked = packed.count(), asked.count()
    r_blocks, q_blocks = -(-n_rows // BLOCK_ROWS) or 1, -(-n_asked // QUERY_ROWS) or 1
    left = _blocks(packed, r_blocks, "r").withColumn("c", F.explode(F.sequence(F.lit(0), F.lit(q_blocks - 1))))
    right = _blocks(asked, q_blocks, "c").withColumn("r", F.explode(F.sequence(F.lit(0), F.lit(r_blocks - 1))))
    right = right.select("r", "c", F.col("ids").alias("q_ids"), F.col("values").alias("q_values"), F.col("dims").alias("q_dims"))
    cells = left.join(right.hint("shuffle_hash"), ["r", "c"])

    def run(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in frames:
            for i in range(batch.num_rows):
                row = batch.slice(i, 1).to_pylist()[0]
                yield _cell(row, k)

    best = cells.mapInArrow(run, "query_id long, vec_id long, score long")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (
        best.withColumn("rank", F.row_number().over(order))
        .filter(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )


def _blocks(rows: DataFrame, blocks: int, name: str) -> DataFrame:
    """One row per block: ids and the values, one dimension after another."""

    def run(frame: pd.DataFrame) -> pd.DataFrame:
        dims = max(len(q) for q in frame["q"])
        values = np.zeros((dims, len(frame)), dtype=np.int64)
        for i, q in enumerate(frame["q"]):
            values[: len(q), i] = q
        small = np.abs(values).max(initial=0) < 2**15
        kind = "<i2" if small else "<i8"
        row = [frame["b"].iloc[0], frame["vec_id"].to_numpy("<i8").tobytes()]
        row += [values.astype(kind).tobytes(), dims if small else -dims]
        return pd.DataFrame([row], columns=[name, "ids", "values", "dims"])

    placed = rows.withColumn("b", F.expr(f"pmod(xxhash64(vec_id, q), {blocks})").cast("int"))
    return placed.groupBy("b").applyInPandas(run, f"{name} int, ids binary, values binary, dims int")


def _matrix(values: bytes, dims: int) -> np.ndarray:
    kind = "<i2" if dims > 0 else "<i8"
    return np.frombuffer(values, dtype=kind).reshape(abs(dims), -1)


def _cell(row: dict, k: int) -> pa.RecordBatch:
    r_ids, q_ids = (np.frombuffer(row[c], dtype="<i8") for c in ("ids", "q_ids"))
    right, left = _matrix(row["values"], row["dims"]), _matrix(row["q_values"], row["q_dims"]).T
    dims = max(len(right), left.shape[1])
    right = np.pad(right, ((0, dims - len(right)), (0, 0)))
    left = np.pad(left, ((0, 0), (0, dims - left.shape[1])))
    out = best_of(left, q_ids, right, r_ids, k)
    return pa.RecordBatch.from_arrays([pa.array(c) for c in out], ["query_id", "vec_id", "score"])


def best_of(
    left: np.ndarray, q_ids: np.ndarray, right: np.ndarray, r_ids: np.ndarray, k: int
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The k best candidates of each query of one cell; ``right`` is vertical (dims x rows)."""
    most = float(np.abs(left.astype(float)).max(initial=0)) * float(np.abs(right.astype(float)).max(initial=0))
    if most * len(right) >= 2**52:
        return _plain(left, q_ids, right, r_ids, k)
    # Heavy dimensions first: the remaining mass shrinks fastest.
    order = np.argsort(-(right.astype(float) ** 2).sum(axis=1), kind="stable")
    left, right = left[:, order].astype(np.float64), np.ascontiguousarray(right[order], dtype=np.float64)
    starts = list(range(0, len(right), DIM_BLOCK))
    l_rest = [np.sqrt((left[:, s:] ** 2).sum(axis=1)) for s in starts] + [np.zeros(len(left))]
    r_rest = [np.sqrt((right[s:] ** 2).sum(axis=0)) for s in starts] + [np.zeros(right.shape[1])]
    rows = np.ascontiguousarray(right.T)
    found = []
    for a in range(0, len(left), CHUNK):
        part, ids = left[a : a + CHUNK], q_ids[a : a + CHUNK]
        rest = [x[a : a + CHUNK] for x in l_rest]
        own = ids[:, None] == r_ids[None, :]
        # The first blocks for all pairs, until the bound leaves few of them.
        score = np.zeros((len(part), right.shape[1]))
        limit = np.full(len(part), -np.inf)
        alive, step = ~own, 0
        while step < len(starts):
            s = starts[step]
            score += part[:, s : s + DIM_BLOCK] @ right[s : s + DIM_BLOCK]
            step += 1
            if step == 2:
                limit = _seed(part, rows, score, own, k)
            if step >= 2:
                alive = ~own & (score + rest[step][:, None] * r_rest[step][None, :] >= limit[:, None] - 0.5)
                if alive.mean() < 0.2:
                    break
        q, c = np.nonzero(alive)
        value = score[q, c]
        for later in range(step, len(starts)):
            s = starts[later]
            value += np.einsum("ij,ij->i", part[q, s : s + DIM_BLOCK], rows[c, s : s + DIM_BLOCK])
            keep = value + rest[later + 1][q] * r_rest[later + 1][c] >= limit[q] - 0.5
            q, c, value = q[keep], c[keep], value[keep]
        found.append(_first(q, c, np.rint(value).astype(np.int64), ids, r_ids, k))
    if not found:
        return tuple(np.empty(0, dtype=np.int64) for _ in range(3))
    return tuple(np.concatenate(x) for x in zip(*found, strict=True))


def _seed(part, rows, score, own, k) -> np.ndarray:
    """A lower bound of each query's k-th best score: full scores of promising candidates."""
    width = rows.shape[0]
    take = min(width, 4 * k)
    hopeful = np.where(own, -np.inf, score)
    picked = np.argpartition(-hopeful, take - 1, axis=1)[:, :take]
    full = np.einsum("qd,qtd->qt", part, rows[picked])
    full[np.take_along_axis(own, picked, axis=1)] = -np.inf
    if take < k:
        return np.full(len(part), -np.inf)
    return np.partition(full, take - k, axis=1)[:, take - k]


def _first(q, c, value, ids, r_ids, k) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    order = np.lexsort((r_ids[c], -value, q))
    q, c, value = q[order], c[order], value[order]
    begins = np.searchsorted(q, np.arange(len(ids)))
    keep = np.arange(len(q)) - begins[q] < k
    return ids[q[keep]], r_ids[c[keep]], value[keep]


def _plain(left, q_ids, right, r_ids, k) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For integers too large for doubles: whole numbers without a limit, held at 64 bits."""
    found = []
    columns = [[int(v) for v in col] for col in right.T]
    for i, query in enumerate(left):
        line = [int(v) for v in query]
        scored = sorted(
            (-sum(x * y for x, y in zip(line, col, strict=True)), int(r))
            for col, r in zip(columns, r_ids, strict=True)
            if r != q_ids[i]
        )[:k]
        found += [(int(q_ids[i]), r, max(-_LONG - 1, min(_LONG, -s))) for s, r in scored]
    table = np.array(found, dtype=np.int64).reshape(-1, 3)
    return table[:, 0], table[:, 1], table[:, 2]
