"""Near-duplicate embeddings by a forest of random-projection trees with spill.

Equal vectors are merged first. Each tree splits each label's vectors at the median of a
random projection, level by level; vectors close to a split go to both sides, so a near pair
is parted only if its projections lie far apart. Vectors meet in leaves; a leaf larger than a
cell is compared as a grid of cells, so no task holds a whole crowded leaf. Every vector
knows its leaves in all trees, and a pair counts in the first leaf that both share only, so
counts are exact without a list of pairs. Cells yield counts and spanning edges.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sigweave.llm.common import components, stored

TREES = 4
LEAF_ROWS = 1024
CELL_ROWS = 2048
# Documented bound of the vectors that the splits are fitted on, over all labels.
SAMPLE_ROWS = 65_536
SAMPLE_LEAF = 16
# Half the spill, in units of the largest distance of linked unit vectors per root dimension.
SPILL = 1.5
SEED = 11


class Forest:
    """Splits of every tree and label, fitted on a sample of unit vectors."""

    def __init__(self, similarity: float, seed: int = SEED):
        self.reach = math.sqrt(max(0.0, 2 - 2 * similarity))
        self._seed = seed
        self.levels: dict[tuple, int] = {}
        self._bounds: dict[tuple, np.ndarray] = {}

    def axes(self, tree: int, dims: int) -> np.ndarray:
        rng = np.random.default_rng([self._seed, tree, dims])
        axes = rng.normal(size=(32, dims))
        return axes / np.linalg.norm(axes, axis=1, keepdims=True)

    def spill(self, dims: int) -> float:
        return SPILL * self.reach / math.sqrt(dims)

    def fit(self, label: tuple, unit: np.ndarray, rows: int) -> None:
        """Trees of a label of ``rows`` vectors from the sample ``unit``."""
        levels = 0
        while rows >> levels > LEAF_ROWS and len(unit) >> (levels + 1) >= SAMPLE_LEAF and levels < 32:
            levels += 1
        self.levels[label] = levels
        for tree in range(TREES):
            place = unit @ self.axes(tree, unit.shape[1])[: max(levels, 1)].T
            bounds = np.zeros(1 << (levels + 1))
            node = np.ones(len(unit), dtype=np.int64)
            for level in range(levels):
                for n in np.unique(node):
                    bounds[n] = np.median(place[node == n, level])
                node = 2 * node + (place[:, level] >= bounds[node])
            self._bounds[label, tree] = bounds

    def leaves(self, label: tuple, unit: np.ndarray) -> list[list[int]]:
        """The leaves of each unit vector over all trees, ascending."""
        levels, found = self.levels.get(label, 0), [[] for _ in unit]
        for tree in range(TREES):
            rows, node = np.arange(len(unit)), np.ones(len(unit), dtype=np.int64)
            bounds = self._bounds.get((label, tree))
            for level in range(levels):
                place = unit @ self.axes(tree, unit.shape[1])[level]
                gap = place[rows] - bounds[node]
                spill = self.spill(unit.shape[1])
                left, right = gap < spill, gap >= -spill
                rows = np.concatenate([rows[left], rows[right]])
                node = np.concatenate([2 * node[left], 2 * node[right] + 1])
            for r, n in zip(rows.tolist(), node.tolist(), strict=True):
                found[r].append((tree << 34) + n)
        return [sorted(x) for x in found]


def _units(values: np.ndarray) -> np.ndarray:
    # First by the largest component, so no square overflows or vanishes.
    values = values / np.abs(values).max(axis=1, keepdims=True)
    return values / np.linalg.norm(values, axis=1, keepdims=True)


def _vectors(column: pa.Array) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return flat.reshape(len(column), -1)


def usable(rows: DataFrame) -> DataFrame:
    """vec_id, label, embedding and whether the vector can link at all."""
    x = F.col("embedding")
    good = (
        F.col("label").isNotNull()
        & x.isNotNull()
        & F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
        & F.exists(x, lambda v: v != 0)
    )
    return rows.select(
        F.col("vec_id").cast("long"), F.col("label").cast("long"), F.col("embedding").cast("array<double>")
    ).withColumn("good", F.coalesce(good, F.lit(False)))


def near_duplicates(rows: DataFrame, similarity: float = 0.98) -> DataFrame:
    """vec_id, n_links, component_id and kept of every row of (vec_id, label, embedding).

    Vectors of one label link at a cosine of ``similarity`` or more. A null label, a null,
    empty or zero vector and one with a null or non-finite component link with nothing. Rows
    that repeat, also with the same vec_id, are rows like any others; a null vec_id names no
    component, and a component of such rows only has none. Ties need no
    rule: the smallest vec_id names the component. Vectors of another length never link.
    Other columns are not read; an empty table gives an empty result.
    """
    all_rows = usable(rows)
    dims = F.size("embedding")
    good = all_rows.filter("good").withColumn("h", F.xxhash64("label", "embedding"))
    distinct = stored(
        good.groupBy("h", "label", "embedding")
        .agg(F.min("vec_id").alias("first_id"), F.count("*").alias("copies"))
        # Rows with equal hashes but other vectors stay apart.
        .withColumn("node", F.expr("xxhash64(h, label, embedding)"))
        .withColumn("dims", dims),
        "vectors",
    )
    cells = _compared(distinct, similarity)
    linked = cells.filter("b IS NULL").groupBy("a").agg(F.sum("n").alias("n"))
    roots = components(cells.filter("b IS NOT NULL").select("a", "b"))
    rooted = (
        distinct.select("node", "h", "label", "embedding", "first_id", "copies")
        .join(linked, F.col("node") == F.col("a"), "left")
        .drop("a")
        .join(roots, "node", "left")
        .withColumn("root", F.coalesce("root", "node"))
    )
    named = rooted.groupBy("root").agg(F.min("first_id").alias("component_id"))
    by_vector = rooted.join(named, "root").select(
        "h",
        "label",
        "embedding",
        (F.col("copies") - 1 + F.coalesce("n", F.lit(0))).alias("n_links"),
        "component_id",
    )
    found = good.join(by_vector, ["h", "label", "embedding"]).select("vec_id", "n_links", "component_id")
    alone = all_rows.filter("NOT good").select(
        "vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id")
    )
    return found.union(alone).withColumn("kept", F.col("vec_id") == F.col("component_id"))


def _compared(distinct: DataFrame, similarity: float) -> DataFrame:
    """Link counts (a, null, n) and spanning edges (a, b, null) of distinct vectors."""
    forest = _fitted(distinct, similarity)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            labels = batch.column("label").to_numpy(zero_copy_only=False)
            sizes = batch.column("dims").to_numpy(zero_copy_only=False)
            leaves: list = [None] * batch.num_rows
            for label, size in {(a, b) for a, b in zip(labels.tolist(), sizes.tolist(), strict=True)}:
                chosen = np.flatnonzero((labels == label) & (sizes == size))
                unit = _units(_vectors(batch.column("embedding").take(pa.array(chosen))))
                for i, x in zip(chosen.tolist(), forest.leaves((label, size), unit), strict=True):
                    leaves[i] = x
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(leaves, pa.list_(pa.int64()))],
                [*batch.schema.names, "leaves"],
            )

    kinds = "node long, label long, dims int, copies long, embedding array<double>"
    placed = stored(
        distinct.select("node", "label", "dims", "copies", "embedding").mapInArrow(
            place, kinds + ", leaves array<long>"
        ),
        "leaves",
    )
    rows = placed.withColumn("leaf", F.explode("leaves"))
    sizes = rows.groupBy("label", "dims", "leaf").agg(
        F.ceil(F.count("*") / CELL_ROWS).alias("parts")
    )
    cells = (
        rows.join(sizes, ["label", "dims", "leaf"])
        .withColumn("mine", F.expr("pmod(xxhash64(node, leaf), parts)"))
        .withColumn("other", F.explode(F.expr("sequence(0L, parts - 1)")))
        .withColumn("i", F.least("mine", "other"))
        .withColumn("j", F.greatest("mine", "other"))
        .select("label", "dims", "leaf", "i", "j", "mine", "node", "copies", "embedding", "leaves")
    )

    def compare(table: pa.Table) -> pa.Table:
        return _cell(table, similarity)

    return cells.groupBy("label", "dims", "leaf", "i", "j").applyInArrow(
        compare, "a long, b long, n long"
    )


def _fitted(distinct: DataFrame, similarity: float) -> Forest:
    forest = Forest(similarity)
    sizes = distinct.groupBy("label", "dims").agg(F.count("*").alias("n")).filter(
        f"n > {LEAF_ROWS}"
    ).collect()
    total = sum(r.n for r in sizes)
    if not total:
        return forest
    share = min(1.0, SAMPLE_ROWS / total)
    sample = distinct.filter(f"pmod(xxhash64(node, 3), 1000000) < {share * 1_000_000:.0f}").select(
        "label", "dims", "embedding"
    )
    by_label: dict[tuple[int, int], list] = {}
    for r in sample.toLocalIterator():
        by_label.setdefault((r.label, r.dims), []).append(r.embedding)
    for r in sizes:
        key = (r.label, r.dims)
        if key in by_label:
            forest.fit(key, _units(np.array(by_label[key], dtype=np.float64)), r.n)
    return forest


def _cell(table: pa.Table, similarity: float) -> pa.Table:
    """Links between the two parts of a cell (or within its one part)."""
    table = table.combine_chunks()
    node = table["node"].to_numpy()
    copies, mine = table["copies"].to_numpy(), table["mine"].to_numpy()
    i, j, leaf = (table[c][0].as_py() for c in ("i", "j", "leaf"))
    unit = _units(_vectors(table["embedding"].combine_chunks()))
    # A pair counts here only if it shares no leaf before this one.
    shared = _earlier_leaves(table["leaves"].combine_chunks(), leaf)
    count, part, edges = np.zeros(len(node), dtype=np.int64), np.arange(len(node)), []
    left = np.flatnonzero(mine == i)
    right = left if i == j else np.flatnonzero(mine == j)
    for s in range(0, len(left), 512):
        rows = left[s : s + 512]
        close = unit[rows] @ unit[right].T >= similarity
        if i == j:
            close &= rows[:, None] < right[None, :]
        if not close.any():
            continue
        close &= shared[rows] @ shared[right].T == 0
        count[rows] += close @ copies[right]
        count[right] += copies[rows] @ close
        for n in np.flatnonzero(close.any(axis=1)).tolist():
            near, mate = right[close[n]], int(rows[n])
            other, at = np.unique(part[near], return_index=True)
            for o, x in zip(other.tolist(), near[at].tolist(), strict=True):
                if o != part[mate]:
                    part[part == o] = part[mate]
                    edges.append((mate, x))
    hit = np.flatnonzero(count)
    e = np.array(edges, dtype=np.int64).reshape(-1, 2)
    none = pa.nulls(len(hit), pa.int64())
    return pa.table(
        {
            "a": pa.array(np.concatenate([node[hit], node[e[:, 0]]])),
            "b": pa.concat_arrays([none, pa.array(node[e[:, 1]])]),
            "n": pa.concat_arrays([pa.array(count[hit]), pa.nulls(len(e), pa.int64())]),
        }
    )


def _earlier_leaves(leaves: pa.ListArray, leaf: int) -> np.ndarray:
    """Which of the leaves before ``leaf`` each row is in, as a 0/1 matrix."""
    flat = leaves.flatten().to_numpy()
    owner = np.repeat(np.arange(len(leaves)), np.diff(leaves.offsets.to_numpy()))
    early = flat < leaf
    names, column = np.unique(flat[early], return_inverse=True)
    matrix = np.zeros((len(leaves), len(names)), dtype=np.float32)
    matrix[owner[early], column] = 1
    return matrix
