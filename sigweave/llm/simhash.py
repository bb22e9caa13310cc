"""Near-duplicates by SimHash fingerprints, pairs discarded by pivot distance tables.

A fingerprint takes the majority bit over the XXH64 values of a text's word shingles. Two
fingerprints link if at most ``bits`` bits differ. Equal fingerprints are merged first, so a
text copied a million times is one fingerprint from there on. Fingerprints meet in buckets
that two of six bit groups name (four differing bits leave two groups untouched, so the
buckets lose no link). Within a bucket the Hamming distances of every fingerprint to fixed
reference fingerprints form the pivot table; by the triangle inequality a pair whose
coordinates differ by more than ``bits`` anywhere cannot link and is discarded, and only
survivors are compared. A bucket yields the edges of a spanning forest, never all its pairs.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sigweave.llm.common import components, slices, stored, texts_of

SEED = 42
# Bit groups (first bit, width); pairs of them name the buckets.
GROUPS = [(0, 11), (11, 11), (22, 11), (33, 11), (44, 10), (54, 10)]
MOST_BITS = len(GROUPS) - 2
PIVOTS = np.array(
    [xxhash.xxh64_intdigest(b"pivot %d" % i, SEED) for i in range(16)], dtype=np.uint64
)
# Buckets over this size are compared as a grid of cells, each in a task of its own.
CELL_ROWS = 4096
SHORT_RUN = 32
_BIT = ((np.arange(256)[:, None] >> np.arange(8)[None, :]) & 1).astype(np.int64)
_LANES = (np.arange(8) * 256)[None, :]


def fingerprint(text: str | None, words: int = 4) -> int:
    """Unsigned 64-bit SimHash of a text; zero if it has no word."""
    joined = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not joined:
        return 0
    if len(joined) < words:
        hashes = [xxhash.xxh64_intdigest(b" ".join(joined), SEED)]
    else:
        ends = np.cumsum([len(w) + 1 for w in joined])
        starts = np.concatenate(([0], ends[:-1])).tolist()
        line, digest = b" ".join(joined), xxhash.xxh64_intdigest
        last = (ends - 1).tolist()[words - 1 :]
        hashes = [digest(line[s:e], SEED) for s, e in zip(starts, last, strict=False)]
    return fingerprint_of(np.array(hashes, dtype="<u8"))


def fingerprint_of(hashes: np.ndarray) -> int:
    """Majority bits of unsigned 64-bit hashes; zero if there are none."""
    lanes = hashes.astype("<u8").view(np.uint8).reshape(-1, 8)
    counts = np.bincount((lanes + _LANES).ravel(), minlength=2048).reshape(8, 256) @ _BIT
    bits = (counts * 2 > len(hashes)).astype(np.uint8)
    return int(np.packbits(bits.ravel(), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, words: int = 4) -> DataFrame:
    """doc_id and fingerprint (signed long) of every row; a null text counts as empty."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            found = [fingerprint(t, words) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(np.array(found, dtype=np.uint64).view(np.int64))],
                ["doc_id", "fp"],
            )

    source = texts_of(docs)
    return source.mapInArrow(run, "doc_id long, fp long")


def near_groups(prints: DataFrame, bits: int = 4) -> DataFrame:
    """component_id of every row of ``prints`` (doc_id, fp): columns doc_id, fp, component_id.

    component_id is the smallest doc_id reachable over links. Rows that repeat come out as
    often as they came in. A null doc_id keeps its row and links like any other, but names no
    component; a component of nulls only has a null component_id.
    """
    if not 0 <= bits <= MOST_BITS:
        raise ValueError(f"bits must lie between 0 and {MOST_BITS}")
    distinct = stored(prints.groupBy("fp").agg(F.min("doc_id").alias("first_id")), "prints")
    roots = components(links(distinct, bits))
    rooted = distinct.join(roots, F.col("fp") == F.col("node"), "left").select(
        "fp", "first_id", F.coalesce("root", "fp").alias("root")
    )
    named = rooted.groupBy("root").agg(F.min("first_id").alias("component_id"))
    by_print = rooted.join(named, "root").select("fp", "component_id")
    return prints.join(by_print, "fp").select("doc_id", "fp", "component_id")


def links(distinct: DataFrame, bits: int = 4) -> DataFrame:
    """Edges (a, b) between distinct fingerprints; their components are those of all links."""
    keyed = distinct.select("fp", F.explode(_bucket_keys()).alias("key"))
    # The sample finds crowded buckets and only decides how they are split, not what links.
    crowded = (
        distinct.filter("pmod(xxhash64(fp), 16) = 0")
        .select(F.explode(_bucket_keys()).alias("key"))
        .groupBy("key")
        .agg(F.ceil(F.count("*") * 16 / CELL_ROWS).alias("parts"))
        .filter("parts > 1")
    )
    cells = (
        keyed.join(crowded, "key", "left")
        .select(
            "key",
            "fp",
            F.coalesce("parts", F.lit(1)).alias("parts"),
            F.expr("pmod(xxhash64(fp, 7), coalesce(parts, 1))").alias("mine"),
        )
        .select("key", "fp", "mine", F.explode(F.expr("sequence(0L, parts - 1)")).alias("other"))
        .select("key", "fp", F.least("mine", "other").alias("i"), F.greatest("mine", "other").alias("j"))
        .select(F.expr("CASE WHEN j = 0 THEN key ELSE xxhash64(key, i, j) END").alias("cell"), "fp")
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = np.empty((2, 0), dtype=np.int64)
        for batch in batches:
            rows = np.stack([batch.column(c).to_numpy(zero_copy_only=False) for c in ("cell", "fp")])
            held = np.concatenate([held, rows], axis=1)
            if not held.shape[1]:
                continue
            end = int(np.searchsorted(held[0], held[0, -1]))
            if end:
                yield _edges(held[:, :end], bits)
                held = held[:, end:]
        if held.shape[1]:
            yield _edges(held, bits)

    return (
        cells.repartition("cell").sortWithinPartitions("cell").mapInArrow(run, "a long, b long")
    )


def _bucket_keys() -> Column:
    def part(first: int, width: int) -> str:
        return f"(shiftrightunsigned(fp, {first}) & {(1 << width) - 1}L)"

    keys = [
        f"{n}L * {1 << 22}L + {part(*a)} * {1 << 11}L + {part(*b)}"
        for n, (a, b) in enumerate(combinations(GROUPS, 2))
    ]
    return F.expr(f"array({', '.join(keys)})")


def _edges(rows: np.ndarray, bits: int) -> pa.RecordBatch:
    """Spanning edges of the whole runs of equal cell in ``rows`` (cells ascending)."""
    cell, prints = rows[0], rows[1].view(np.uint64)
    starts = np.flatnonzero(np.concatenate(([True], cell[1:] != cell[:-1])))
    sizes = np.diff(np.concatenate((starts, [len(cell)])))
    found = []
    short = np.repeat(sizes <= SHORT_RUN, sizes)
    if (sizes > 1).any():
        found.append(_short_runs(cell[short], prints[short], bits))
    for s, n in zip(starts[sizes > SHORT_RUN], sizes[sizes > SHORT_RUN], strict=True):
        found.append(_long_run(np.unique(prints[s : s + n]), bits))
    ends = np.concatenate(found, axis=1) if found else np.empty((2, 0), dtype=np.uint64)
    ends = ends.astype(np.uint64).view(np.int64)
    return pa.RecordBatch.from_arrays([pa.array(ends[0]), pa.array(ends[1])], ["a", "b"])


def pivot_table(prints: np.ndarray) -> np.ndarray:
    return np.bitwise_count(prints[:, None] ^ PIVOTS[None, :]).astype(np.int8)


def _survivors(table: np.ndarray, left: np.ndarray, right: np.ndarray, bits: int) -> np.ndarray:
    """Which pairs (left[k], right[k]) no pivot coordinate rules out."""
    kept = np.arange(len(left))
    for p in range(table.shape[1]):
        if not len(kept):
            break
        kept = kept[np.abs(table[left[kept], p] - table[right[kept], p]) <= bits]
    return kept


def _short_runs(cell: np.ndarray, prints: np.ndarray, bits: int) -> np.ndarray:
    table = pivot_table(prints)
    active, found, step = np.arange(len(cell)), [], 1
    while len(active):
        active = active[active + step < len(cell)]
        active = active[cell[active] == cell[active + step]]
        left = active[_survivors(table, active, active + step, bits)]
        near = left[np.bitwise_count(prints[left] ^ prints[left + step]) <= bits]
        found.append(np.stack([prints[near], prints[near + step]]))
        step += 1
    return np.concatenate(found, axis=1) if found else np.empty((2, 0), dtype=np.uint64)


def _long_run(prints: np.ndarray, bits: int) -> np.ndarray:
    """Forest over distinct fingerprints: leaders first, then leaders' groups against another.

    Every fingerprint ends within ``bits`` of a leader, so two linked ones have leaders at
    most 3 * bits apart; only such groups, if still apart, are compared member by member.
    """
    n = len(prints)
    table, leader, parent = pivot_table(prints), np.full(n, -1), list(range(n))

    def root(x: int) -> int:
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    found, everyone, leaders = [], np.arange(n), []
    for i in range(n):
        if leader[i] >= 0:
            continue
        leaders.append(i)
        near = _survivors(table, np.full(n, i), everyone, bits)
        near = near[np.bitwise_count(prints[near] ^ prints[i]) <= bits]
        leader[near[leader[near] < 0]] = i
        for x in near.tolist():
            a, b = root(i), root(x)
            if a != b:
                parent[b] = a
                found.append((i, x))
    heads = np.array(leaders)
    members = {int(h): np.flatnonzero(leader == h) for h in heads}
    for k, h in enumerate(leaders):
        rest = heads[k + 1 :]
        close = rest[np.bitwise_count(prints[rest] ^ prints[h]) <= 3 * bits]
        for g in close.tolist():
            if root(h) == root(g):
                continue
            for x in members[h]:
                hit = members[g][np.bitwise_count(prints[members[g]] ^ prints[x]) <= bits]
                if len(hit):
                    parent[root(g)] = root(h)
                    found.append((int(x), int(hit[0])))
                    break
    pairs = np.array(found, dtype=np.int64).reshape(-1, 2).T
    return prints[pairs]


def near_duplicates(docs: DataFrame, words: int = 4, bits: int = 4) -> DataFrame:
    """doc_id, fingerprint (16 hex digits) and component_id of every document.

    Null and empty texts and texts of white space only have fingerprint zero and link like
    any other. Ties need no rule: a component is named by its smallest doc_id. An empty table
    gives an empty result; other columns of ``docs`` are not read.
    """
    prints = stored(fingerprints(docs, words), "fingerprints")
    return near_groups(prints, bits).select(
        "doc_id",
        F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
        "component_id",
    )
