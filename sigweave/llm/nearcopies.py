"""Near copies by shared word shingles: SimHash and an exact prefix filter name candidates, whole
sets decide.

A text is the set of its shingles (``WORDS`` words, A-Z in lower case). Texts with the same words
are one node. Two nodes link if their sets have a Jaccard similarity of ``SIMILARITY`` or more.

SimHash comes first, as in ``simhash``: fingerprints of the shingles meet in buckets, pivot
distance tables discard pairs, and those at ``BITS`` or fewer differing bits are compared. That
finds some of the links; the prefix filter finds the rest and is what no link escapes.

All shingles have one order, rare ones first (by a sketch of how often each occurs; ties by
hash). If n - ceil(0.8 n) + 1 shingles of each set are taken in that order, two sets that are
similar have one of them in common; so only nodes that share such a key are compared, and none
is missed whatever the sketch says. A passage that many texts share is frequent, so it is no
key of texts that have enough words of their own. Lengths, and what the places of the shared key
leave for the overlap, rule out further pairs.

A group of near copies is not compared pair by pair: in each bucket (the nodes of a key) all are
compared with a few centres first, and then only nodes that no link connects yet are compared.
The components are those of all pairs.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sigweave.llm.common import SLICE_BYTES, components, give_back, slices, stored, texts_of
from sigweave.llm.simhash import fingerprint_of, links
from sigweave.llm.tokens import split_words

WORDS = 5
SIMILARITY = 0.8
PERCENT = round(SIMILARITY * 100)
# Turns in which the nodes of a bucket are compared with a few of them, and with how many.
CENTRES = (1, 4)
SEED = 42
# Differing bits of fingerprints whose texts are compared.
BITS = 4
# Counters of the sketch: the table that orders shingles has one size whatever the corpus.
SLOT_BITS = 18
_SHIFT = np.uint64(64 - SLOT_BITS)
# Words of 64 bits that tell wanted hashes (keys of several nodes, texts in pairs) from most others.
WORD_BITS = 20


def _mix(z: np.ndarray) -> np.ndarray:
    z = (z ^ (z >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    z = (z ^ (z >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return z ^ (z >> np.uint64(31))


def word_hashes(texts: pa.Array) -> Iterator[np.ndarray]:
    """Hashes of the words of each text, in order; words part at ASCII white space."""
    codes, distinct, starts = split_words(texts)
    digest = xxhash.xxh64_intdigest
    hashes = np.fromiter(
        (digest(w.encode("utf-8", "surrogatepass").lower(), SEED) for w in distinct),
        dtype=np.uint64,
        count=len(distinct),
    )
    # The split leaves an empty word at white space in front or at the end.
    real = np.fromiter((bool(w) for w in distinct), dtype=bool, count=len(distinct))
    for start, end in zip(starts[:-1].tolist(), starts[1:].tolist(), strict=True):
        own = codes[start:end]
        yield hashes[own[real[own]]]


def node_of(words: np.ndarray) -> int:
    """Signed 64-bit name of a sequence of words."""
    digest = xxhash.xxh3_64_intdigest(words.astype("<u8").tobytes(), SEED)
    return digest - (1 << 64) if digest >> 63 else digest


def shingles(words: np.ndarray, length: int = WORDS) -> np.ndarray:
    """Ascending hashes of the distinct shingles; a shorter text is one shingle, none is empty."""
    if not len(words):
        return words
    span = min(length, len(words))
    last = len(words) - span + 1
    found = words[:last] + np.uint64(span)
    for i in range(1, span):
        found = _mix(found) + words[i : last + i]
    return np.unique(_mix(found))


def _slots(found: np.ndarray) -> np.ndarray:
    return (found >> _SHIFT).astype(np.int64)


def prefix(found: np.ndarray, levels: np.ndarray) -> np.ndarray:
    """The keys of a set of shingles in the common order."""
    keys = len(found) - -(-PERCENT * len(found) // 100) + 1
    return found[np.lexsort((found, levels[_slots(found)]))[:keys]] if len(found) else found


def _levels(texts: DataFrame) -> np.ndarray:
    """How often the shingles of each slot occur, as a level; a table of fixed size."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(1 << SLOT_BITS, dtype=np.int64)
        for batch in slices(batches, "text"):
            met = [shingles(w) for w in word_hashes(batch.column("text"))]
            counts += np.bincount(_slots(np.concatenate(met)), minlength=len(counts))
        used = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(counts[used])], ["slot", "n"])

    rows = texts.mapInArrow(run, "slot long, n long").groupBy("slot").agg(F.sum("n").alias("n"))
    counts = np.zeros(1 << SLOT_BITS)
    # At most as many rows as slots.
    found = rows.toArrow()
    counts[found["slot"].to_numpy()] = found["n"].to_numpy()
    del found
    give_back()
    return np.floor(64 * np.log2(counts + 1)).astype(np.uint16)


def roots(docs: DataFrame) -> DataFrame:
    """node and root of every text of ``docs`` that has a near copy; others are not listed."""
    texts = texts_of(docs, F.xxhash64("text").alias("h")).select("text", "h")
    levels = _levels(texts.select("text"))

    kinds = T.StructType.fromDDL("node long, n long, keys array<long>, fp long, h long")

    def mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            rows = {}
            hashes = batch.column("h").to_pylist()
            for words, h in zip(word_hashes(batch.column("text")), hashes, strict=True):
                node = node_of(words)
                if node not in rows:
                    found = shingles(words)
                    print_ = fingerprint_of(found)
                    rows[node] = (len(found), prefix(found, levels).view(np.int64), print_, h)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(list(rows), pa.int64()),
                    pa.array([r[0] for r in rows.values()], pa.int64()),
                    pa.array([r[1] for r in rows.values()], pa.list_(pa.int64())),
                    pa.array(np.array([r[2] for r in rows.values()], np.uint64).view(np.int64)),
                    pa.array([r[3] for r in rows.values()], pa.int64()),
                ],
                kinds.names,
            )

    # A text of each node stays named by its hash, to be found again.
    marks = stored(texts.mapInArrow(mark, kinds).dropDuplicates(["node"]), "marks")
    counted = marks.select(F.explode("keys").alias("key")).groupBy("key")
    shared = stored(counted.agg(F.count("*").alias("in_key")).filter("in_key > 1"), "shared")
    found = stored(_keyed(marks.select("node", "n", "keys"), _bits(shared)).join(shared, "key"), "members")
    # A node in many full buckets is near the middle of its group.
    weights = found.groupBy("node").agg(F.sum("in_key").alias("weight"))
    members = stored(found.join(weights, "node").drop("in_key"), "members")
    pairs = stored(_by_fingerprint(marks), "candidates")
    sets = _with_sets(None, texts, marks, pairs)
    tested = stored(_compared(pairs, sets), "pairs")
    linked = components(tested.filter("near").select("a", "b"))
    for turn in range(len(CENTRES) + 1):
        pairs = _pairs(members, linked, turn).join(tested, ["a", "b"], "left_anti")
        pairs = stored(pairs, "candidates")
        if pairs.isEmpty():
            continue
        sets = _with_sets(sets, texts, marks, pairs)
        now = stored(_compared(pairs, sets), "pairs")
        tested = tested.union(now)
        # Node and root stand for all links found before: fewer edges, nearer to the end.
        stars = linked.select(F.col("node").alias("a"), F.col("root").alias("b"))
        linked = components(stars.union(now.filter("near").select("a", "b")))
    return linked


def _by_fingerprint(marks: DataFrame) -> DataFrame:
    """Pairs (a < b) that SimHash names: a node and the first of its fingerprint, and the first
    ones of two linked fingerprints; sizes alone rule out some."""
    place = F.struct("node", "n")
    firsts = stored(marks.groupBy("fp").agg(F.min(place).alias("first")), "prints")
    same = marks.join(firsts, "fp").select(place.alias("x"), F.col("first").alias("y"))
    ends = [firsts.toDF(*names) for names in (("a", "x"), ("b", "y"))]
    near = links(firsts, BITS).join(ends[0], "a").join(ends[1], "b").select("x", "y")
    return (
        same.union(near)
        .filter("x.node <> y.node")
        .filter(100 * F.least("x.n", "y.n") >= PERCENT * F.greatest("x.n", "y.n"))
        .select(F.least("x.node", "y.node").alias("a"), F.greatest("x.node", "y.node").alias("b"))
        .distinct()
    )


def _bits(keys: DataFrame) -> np.ndarray:
    """A bit for the leading bits of each key: a table of fixed size whatever the corpus."""
    return _tables([keys])[0]


def _tables(keys: list[DataFrame]) -> list[np.ndarray]:
    """The bits of each of ``keys``, by one query."""
    word = F.shiftrightunsigned("key", 64 - WORD_BITS).alias("word")
    bit = F.expr(f"shiftleft(1L, CAST(shiftrightunsigned(key, {58 - WORD_BITS}) & 63 AS INT))")
    parts = [k.select(F.lit(i).alias("of"), "key") for i, k in enumerate(keys)]
    # At most as many rows as words, for each table.
    rows = reduce(DataFrame.union, parts).groupBy("of", word).agg(F.bit_or(bit).alias("bits")).toArrow()
    bits = np.zeros((len(keys), 1 << WORD_BITS), dtype=np.uint64)
    bits[rows["of"].to_numpy(), rows["word"].to_numpy()] = rows["bits"].to_numpy().view(np.uint64)
    del rows
    give_back()
    # Each table alone, as a task is sent the whole of what its table is a part of.
    return [own.copy() for own in bits]


def _marked(bits: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """Which keys have their bit set."""
    top = keys.view(np.uint64) >> np.uint64(58 - WORD_BITS)
    return (bits[(top >> np.uint64(6)).astype(np.int64)] >> (top & np.uint64(63)) & np.uint64(1)) > 0


def _only(rows: DataFrame, column: str, keys: DataFrame, met: bool = True) -> DataFrame:
    """Rows whose hash in ``column`` is one of ``keys`` (column key), and few others; without
    ``met`` the rest. Nothing is exchanged."""
    return _by_bits(rows, column, _bits(keys), met)


def _by_bits(rows: DataFrame, column: str, bits: np.ndarray, met: bool = True) -> DataFrame:
    return rows.mapInArrow(lambda batches: _filtered(batches, column, bits, met), rows.schema)


def _filtered(
    batches: Iterator[pa.RecordBatch], column: str, bits: np.ndarray, met: bool = True
) -> Iterator[pa.RecordBatch]:
    """The rows of ``_only`` within a task. Where texts are read next, that is one step with
    this: Spark keeps a second Python worker for each step of a task, and keeps it to the end."""
    for batch in batches:
        yield batch.filter(pa.array(_marked(bits, batch.column(column).to_numpy()) == met))


def _keyed(marks: DataFrame, bits: np.ndarray) -> DataFrame:
    """node, n, place and key of every key whose bit is set; most keys are one node's only."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "keys"):
            lists = batch.column("keys")
            counts = pc.list_value_length(lists).to_numpy(zero_copy_only=False)
            keys = lists.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
            row = np.repeat(np.arange(len(counts)), counts)
            place = np.arange(len(keys)) - np.repeat(np.cumsum(counts) - counts, counts)
            met = np.flatnonzero(_marked(bits, keys))
            own = pa.array(row[met])
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("node").take(own),
                    batch.column("n").take(own),
                    pa.array(place[met].astype(np.int32)),
                    pa.array(keys[met]),
                ],
                ["node", "n", "place", "key"],
            )

    return marks.mapInArrow(run, "node long, n long, place int, key long")


def _with_sets(
    sets: DataFrame | None, texts: DataFrame, marks: DataFrame, pairs: DataFrame
) -> DataFrame:
    """``sets`` and those of nodes of ``pairs`` that it lacks; most texts are in no pair."""
    wanted = pairs.select(F.col("a").alias("node")).union(pairs.select("b")).distinct()
    if sets is not None:
        wanted = wanted.join(sets.select("node"), "node", "left_anti")
    wanted = stored(marks.select("node", "h").join(wanted, "node", "left_semi"), "wanted")
    bits = _bits(wanted.select(F.col("h").alias("key")))
    if sets is None:
        return _sets(texts, wanted, bits)
    return sets.union(_sets(texts, wanted, bits)) if bits.any() else sets


def _sets(texts: DataFrame, wanted: DataFrame, bits: np.ndarray | None = None) -> DataFrame:
    """node and grams (packed ascending hashes) of the nodes ``wanted`` (node, h; ``bits``: of h)."""
    if bits is None:
        bits = _bits(wanted.select(F.col("h").alias("key")))

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # Others are neither cut nor exchanged.
        for batch in slices(_filtered(batches, "h", bits), "text", SLICE_BYTES):
            rows = {}
            for words in word_hashes(batch.column("text")):
                node = node_of(words)
                if node not in rows:
                    rows[node] = shingles(words).astype("<u8").tobytes()
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(rows), pa.int64()), pa.array(list(rows.values()), pa.binary())],
                ["node", "grams"],
            )

    # Copies are merged map-side, before a hot text's rows could meet in one task.
    once = texts.mapInArrow(pack, "node long, grams binary")
    once = once.join(wanted.select("node"), "node", "left_semi")
    return stored(once.dropDuplicates(["node"]), "grams")


def _pairs(members: DataFrame, linked: DataFrame, turn: int) -> DataFrame:
    """Pairs (a < b) of a bucket that no component joins yet and that could be similar."""
    rows = members.join(linked, "node", "left").withColumn("root", F.coalesce("root", "node"))
    apart = rows.groupBy("key").agg(F.min("root").alias("x"), F.max("root").alias("y"))
    # Few keys are left: as a table of known size they go to the rows, not the rows to them.
    rows = rows.join(stored(apart.filter("x <> y").select("key"), "apart"), "key")
    mates = rows.select("key", *[F.col(c).alias(f"mate_{c}") for c in ("node", "n", "place", "root")])
    if turn < len(CENTRES):
        # The same centres in all buckets of a group, so that few different pairs arise.
        order = F.struct(
            (-F.col("weight") if turn == 0 else F.xxhash64("node", F.lit(turn))).alias("o"),
            "node",
            "n",
            "place",
            "root",
        )
        mates = (
            rows.groupBy("key")
            .agg(*[F.min(order).alias("c0")] if CENTRES[turn] == 1 else _least(order, CENTRES[turn]))
            .select("key", F.explode(F.array_compact(F.array(*[f"c{i}" for i in range(CENTRES[turn])]))).alias("c"))
            .select("key", *[F.col(f"c.{c}").alias(f"mate_{c}") for c in ("node", "n", "place", "root")])
        )
    both = rows.join(mates, "key").filter("root <> mate_root")
    if turn == len(CENTRES):
        both = both.filter("node < mate_node")
    # What can still be common from the shared key on, against the least overlap.
    left = F.least(F.col("n") - F.col("place"), F.col("mate_n") - F.col("mate_place"))
    return (
        both.filter(100 * F.least("n", "mate_n") >= PERCENT * F.greatest("n", "mate_n"))
        .filter((100 + PERCENT) * left >= PERCENT * (F.col("n") + F.col("mate_n")))
        .select(F.least("node", "mate_node").alias("a"), F.greatest("node", "mate_node").alias("b"))
        .distinct()
    )


def _least(order, count: int) -> list:
    """The least of ``order`` in each of ``count`` classes of nodes: aggregates that combine."""
    place = F.pmod(F.xxhash64("node", F.lit(-1)), F.lit(count))
    return [F.min(F.when(place == i, order)).alias(f"c{i}") for i in range(count)]


def similar(left: np.ndarray, right: np.ndarray) -> bool:
    both = np.concatenate([left, right])
    both.sort()
    shared = int((both[1:] == both[:-1]).sum())
    # In whole numbers: shared / union >= 0.8 without rounding.
    return shared * 100 >= PERCENT * (len(both) - shared)


def _compared(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """a, b and near, whether the whole sets are similar, of every pair."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "right"):
            columns = [batch.column(c).to_pylist() for c in ("left", "right")]
            near = [
                similar(np.frombuffer(x, dtype="<u8"), np.frombuffer(y, dtype="<u8"))
                for x, y in zip(*columns, strict=True)
            ]
            yield pa.RecordBatch.from_arrays(
                [batch.column("a"), batch.column("b"), pa.array(near, pa.bool_())],
                ["a", "b", "near"],
            )

    # Only the sets of this turn's pairs are exchanged.
    tables = _tables([pairs.select(F.col(c).alias("key")) for c in ("a", "b")])
    left, right = (
        _by_bits(sets, "node", bits).toDF(c, name)
        for bits, c, name in zip(tables, ("a", "b"), ("left", "right"), strict=True)
    )
    whole = pairs.join(left, "a").join(right, "b").select("a", "b", "left", "right")
    return whole.mapInArrow(run, "a long, b long, near boolean")


def without_copies(docs: DataFrame) -> DataFrame:
    """One row of each group of near copies: that with the smallest doc_id.

    Rows of one doc_id are told apart by their texts; among them, and among equal ones with
    other columns, a hash decides, so the choice is the same in every run; rows equal in all
    columns stay once. Rows without a doc_id link like any other but cannot name a group and
    stay. Null texts and texts without a word are copies of each other. Very long texts are
    compared whole. Columns may have any names.
    """
    found = roots(docs)
    tag = uuid.uuid4().hex
    node, row = f"node_{tag}", f"row_{tag}"

    def name(
        batches: Iterator[pa.RecordBatch], size: int | None = None
    ) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text", size):
            nodes = [node_of(w) for w in word_hashes(batch.column("text"))]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(nodes, pa.int64())], [*batch.schema.names, node]
            )

    hashed = docs.filter("doc_id IS NOT NULL").withColumn(row, F.xxhash64(*docs.columns))
    schema = type(docs.schema)([*hashed.schema.fields]).add(node, "long")
    rows = hashed.mapInArrow(name, schema)
    key = ["doc_id", node, row]
    named = (
        stored(rows.select(key), "named")
        .groupBy(key)
        .agg(F.count("*").alias("copies"))
        .join(found.withColumnRenamed("node", node), node, "left")
        .withColumn("root", F.coalesce("root", node))
    )
    first = named.groupBy("root").agg(F.min(F.struct(key)).alias("first"))
    # Most rows are alone; only the others meet the documents.
    marked = stored(
        named.join(first, "root")
        .select(*key, "copies", (F.struct(key) == F.col("first")).alias("kept"))
        .filter("copies > 1 OR NOT kept"),
        "copies",
    )
    # Rows that are alone are told by their hashes, without an exchange.
    bits = _bits(marked.select(F.col(row).alias("key")))
    alone = _by_bits(hashed, row, bits, met=False).select(docs.columns)
    rows = hashed.mapInArrow(lambda b: name(_filtered(b, row, bits), SLICE_BYTES), schema)
    kept = alone.union(rows.join(marked.select(key), key, "left_anti").select(docs.columns))
    again = marked.filter("kept").select(key)
    if again.take(1):
        once = rows.join(again, key, "left_semi").dropDuplicates(key)
        kept = kept.union(once.select(docs.columns))
    return kept.union(docs.filter("doc_id IS NULL"))
