"""Token ids in shards with a minimal perfect hash index.

A shard is one row of a Parquet table in the shared store (Spark's own writers place and
commit it, so a lost task leaves no half shard): the raw ids of neighbouring documents, their
keys, offsets, and an index. The index is a cascade of bit arrays (each level places the keys
that hash alone, the rest goes on); a key's rank among the set bits is its slot, and a stored
fingerprint tells a key that the shard does not hold. A slot names the key's first entry, so
access takes constant time.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sigweave.llm.common import WORD_SLICE_BYTES, slices, stored, texts_of
from sigweave.llm.tokens import encoder, vocabulary_path

END_ID = 2
SHARD_IDS = 1 << 19
# Bytes of ids of a part; beyond so many parts they grow with the table instead.
PART_BYTES = 16 << 20
MOST_PARTS = 50_000
GAMMA = 2.0
NULL_KEY = 0x6E756C6C
SCHEMA = (
    "part int, shard int, first_id long, last_id long, n_docs long, n_tokens long, width int,"
    " doc_ids binary, nulls long, offsets binary, levels array<binary>, sizes array<long>,"
    " prints binary, entries binary, payload binary"
)
_NAMES = [c.split()[0] for c in SCHEMA.split(", ")]
_TYPES = [
    pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int32(),
    pa.binary(), pa.int64(), pa.binary(), pa.list_(pa.binary()), pa.list_(pa.int64()),
    pa.binary(), pa.binary(), pa.binary(),
]


def _mix(keys: np.ndarray, seed: int) -> np.ndarray:
    """A bijective mix of 64-bit keys for each seed."""
    z = keys + np.uint64((seed + 1) * 0x9E3779B97F4A7C15 % (1 << 64))
    z = (z ^ (z >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    z = (z ^ (z >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return z ^ (z >> np.uint64(31))


class PerfectHash:
    """Minimal perfect hash over distinct 64-bit keys."""

    def __init__(self, levels: list[np.ndarray]):
        self.levels = levels
        self._ranks, base = [], 0
        for bits in levels:
            self._ranks.append(base + np.cumsum(bits) - 1)
            base += int(bits.sum())

    @classmethod
    def build(cls, keys: np.ndarray) -> PerfectHash:
        levels, rest = [], keys
        while len(rest):
            size = max(8, int(GAMMA * len(rest)))
            place = (_mix(rest, len(levels)) % np.uint64(size)).astype(np.int64)
            alone = np.bincount(place, minlength=size) == 1
            levels.append(alone)
            rest = rest[~alone[place]]
        return cls(levels)

    def slots(self, keys: np.ndarray) -> np.ndarray:
        """Slot of each key; -1 or any slot for a key that was not in the set."""
        found = np.full(len(keys), -1, dtype=np.int64)
        open_ = np.arange(len(keys))
        for n, (bits, ranks) in enumerate(zip(self.levels, self._ranks, strict=True)):
            place = (_mix(keys[open_], n) % np.uint64(len(bits))).astype(np.int64)
            hit = bits[place]
            found[open_[hit]] = ranks[place[hit]]
            open_ = open_[~hit]
        return found


def _print(keys: np.ndarray) -> np.ndarray:
    return (_mix(keys, 1000) >> np.uint64(32)).astype(np.uint32)


def _shard(part: int, number: int, docs: list[int | None], ids: list[np.ndarray], width: int) -> tuple:
    nulls = sum(d is None for d in docs)
    keys = np.array([d for d in docs if d is not None], dtype=np.int64)
    offsets = np.cumsum([0, *(len(i) for i in ids)])
    distinct, first = np.unique(keys, return_index=True)
    hashing = PerfectHash.build(distinct.view(np.uint64))
    slot = hashing.slots(distinct.view(np.uint64))
    prints, entries = np.zeros(len(slot), np.uint32), np.zeros(len(slot), np.int64)
    prints[slot], entries[slot] = _print(distinct.view(np.uint64)), first + nulls
    return (
        part, number, int(keys[0]) if len(keys) else None, int(keys[-1]) if len(keys) else None,
        len(docs), int(offsets[-1]), width, keys.astype("<i8").tobytes(), nulls,
        offsets.astype("<i8").tobytes(), [np.packbits(b).tobytes() for b in hashing.levels],
        [len(b) for b in hashing.levels], prints.astype("<u4").tobytes(),
        entries.astype("<i8").tobytes(), np.concatenate(ids).astype(f"<u{width}").tobytes(),
    )


class Shard:
    """One shard as read back."""

    def __init__(self, row: dict):
        self.keys = np.frombuffer(row["doc_ids"], dtype="<i8")
        self.nulls = row["nulls"]
        self._offsets = np.frombuffer(row["offsets"], dtype="<i8")
        self._ids = np.frombuffer(row["payload"], dtype=f"<u{row['width']}")
        self._prints = np.frombuffer(row["prints"], dtype="<u4")
        self._entries = np.frombuffer(row["entries"], dtype="<i8")
        self._hash = PerfectHash(
            [
                np.unpackbits(np.frombuffer(b, dtype=np.uint8), count=n).astype(bool)
                for b, n in zip(row["levels"], row["sizes"], strict=True)
            ]
        )

    def entries(self, keys: np.ndarray) -> np.ndarray:
        """First entry of each key, -1 if the shard lacks it."""
        keys = np.asarray(keys, dtype=np.int64).view(np.uint64)
        slot = self._hash.slots(keys)
        if not len(self._prints):
            return slot
        known = (slot >= 0) & (self._prints[slot] == _print(keys))
        # A fingerprint can agree by chance; the key that the entry names cannot.
        entry = np.where(known, self._entries[slot], self.nulls)
        known &= self.keys[np.minimum(entry - self.nulls, len(self.keys) - 1)].view(np.uint64) == keys
        return np.where(known, entry, -1)

    def start(self, entry: int) -> int:
        return int(self._offsets[entry])

    def ids(self, entry: int) -> np.ndarray:
        return self._ids[self._offsets[entry] : self._offsets[entry + 1]].astype("<u4")


def write(docs: DataFrame, out: str, path: str | None = None, end_id: int = END_ID) -> None:
    """Write the ids of every document, ``end_id`` after each, in ascending doc_id order.

    A null text is empty. Null doc_ids come first; rows with one doc_id follow each other in
    the order of a hash of their text. A document is never split, so a very long one makes a
    large shard. Other columns are not read; an empty table gives an empty table of shards.
    """
    path = path or vocabulary_path()

    def encoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(path)
        width = 2 if encode.width == 2 and end_id < 1 << 16 else 4
        for batch in slices(batches, "text", WORD_SLICE_BYTES):
            flat, at = encode.encode(batch.column("text"), end_id)
            raw = flat.astype(f"<u{width}").tobytes()
            ids = [raw[s * width : e * width] for s, e in zip(at[:-1], at[1:], strict=True)]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    batch.column("h"),
                    pa.array([width] * batch.num_rows, pa.int32()),
                    pa.array(ids, pa.binary()),
                ],
                ["doc_id", "h", "width", "ids"],
            )

    # Encoded once: the sampling of the ranges and the sort both read the stored ids.
    source = texts_of(docs, F.xxhash64("text").alias("h"))
    rows = stored(source.mapInArrow(encoded, "doc_id long, h long, width int, ids binary"), "ids")
    size = rows.agg(F.sum(F.octet_length("ids"))).first()[0] or 0

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part = TaskContext.get().partitionId()
        number, docs, ids, held, width = 0, [], [], 0, 2

        def emit() -> pa.RecordBatch:
            row = _shard(part, number, docs, ids, width)
            return pa.RecordBatch.from_arrays(
                [pa.array([v], t) for v, t in zip(row, _TYPES, strict=True)], _NAMES
            )

        for batch in slices(batches, "ids"):
            columns = [batch.column(c).to_pylist() for c in ("doc_id", "width", "ids")]
            for doc, width, raw in zip(*columns, strict=True):
                docs.append(doc)
                ids.append(np.frombuffer(raw, dtype=f"<u{width}"))
                held += len(ids[-1])
                if held >= SHARD_IDS:
                    yield emit()
                    number, docs, ids, held = number + 1, [], [], 0
        if docs:
            yield emit()

    (
        rows.repartitionByRange(min(int(size // PART_BYTES) + 1, MOST_PARTS), "doc_id", "h")
        .sortWithinPartitions("doc_id", "h", "ids")
        .mapInArrow(run, SCHEMA)
        .write.parquet(out)
    )


def read(spark: SparkSession, out: str) -> DataFrame:
    """Every document as read back through the index: doc_id, start, n_tokens, ids_crc32."""
    shards = spark.read.schema(SCHEMA).parquet(out)
    # Sums of the parts (as many as write had partitions), then of the shards of each part.
    parts = shards.groupBy("part").agg(F.sum("n_tokens").alias("n"))
    before = parts.select(
        "part",
        F.coalesce(
            F.sum("n").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)),
            F.lit(0),
        ).alias("part_start"),
    )
    inside = shards.select(
        "part",
        "shard",
        F.coalesce(
            F.sum("n_tokens").over(
                Window.partitionBy("part")
                .orderBy("shard")
                .rowsBetween(Window.unboundedPreceding, -1)
            ),
            F.lit(0),
        ).alias("shard_start"),
    )
    bases = inside.join(before, "part").select(
        "part", "shard", (F.col("part_start") + F.col("shard_start")).alias("base")
    )
    names = "part int, shard int, doc_id long, inner long, n_tokens long, ids_crc32 long"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "payload"):
            for row in batch.to_pylist():
                shard = Shard(row)
                # Through the index: a key's first entry; repeated keys follow it.
                first = shard.entries(shard.keys)
                _, run_start, inverse = np.unique(shard.keys, return_index=True, return_inverse=True)
                entry = first + np.arange(len(first)) - run_start[inverse]
                entry = np.concatenate([np.arange(shard.nulls), entry]).astype(np.int64)
                ids = [shard.ids(e) for e in entry.tolist()]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([row["part"]] * len(ids), pa.int32()),
                        pa.array([row["shard"]] * len(ids), pa.int32()),
                        pa.array([None] * shard.nulls + shard.keys.tolist(), pa.int64()),
                        pa.array([shard.start(e) for e in entry.tolist()], pa.int64()),
                        pa.array([len(i) for i in ids], pa.int64()),
                        pa.array([zlib.crc32(i.tobytes()) for i in ids], pa.int64()),
                    ],
                    [c.split()[0] for c in names.split(", ")],
                )

    return (
        shards.mapInArrow(run, names)
        .join(bases, ["part", "shard"])
        .select("doc_id", (F.col("base") + F.col("inner")).alias("start"), "n_tokens", "ids_crc32")
    )


def fetch(spark: SparkSession, out: str, keys: list[int]) -> DataFrame:
    """doc_id and ids of the rows with one of ``keys``; only shards that may hold one are read."""
    shards = spark.read.schema(SCHEMA).parquet(out)
    wanted = F.lit(False)
    for key in keys:
        wanted |= (F.col("first_id") <= key) & (F.col("last_id") >= key)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "payload"):
            for row in batch.to_pylist():
                shard, docs, ids = Shard(row), [], []
                for key, entry in zip(keys, shard.entries(np.array(keys)).tolist(), strict=True):
                    while entry >= 0 and entry < row["n_docs"] and shard.keys[entry - shard.nulls] == key:
                        docs.append(key)
                        ids.append(shard.ids(entry).tolist())
                        entry += 1
                yield pa.RecordBatch.from_arrays(
                    [pa.array(docs, pa.int64()), pa.array(ids, pa.list_(pa.int64()))],
                    ["doc_id", "ids"],
                )

    return shards.filter(wanted).mapInArrow(run, "doc_id long, ids array<long>")
