"""Packing in the order of a space-filling curve.

A document is the vector of its ids' counts, of length one, projected to a few dimensions by
random weights that an id's hash gives. The Hilbert key of the quantised point orders the
documents, so neighbours on the curve use the same ids. The ids are sorted by ranges of
that order; each range is one stream of ids cut every ``length`` ids, and its rest is
cut at powers of two, which need no padding. Rows whose order another step has decided are
sorted along the curve only within windows of that order.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sigweave.llm.common import WORD_SLICE_BYTES, slices, stored, texts_of
from sigweave.llm.tokens import encoder, vocabulary_path, with_end

LENGTH = 2048
END_ID = 1
DIMS = 4
BITS = 10
# A key's lower bits spread equal points, so that copies can fall into several ranges.
SPREAD = 22
# Bytes of ids of a range; beyond so many ranges they grow with the table instead.
RANGE_BYTES = 16 << 20
MOST_RANGES = 50_000
# Documents of a window of a given order; the curve sorts within a window only.
WINDOW_DOCS = 256
_PLACE = ["place_part", "place_file", "place_window"]
_HALF = 1 << 15
_AXES: dict[int, np.ndarray] = {}


def hilbert(points: np.ndarray, bits: int) -> np.ndarray:
    """Place on the Hilbert curve of points (rows) with coordinates below 2 ** bits."""
    x = points.astype(np.int64).T.copy()
    dims = len(x)
    q = 1 << (bits - 1)
    while q > 1:
        p = q - 1
        for i in range(dims):
            up = (x[i] & q) > 0
            swap = np.where(up, 0, (x[0] ^ x[i]) & p)
            x[0] = np.where(up, x[0] ^ p, x[0] ^ swap)
            x[i] ^= swap
        q >>= 1
    for i in range(1, dims):
        x[i] ^= x[i - 1]
    t = np.zeros_like(x[0])
    q = 1 << (bits - 1)
    while q > 1:
        t = np.where((x[dims - 1] & q) > 0, t ^ (q - 1), t)
        q >>= 1
    x ^= t
    key = np.zeros_like(x[0])
    for b in range(bits - 1, -1, -1):
        for i in range(dims):
            key = (key << 1) | ((x[i] >> b) & 1)
    return key


def curve_keys(ids: np.ndarray, starts: np.ndarray, size: int) -> np.ndarray:
    """Hilbert key of every text given by its ids (below ``size``); one without any is the origin."""
    texts = len(starts) - 1
    owner = np.repeat(np.arange(texts), np.diff(starts))
    pair, count = np.unique(owner * size + ids, return_counts=True)
    owner, code = np.divmod(pair, size)
    norm = np.sqrt(np.bincount(owner, weights=count.astype(float) ** 2, minlength=texts))
    axes = _axes(size)
    point = np.stack(
        [np.bincount(owner, weights=axes[d, code] * count, minlength=texts) for d in range(DIMS)],
        axis=1,
    ) / np.maximum(norm, 1.0)[:, None]
    level = np.clip((point + 4) / 8 * (1 << BITS), 0, (1 << BITS) - 1)
    return hilbert(level, BITS)


def _axes(size: int) -> np.ndarray:
    """Weights of every id on each dimension, from a hash of the id; variance one."""
    if size not in _AXES:
        z = np.arange(1, size + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        z = (z ^ (z >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        z = (z ^ (z >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        parts = (z ^ (z >> np.uint64(31))).view(np.uint16).reshape(-1, DIMS).astype(np.float64)
        _AXES[size] = ((parts - (_HALF - 0.5)) / _HALF * 3**0.5).T.copy()
    return _AXES[size]


def _key(docs: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """The curve key with bits of a hash of doc_id below it."""
    mixed = docs.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    return (keys << SPREAD) | (mixed >> np.uint64(64 - SPREAD)).astype(np.int64)


def _ids_of(batch: pa.RecordBatch) -> np.ndarray:
    return batch.column("doc_id").fill_null(-1).to_numpy(zero_copy_only=False)


def _placed(docs: DataFrame) -> DataFrame:
    """Adds the window of each row: by part file and row if ``docs`` reads Parquet files.

    Other rows count by their partitions. Spark does not read files in the order of their
    names, so a reread table is ordered by names and row numbers only.
    """
    try:
        rows = docs.select(
            *docs.columns,
            F.coalesce(
                F.expr("try_cast(regexp_extract(_metadata.file_name, '^part-([0-9]+)', 1) AS LONG)"),
                F.lit(-1),
            ).alias("place_part"),
            F.col("_metadata.file_name").alias("place_file"),
            F.col("_metadata.row_index").alias("place_row"),
        )
        # Names are resolved here, so a table without files fails now.
        rows.schema  # noqa: B018
    except AnalysisException:
        rows = docs.withColumn("place_row", F.monotonically_increasing_id()).select(
            *docs.columns,
            F.shiftright("place_row", 33).alias("place_part"),
            F.lit("").alias("place_file"),
            F.expr("place_row & 8589934591").alias("place_row"),
        )
    return rows.withColumn("place_window", F.expr(f"place_row DIV {WINDOW_DOCS}"))


def pack(
    docs: DataFrame,
    path: str | None = None,
    length: int = LENGTH,
    end_id: int = END_ID,
    with_ids: bool = True,
    ordered: bool = False,
) -> DataFrame:
    """Pieces of documents in sequences of at most ``length`` ids.

    Columns: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset and ids (null
    without ``with_ids``). Each document is its ids by the vocabulary file ``path`` and then ``end_id``; a null or empty
    text is the end id alone, a long one goes on in the next sequence. Rows that repeat are
    packed as often as they come; a null doc_id stays null; other columns are not read. An
    empty table has no pieces.

    With ``ordered`` the rows' own order holds: sequences are numbered along it, and only the
    documents of a window of ``WINDOW_DOCS`` change places. Else the curve orders all.
    """
    path = path or vocabulary_path()
    place = _PLACE if ordered else []
    kinds = "doc_id long, key long, width int, ids binary" + (
        ", place_part long, place_file string, place_window long" if ordered else ""
    )
    source = texts_of(_placed(docs.select("doc_id", "text")), *place) if ordered else texts_of(docs)

    def keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(path)
        for batch in slices(batches, "text", WORD_SLICE_BYTES):
            plain, at = encode.encode(batch.column("text"))
            key = _key(_ids_of(batch), curve_keys(plain, at, encode.size))
            ids, at = with_end(plain, at, end_id)
            size = 2 if encode.width == 2 and end_id < 1 << 16 else 4
            raw = ids.astype(f"<u{size}").tobytes()
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    pa.array(key),
                    pa.array([size] * batch.num_rows, pa.int32()),
                    pa.array(
                        [raw[s * size : e * size] for s, e in zip(at[:-1], at[1:], strict=True)],
                        pa.binary(),
                    ),
                    *(batch.column(c) for c in place),
                ],
                ["doc_id", "key", "width", "ids", *place],
            )

    # Encoded once: the sampling of the ranges and the sort both read the stored ids.
    rows = stored(source.mapInArrow(keyed, kinds), "packing")
    size = rows.agg(F.sum(F.octet_length("ids"))).first()[0] or 0

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        packer = _Packer(TaskContext.get().partitionId(), length, with_ids)
        for batch in slices(batches, "ids"):
            columns = [batch.column(c).to_pylist() for c in ("doc_id", "width", "ids")]
            for doc, width, raw in zip(*columns, strict=True):
                packer.add(doc, np.frombuffer(raw, dtype=f"<u{width}").astype("<u4"))
            yield from packer.done()
        packer.close()
        yield from packer.done()

    # Equal keys are copies with equal hash bits: their order is that of doc_id.
    return (
        rows.repartitionByRange(min(int(size // RANGE_BYTES) + 1, MOST_RANGES), *(place or ["key"]))
        .sortWithinPartitions(*place, "key", "doc_id", "ids")
        .mapInArrow(cut, _Packer.SCHEMA)
    )


class _Packer:
    """Cuts the stream of one range; holds the pieces of one sequence at most."""

    SCHEMA = (
        "doc_id long, start long, length long, ids_crc32 long, doc_tokens long,"
        " sequence_id long, offset long, ids array<int>"
    )
    _TYPES = [pa.int64()] * 7 + [pa.list_(pa.int32())]
    _NAMES = [c.split()[0] for c in SCHEMA.split(", ")]

    def __init__(self, place: int, length: int, with_ids: bool):
        self._range, self._length, self._with_ids = place, length, with_ids
        self._open: list[tuple] = []
        self._fill = self._number = 0
        self._out: list[tuple] = []

    def add(self, doc: int | None, ids: np.ndarray) -> None:
        start = 0
        while start < len(ids):
            n = min(len(ids) - start, self._length - self._fill)
            self._open.append((doc, start, ids[start : start + n], len(ids)))
            self._fill += n
            start += n
            if self._fill == self._length:
                self._emit(self._open)
                self._open, self._fill = [], 0

    def close(self) -> None:
        """Cut what is left at powers of two."""
        while self._fill:
            n = 1 << (self._fill.bit_length() - 1)
            whole, left = [], n
            while left:
                doc, start, ids, total = self._open.pop(0)
                whole.append((doc, start, ids[:left], total))
                if len(ids) > left:
                    self._open.insert(0, (doc, start + left, ids[left:], total))
                left -= min(left, len(ids))
            self._fill -= n
            self._emit(whole)

    def _emit(self, pieces: list[tuple]) -> None:
        sequence, offset = (self._range << 32) + self._number, 0
        for doc, start, ids, total in pieces:
            crc = zlib.crc32(ids.tobytes())
            kept = ids.view(np.int32) if self._with_ids else None
            self._out.append((doc, start, len(ids), crc, total, sequence, offset, kept))
            offset += len(ids)
        self._number += 1

    def done(self) -> Iterator[pa.RecordBatch]:
        if self._out:
            columns = [
                pa.array(c, t) for c, t in zip(zip(*self._out, strict=True), self._TYPES, strict=True)
            ]
            self._out = []
            yield pa.RecordBatch.from_arrays(columns, self._NAMES)
