"""Language identification by averaged hashed subword embeddings and a linear softmax.

A text is the average of the embeddings of its hashed byte 3- and 4-grams (lower case, all
that is no letter becomes a blank, so grams see word ends). Embeddings and output weights are
trained together by stochastic gradient descent in numpy. Both maps are linear, so a trained
model is one table of logits per bucket. A temperature fitted on held-back texts makes the
softmax a probability, and texts are rejected by limits that those texts calibrate.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sigweave.llm.common import last_place, slices, texts_of

BUCKETS = 1 << 15
DIM = 16
EPOCHS = 8
BATCH = 32
PIECE = 1 << 20
RATE = 0.5
# Documented bound of the texts per language that a model is fitted on.
TRAIN_ROWS = 600
UNKNOWN = "und"
_LETTER = re.compile(r"[^\W\d_]")
# The same characters for Java.
_LETTER_JAVA = r"[\p{L}\p{Nl}\p{No}]"
_BLANKS = bytes(32 if b < 128 and not chr(b).isalpha() else b for b in range(256))


@dataclass
class LanguageModel:
    languages: list[str]
    logits: np.ndarray
    bias: np.ndarray
    seen: np.ndarray
    temperature: float = 1.0
    least_score: float = 0.0
    least_seen: float = 0.0


def _grams(text: str) -> Iterator[np.ndarray]:
    """Hashed subwords of a whole text, in pieces of bounded size."""
    line = (" " + text.lower() + " ").encode("utf-8", "surrogatepass").translate(_BLANKS)
    b = np.frombuffer(b" ".join([b"", *line.split(), b""]), dtype=np.uint8)
    for start in range(0, max(1, len(b) - 2), PIECE):
        # Three bytes of overlap, so each gram of a piece's first PIECE places is whole.
        c = b[start : start + PIECE + 3].astype(np.uint32)
        three = c[:-2] | (c[1:-1] << 8) | (c[2:] << 16)
        four = three[: len(c) - 3] | (c[3:] << 24)
        for gram, odd in ((three[:PIECE], 0x9E3779B1), (four[:PIECE], 0x85EBCA6B)):
            yield (gram * np.uint32(odd)) >> np.uint32(17)


def gram_counts(text: str) -> np.ndarray:
    counts = np.zeros(BUCKETS, dtype=np.int64)
    for part in _grams(text):
        counts += np.bincount(part, minlength=BUCKETS)
    return counts


def has_letter(text: str | None) -> bool:
    return bool(text and _LETTER.search(text))


def _softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(axis=-1, keepdims=True))
    return e / e.sum(axis=-1, keepdims=True)


def predict(text: str | None, model: LanguageModel) -> tuple[str, float, bool]:
    """Language, calibrated probability and whether the text is rejected."""
    if not model.languages or not has_letter(text):
        return UNKNOWN, 0.0, True
    counts = gram_counts(text)
    share = (counts / max(1, counts.sum())).astype(np.float32)
    known = float(share @ model.seen)
    z = share @ model.logits + model.bias
    p = _softmax(z.astype(np.float64) / model.temperature)
    best = int(p.argmax())
    low = p[best] < model.least_score or known < model.least_seen
    return model.languages[best], float(p[best]), bool(low)


def fit(docs: DataFrame, rows: int = TRAIN_ROWS, seed: int = 7) -> LanguageModel:
    """Model from ``docs`` (text, lang): about ``rows`` different texts per language.

    Rows with a null text or language or without a letter teach nothing. The draw goes by a
    hash of the text, so it is the same in every run and copies of a text are drawn together;
    they count once. A quarter of the texts calibrates. With no row left the model knows no
    language and rejects everything.
    """
    usable = docs.select(F.col("text").cast("string"), F.col("lang").cast("string")).filter(
        "text IS NOT NULL AND lang IS NOT NULL"
    )
    # Copies count once and texts without a letter not at all, as in the draw.
    place = F.xxhash64("text", F.lit(5))
    counted = (
        usable.filter(F.col("text").rlike(_LETTER_JAVA))
        .groupBy("lang")
        .agg(F.count_distinct(place).alias("n"))
    )
    sizes = {r.lang: r.n for r in counted.collect()}
    if not sizes:
        return LanguageModel([], np.zeros((BUCKETS, 0)), np.zeros(0), np.zeros(BUCKETS))
    last = F.coalesce(
        *[F.when(F.col("lang") == lang, F.lit(last_place(rows, n))) for lang, n in sizes.items()]
    )
    drawn = usable.filter(place <= last)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            out = []
            for text in batch.column("text").to_pylist():
                n = gram_counts(text) if has_letter(text) else np.zeros(0)
                idx = np.flatnonzero(n)
                out.append((idx.astype(np.int32), (n[idx] / max(1, n.sum())).astype(np.float32)))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("lang"),
                    pa.array([i.astype("<i4").tobytes() for i, _ in out], pa.binary()),
                    pa.array([w.astype("<f4").tobytes() for _, w in out], pa.binary()),
                ],
                ["lang", "idx", "w"],
            )

    kinds = "lang string, idx binary, w binary"
    # Packed numbers: a list of Python objects would take ten times the memory. Copies are
    # merged before the driver sees them, since a group of copies has no bound.
    texts = {
        (r.lang, bytes(r.idx), bytes(r.w)): None
        for r in drawn.mapInArrow(run, kinds).distinct().toLocalIterator()
        if r.idx
    }
    keys = sorted(texts)
    languages = sorted({k[0] for k in keys})
    data = [
        (np.frombuffer(idx, dtype="<i4"), np.frombuffer(w, dtype="<f4"), languages.index(lang))
        for lang, idx, w in keys
    ]
    return train(data, languages, seed)


def train(data: list, languages: list[str], seed: int = 7) -> LanguageModel:
    rng = np.random.default_rng(seed)
    order = rng.permutation(len(data))
    held = [data[i] for i in order[: len(data) // 4]]
    data = [data[i] for i in order[len(data) // 4 :]]
    embed = rng.normal(0, 0.1, (BUCKETS, DIM)).astype(np.float32)
    weight, bias = np.zeros((DIM, len(languages)), np.float32), np.zeros(len(languages), np.float32)
    seen = np.zeros(BUCKETS, np.float32)
    for idx, _, _ in data:
        seen[idx] = 1.0
    for epoch in range(EPOCHS):
        rate = RATE * 20 * (1 - epoch / EPOCHS)
        shuffled = rng.permutation(len(data))
        for start in range(0, len(data), BATCH):
            part = [data[i] for i in shuffled[start : start + BATCH]]
            hidden = np.stack([w @ embed[idx] for idx, w, _ in part])
            p = _softmax(hidden @ weight + bias)
            p[np.arange(len(part)), [y for *_, y in part]] -= 1
            p /= len(part)
            back = p @ weight.T
            weight -= rate * hidden.T @ p
            bias -= 0.1 * rate * p.sum(axis=0)
            for (idx, w, _), g in zip(part, back, strict=True):
                embed[idx] -= rate * w[:, None] * g[None, :] * len(part)
    # Buckets that no text used would add noise.
    table = (embed * seen[:, None]) @ weight
    model = LanguageModel(languages, table.astype(np.float32), bias, seen)
    return _calibrate(model, held or data)


def _calibrate(model: LanguageModel, held: list) -> LanguageModel:
    if not held:
        return model
    z = np.stack([w @ model.logits[idx] for idx, w, _ in held]).astype(np.float64) + model.bias
    y = np.array([label for *_, label in held])
    rows = np.arange(len(y))
    grid = np.geomspace(0.05, 20, 60)
    loss = [-np.log(_softmax(z / t)[rows, y] + 1e-12).mean() for t in grid]
    model.temperature = float(grid[int(np.argmin(loss))])
    p = _softmax(z / model.temperature)
    right = p.argmax(axis=1) == y
    # Half of the least that a rightly named text shows: known languages pass, others do not.
    known = np.array([w @ model.seen[idx] for idx, w, _ in held])
    if right.any():
        model.least_score = 0.5 * float(p.max(axis=1)[right].min())
        model.least_seen = 0.5 * float(known[right].min())
    return model


def identify(docs: DataFrame, model: LanguageModel) -> DataFrame:
    """doc_id, lang_pred, score and rejected of every row.

    A null text and a text without a letter get ``und``, score 0 and are rejected. Very long
    texts are read whole. Equal scores go to the first language in alphabetical order. Rows
    that repeat come out as often as they came in; other columns are not read.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            found = [predict(t, model) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    pa.array([f[0] for f in found], pa.string()),
                    pa.array([f[1] for f in found], pa.float64()),
                    pa.array([f[2] for f in found], pa.bool_()),
                ],
                ["doc_id", "lang_pred", "score", "rejected"],
            )

    source = texts_of(docs)
    return source.mapInArrow(run, "doc_id long, lang_pred string, score double, rejected boolean")


def without_unknown(docs: DataFrame, model: LanguageModel) -> DataFrame:
    """The rows of ``docs`` (any columns, in order) whose language is not rejected."""
    schema = docs.schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            keep = [not predict(t, model)[2] for t in batch.column("text").to_pylist()]
            yield batch.filter(pa.array(keep))

    return docs.mapInArrow(run, schema)
