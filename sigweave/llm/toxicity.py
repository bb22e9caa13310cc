"""Toxic passages as maximum-scoring segments over token log-odds.

Every word gets the log-odds of toxic against clean documents under a Dirichlet prior that
follows the frequencies of both together, for the word and for its stem, in hashed slots (so
the table has one size whatever the corpus). Odds that are not significant count as zero and
every word pays a small drift, so a clean text scores negative. A linear scan (Ruzzo and
Tompa) gives all disjoint maximal segments. Clean texts tell how large the best segment of m
words gets by chance (a Gumbel law in S - log(m) / lambda); a logistic regression turns the
significance of the best segment and the number of significant ones into a probability.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sigweave.llm.common import last_place, slices, stored, texts_of

SLOTS = 1 << 18
STEM = 4
PRIOR_SHARE = 0.02
Z_LEAST = 2.0
DRIFT = 0.2
# Documented bound of the labelled rows that a model is fitted on.
TRAIN_ROWS = 50_000
E_VALUE = 0.01
_HELD_TYPES = [pa.int64(), pa.float64(), pa.float64(), pa.float64()]


@dataclass
class ToxicityModel:
    word_odds: np.ndarray
    stem_odds: np.ndarray
    rate: float = 1.0
    log_k: float = 0.0
    weights: tuple = (0.0, 0.0, -2.0)


def _slot(word: str) -> int:
    return xxhash.xxh64_intdigest(word.encode("utf-8", "surrogatepass"), 42) % SLOTS


def words_of(texts: pa.Array) -> tuple[np.ndarray, list[str], np.ndarray]:
    """Word codes of all texts, the distinct words, and where each text's words start."""
    lower = pc.utf8_lower(pc.fill_null(texts.cast(pa.large_string()), ""))
    words = pc.split_pattern_regex(lower, r"[^\p{L}]+")
    coded = words.flatten().dictionary_encode()
    starts = words.offsets.to_numpy() - words.offsets[0].as_py()
    return (
        coded.indices.to_numpy(zero_copy_only=False).astype(np.int64),
        coded.dictionary.to_pylist(),
        starts.astype(np.int64),
    )


def _slots(distinct: list[str]) -> tuple[np.ndarray, np.ndarray]:
    whole = np.fromiter((_slot(w) for w in distinct), dtype=np.int64, count=len(distinct))
    stem = np.fromiter((_slot(w[:STEM]) for w in distinct), dtype=np.int64, count=len(distinct))
    return whole, stem


def segments(scores: np.ndarray) -> list[tuple[int, int, float]]:
    """All maximal-scoring disjoint segments (start, end, score), end exclusive."""
    total = np.concatenate(([0.0], np.cumsum(scores)))
    found: list[tuple[int, int, float, float]] = []
    for i in np.flatnonzero(scores > 0).tolist():
        start, end, low, high = i, i + 1, float(total[i]), float(total[i + 1])
        while True:
            j = len(found) - 1
            while j >= 0 and found[j][2] >= low:
                j -= 1
            if j < 0 or found[j][3] >= high:
                break
            start, low = found[j][0], found[j][2]
            del found[j:]
        found.append((start, end, low, high))
    return [(s, e, high - low) for s, e, low, high in found]


def _scored(texts: pa.Array, model: ToxicityModel) -> Iterator[list[tuple[int, int, float]] | int]:
    """Number of words and segments of each text."""
    codes, distinct, starts = words_of(texts)
    whole, stem = _slots(distinct)
    per_word = (model.word_odds[whole] + model.stem_odds[stem] - DRIFT).astype(np.float64)
    scores = per_word[codes]
    for s, e in zip(starts[:-1].tolist(), starts[1:].tolist(), strict=True):
        yield e - s, segments(scores[s:e])


def _features(count: int, found: list, model: ToxicityModel) -> tuple[float, float]:
    """Log-significance of the best segment, and of how many segments are significant."""
    shift = model.log_k + math.log(max(count, 1))
    best = max((s for _, _, s in found), default=0.0)
    floor = -math.log(E_VALUE)
    many = sum(model.rate * s - shift >= floor for _, _, s in found)
    return model.rate * best - shift, math.log1p(many)


def probability(count: int, found: list, model: ToxicityModel) -> float:
    x, many = _features(count, found, model)
    a, b, c = model.weights
    return 1.0 / (1.0 + math.exp(-max(-30.0, min(30.0, a * x + b * many + c))))


def fit(docs: DataFrame, labels: DataFrame, train_rows: int = TRAIN_ROWS) -> ToxicityModel:
    """Model from documents that ``labels`` (doc_id, toxic) marks 0 or 1.

    A label row with null counts for nothing; a document with several labels is toxic if one
    says so. About ``train_rows`` labelled documents, drawn by a hash of doc_id, are used; the
    model never sees the others. Copies of a text count once. A third of them calibrates.
    Without documents of both kinds the model scores every text alike, below 0.5.
    """
    marked = (
        labels.select(F.col("doc_id").cast("long"), F.col("toxic").cast("int"))
        .filter("doc_id IS NOT NULL AND toxic IN (0, 1)")
        .groupBy("doc_id")
        .agg(F.max("toxic").alias("toxic"))
    )
    last = last_place(train_rows, max(1, marked.count()))
    chosen = marked.filter(F.xxhash64("doc_id", F.lit(9)) <= last)
    # At most about train_rows rows of two numbers, since each doc_id is there once.
    texts = stored(
        texts_of(docs)
        .join(F.broadcast(chosen), "doc_id")
        .select("doc_id", "toxic", "text", F.xxhash64("text").alias("h")),
        "toxic-train",
    )
    # One row per text, whichever documents repeat it and however often.
    train = (
        texts.groupBy("h")
        .agg(F.min(F.struct("doc_id", "toxic", "text")).alias("row"))
        .select("row.*", F.expr("pmod(h, 3) = 0").alias("hold"))
    )
    model = _odds(train.filter("NOT hold"))
    return _calibrated(train.filter("hold"), model)


def _odds(train: DataFrame) -> ToxicityModel:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros((2, 2, SLOTS), dtype=np.int64)
        docs = np.zeros(2, dtype=np.int64)
        for batch in slices(batches, "text"):
            codes, distinct, starts = words_of(batch.column("text"))
            toxic = batch.column("toxic").to_pylist()
            for kind, slots in enumerate(_slots(distinct)):
                for t, s, e in zip(toxic, starts[:-1], starts[1:], strict=True):
                    counts[kind, t, np.unique(slots[codes[s:e]])] += 1
            for t in toxic:
                docs[t] += 1
        for kind in range(2):
            used = np.flatnonzero(counts[kind].any(axis=0))
            yield pa.RecordBatch.from_arrays(
                [pa.array(used + kind * SLOTS), *(pa.array(counts[kind, t, used]) for t in (0, 1))],
                ["slot", "clean", "toxic"],
            )
        yield pa.RecordBatch.from_arrays(
            [pa.array([-1]), pa.array(docs[:1]), pa.array(docs[1:])], ["slot", "clean", "toxic"]
        )

    rows = (
        train.select("text", "toxic")
        .mapInArrow(run, "slot long, clean long, toxic long")
        .groupBy("slot")
        .agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic"))
        .toPandas()
    )
    clean, toxic = np.zeros(2 * SLOTS), np.zeros(2 * SLOTS)
    kept = rows["slot"] >= 0
    slot = rows["slot"][kept].to_numpy(dtype=np.int64)
    clean[slot], toxic[slot] = rows["clean"][kept], rows["toxic"][kept]
    docs = rows[~kept]
    if docs.empty or not docs["clean"].sum() or not docs["toxic"].sum():
        return ToxicityModel(np.zeros(SLOTS, np.float32), np.zeros(SLOTS, np.float32))
    odds = [
        _log_odds(toxic[k : k + SLOTS], clean[k : k + SLOTS]).astype(np.float32)
        for k in (0, SLOTS)
    ]
    return ToxicityModel(*odds)


def _log_odds(toxic: np.ndarray, clean: np.ndarray) -> np.ndarray:
    """Log-odds with a Dirichlet prior in proportion to both together; insignificant ones 0."""
    prior = PRIOR_SHARE * (toxic + clean) + 1e-9
    whole = prior.sum()

    def logit(counts: np.ndarray) -> np.ndarray:
        mass = counts + prior
        return np.log(mass) - np.log(np.maximum(counts.sum() + whole - mass, 1e-9))

    delta = logit(toxic) - logit(clean)
    spread = np.sqrt(1 / (toxic + prior) + 1 / (clean + prior))
    return np.where((toxic + clean > 0) & (np.abs(delta) >= Z_LEAST * spread), delta, 0.0)


def _calibrated(held: DataFrame, model: ToxicityModel) -> ToxicityModel:
    """The model with the law of chance and then the weights fitted on held-back texts.

    Two passes: the law needs the best segment of each clean text, and only with it is known
    which segments count as significant. The weights see the features that are scored.
    """

    def features_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            rows = []
            for n, found in _scored(batch.column("text"), model):
                best = max((s for _, _, s in found), default=0.0)
                rows.append((n, best, *_features(n, found, model)))
            columns = zip(*rows, strict=True) if rows else [[]] * 4
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("toxic"),
                    *(pa.array(c, t) for c, t in zip(columns, _HELD_TYPES, strict=True)),
                ],
                ["toxic", "n", "best", "significance", "many"],
            )

    def seen() -> list:
        schema = "toxic int, n long, best double, significance double, many double"
        rows = held.select("toxic", "text").mapInArrow(features_of, schema)
        return sorted(map(tuple, rows.collect()))

    first = seen()
    if len({r[0] for r in first}) < 2:
        return model
    clean = np.array([r[2] for r in first if not r[0]])
    length = np.array([math.log(max(r[1], 1)) for r in first if not r[0]])
    # Method of moments for the Gumbel law of S - log(m) / rate, the rate by fixed point.
    for _ in range(20):
        rest = clean - length / model.rate
        model.rate = min(3.0, max(0.3, math.pi / (math.sqrt(6) * max(rest.std(), 0.3))))
    model.log_k = float(model.rate * (clean - length / model.rate).mean() - np.euler_gamma)
    second = seen()
    x = np.array([(r[3], r[4], 1.0) for r in second])
    y = np.array([r[0] for r in second], dtype=float)
    w = np.array([0.1, 0.1, -1.0])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        gradient = x.T @ (p - y) + 1e-2 * w
        step = np.linalg.solve((x * (p * (1 - p) + 1e-6)[:, None]).T @ x + 1e-2 * np.eye(3), gradient)
        w = w - step
        if np.abs(step).max() < 1e-6:
            break
    model.weights = tuple(w.tolist())
    return model


def score(docs: DataFrame, model: ToxicityModel) -> DataFrame:
    """doc_id, score (0 to 1) and passages of every row.

    passages holds (first word, word after the last, score) of every segment whose chance of
    turning up in a clean text of that length is below 1 %. Null and empty texts and texts
    without words get the score of a text without passages. Rows that repeat come out as often
    as they came in; doc_id may be null; other columns are not read.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(
            pa.struct([("start", pa.int64()), ("end", pa.int64()), ("score", pa.float64())])
        )
        floor = -math.log(E_VALUE)
        for batch in slices(batches, "text"):
            chance, passages = [], []
            for n, found in _scored(batch.column("text"), model):
                shift = model.log_k + math.log(max(n, 1))
                chance.append(probability(n, found, model))
                passages.append(
                    [
                        {"start": s, "end": e, "score": v}
                        for s, e, v in found
                        if model.rate * v - shift >= floor
                    ]
                )
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(chance, pa.float64()), pa.array(passages, kind)],
                ["doc_id", "score", "passages"],
            )

    source = texts_of(docs)
    return source.mapInArrow(
        run, "doc_id long, score double, passages array<struct<start:long,end:long,score:double>>"
    )


def without_toxic(docs: DataFrame, model: ToxicityModel) -> DataFrame:
    """The rows of ``docs`` (any columns, in order) that score below 0.5."""
    names = docs.columns
    schema = docs.schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            keep = [probability(n, f, model) < 0.5 for n, f in _scored(batch.column("text"), model)]
            yield batch.filter(pa.array(keep))

    return docs.select(names).mapInArrow(run, schema)
