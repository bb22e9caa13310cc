"""Quality from trusted positives and unlabelled text only (positive-unlabelled learning).

A linear model over shape features (how words repeat, capitals, symbols, marks, lengths) and
hashed words is trained to least non-negative unbiased risk: the loss of negatives is estimated
from the unlabelled texts less the share that the positives explain, and where that estimate
falls below zero on a batch the step goes back, as the model has begun to fit single texts. The
share of positives among the unlabelled texts (the class prior) is estimated on held-back texts:
a first model ranks positives before unlabelled ones, and in its best-ranked part nearly all
unlabelled texts are positives, so the ratio of both tails there bounds the share from above;
the tail whose bound, its sampling error included, is the least gives the estimate.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sigweave.llm.common import last_place, slices, texts_of
from sigweave.llm.tokens import split_words

BUCKETS = 1 << 12
# Documented bound of the texts of each kind, positive and unlabelled, that a model is fitted on.
TRAIN_ROWS = 6000
EPOCHS = 12
BATCH = 256
RATE = 0.02
WORD_RATE = 0.25
DECAY = 1e-4
CONFIDENCE = 0.1
# What is counted in each word: capitals, digits, symbols, letters, end marks.
_PATTERNS = [r"\p{Lu}", r"\p{Nd}", r"[^\p{L}\p{M}\p{Nd}.,;:!?'’\"()-]", r"\p{L}", r"[.!?]$", r"[!?]"]
SHAPES = 16


@dataclass
class QualityModel:
    mean: np.ndarray = field(default_factory=lambda: np.zeros(SHAPES, np.float32))
    spread: np.ndarray = field(default_factory=lambda: np.ones(SHAPES, np.float32))
    shape: np.ndarray = field(default_factory=lambda: np.zeros(SHAPES, np.float32))
    words: np.ndarray = field(default_factory=lambda: np.zeros(BUCKETS, np.float32))
    bias: float = 0.0
    prior: float = 0.5


def _bucket(word: str) -> int:
    return xxhash.xxh64_intdigest(word.lower().encode("utf-8", "surrogatepass"), 12) % BUCKETS


def features(texts: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Shapes, and buckets and weights (of length one) of the words, of each whole text."""
    codes, distinct, starts = split_words(texts)
    words = pa.array(distinct, pa.large_string())
    per_word = np.stack(
        [
            pc.utf8_length(words).to_numpy(zero_copy_only=False),
            *(pc.count_substring_regex(words, p).to_numpy(zero_copy_only=False) for p in _PATTERNS),
        ]
    ).astype(np.float64) if distinct else np.zeros((1 + len(_PATTERNS), 0))
    bucket = np.fromiter((_bucket(w) for w in distinct), dtype=np.int64, count=len(distinct))
    lines = pc.count_substring(pc.fill_null(texts.cast(pa.large_string()), ""), "\n").to_numpy(
        zero_copy_only=False
    )
    bounds = zip(starts[:-1].tolist(), starts[1:].tolist(), lines.tolist(), strict=True)
    for s, e, breaks in bounds:
        own = codes[s:e]
        # Texts without words begin or end with the split's empty word.
        own = own[per_word[0, own] > 0] if len(own) else own
        n = len(own)
        if not n:
            yield np.eye(1, SHAPES, SHAPES - 1, dtype=np.float32)[0], own[:0], np.zeros(0, np.float32)
            continue
        kinds, count = np.unique(own, return_counts=True)
        sums = per_word[:, kinds] @ count
        chars, upper, digits, symbols, letters, ends, loud = sums / n
        length = np.log(n + 1)
        shape = [
            length,
            np.log(len(kinds) + 1) / length,
            (own[1:] == own[:-1]).mean() if n > 1 else 0.0,
            count.max() / n,
            (count == 1).sum() / len(kinds),
            chars,
            upper / chars,
            digits / chars,
            symbols / chars,
            letters / chars,
            ends,
            loud,
            (count * (per_word[1, kinds] > 1)).sum() / n,
            (count * (per_word[3, kinds] > 0)).sum() / n,
            np.log1p(breaks) / length,
            0.0,
        ]
        weight = np.bincount(bucket[kinds], weights=np.log1p(count), minlength=BUCKETS)
        used = np.flatnonzero(weight)
        values = weight[used] / np.sqrt((weight[used] ** 2).sum())
        yield np.array(shape, np.float32), used, values.astype(np.float32)


def logits(texts: pa.Array, model: QualityModel) -> np.ndarray:
    found = []
    for shape, used, values in features(texts):
        z = np.clip((shape - model.mean) / model.spread, -5, 5)
        found.append(float(z @ model.shape + values @ model.words[used]) + model.bias)
    return np.array(found)


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(z, -30, 30)))


def fit(docs: DataFrame, labels: DataFrame, rows: int = TRAIN_ROWS, seed: int = 3) -> QualityModel:
    """Model from ``docs`` (doc_id, text) and ``labels`` (doc_id, quality).

    Positives are the documents with quality 1 in one of their labels and 0 in none. Unlabelled
    are those without a label row; those with a null quality or 0 teach nothing. If every
    document has a label, all with a quality are taken as unlabelled. About ``rows`` different
    texts of each kind are used, drawn by a hash of the text, so that copies count once. A third
    of them estimates the class prior. Without a positive or any other text the model scores
    every text alike, 0.5.
    """
    marks = (
        labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("quality").cast("int"))
        .filter("doc_id IS NOT NULL")
        .groupBy("doc_id")
        .agg(F.min("quality").alias("least"), F.lit(True).alias("marked"))
    )
    texts = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")
    ).filter("text IS NOT NULL")
    place = F.xxhash64("text", F.lit(11))
    # Only names and hashes meet the labels; texts are read again for the drawn ones.
    kinds = (
        texts.select("doc_id", place.alias("place"))
        .join(marks, "doc_id", "left")
        .select(
            "place",
            F.when(F.col("marked").isNull(), "unlabelled")
            .when(F.col("least") == 1, "positive")
            .when(F.col("least") == 0, "negative")
            .alias("kind"),
        )
        .filter("kind IS NOT NULL")
        .distinct()
    )
    sizes = {r["kind"]: r["count"] for r in kinds.groupBy("kind").count().collect()}
    other = ["unlabelled"] if sizes.get("unlabelled") else ["positive", "negative"]
    n_other = sum(sizes.get(k, 0) for k in other)
    if not sizes.get("positive") or not n_other:
        return QualityModel()
    at = F.col("place")
    is_positive = (F.col("kind") == "positive") & (at <= last_place(rows, sizes["positive"]))
    is_other = F.col("kind").isin(other) & (at <= last_place(rows, n_other))
    # At most about twice ``rows`` hashes.
    drawn = (
        kinds.select("place", is_positive.alias("positive"), is_other.alias("other"))
        .groupBy("place")
        .agg(F.max("positive").alias("positive"), F.max("other").alias("other"))
        .filter("positive OR other")
    )
    chosen = texts.withColumn("place", place).join(F.broadcast(drawn), "place")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            out = list(features(batch.column("text")))
            yield pa.RecordBatch.from_arrays(
                [
                    *(batch.column(c) for c in ("place", "positive", "other")),
                    pa.array([s.astype("<f4").tobytes() for s, _, _ in out], pa.binary()),
                    pa.array([u.astype("<u2").tobytes() for _, u, _ in out], pa.binary()),
                    pa.array([v.astype("<f2").tobytes() for _, _, v in out], pa.binary()),
                ],
                ["place", "positive", "other", "shape", "used", "weight"],
            )

    schema = "place long, positive boolean, other boolean, shape binary, used binary, weight binary"
    # Copies are merged before the driver sees them; packed numbers are small.
    once = (
        chosen.select("place", "positive", "other", "text")
        .mapInArrow(run, schema)
        .dropDuplicates(["place"])
    )
    data = sorted(
        (r.place, r.positive, r.other, bytes(r.shape), bytes(r.used), bytes(r.weight))
        for r in once.toLocalIterator()
    )
    return train(data, seed)


class _Set:
    """Packed texts of one kind."""

    def __init__(self, rows: list[tuple], mean: np.ndarray, spread: np.ndarray):
        shapes = np.stack([np.frombuffer(r[3], "<f4") for r in rows])
        self.shapes = np.clip((shapes - mean) / spread, -5, 5)
        self._words = [(np.frombuffer(r[4], "<u2"), np.frombuffer(r[5], "<f2")) for r in rows]

    def __len__(self) -> int:
        return len(self._words)

    def batch(self, at: np.ndarray) -> np.ndarray:
        """Features of some texts as rows, bias last."""
        out = np.zeros((len(at), SHAPES + BUCKETS + 1), np.float32)
        out[:, :SHAPES] = self.shapes[at]
        for row, i in enumerate(at.tolist()):
            used, values = self._words[i]
            out[row, SHAPES + used] = values * np.float32(WORD_RATE)
        out[:, -1] = 1.0
        return out

    def scores(self, weights: np.ndarray) -> np.ndarray:
        return np.concatenate(
            [
                self.batch(np.arange(s, min(s + BATCH, len(self)))) @ weights
                for s in range(0, len(self), BATCH)
            ]
        )


def _descend(positive: _Set, other: _Set, prior: float | None, seed: int) -> np.ndarray:
    """Weights of least risk; without ``prior`` those that part positives from the others."""
    rng = np.random.default_rng(seed)
    weights = np.zeros(SHAPES + BUCKETS + 1)
    first, second, step = np.zeros_like(weights), np.zeros_like(weights), 0
    batches = max(1, -(-max(len(positive), len(other)) // BATCH))
    for epoch in range(EPOCHS):
        orders = [np.array_split(np.resize(rng.permutation(len(s)), max(len(positive), len(other))), batches) for s in (positive, other)]
        for p_at, u_at in zip(*orders, strict=True):
            p, u = positive.batch(p_at), other.batch(u_at)
            zp, zu = p @ weights, u @ weights
            # Slopes of log(1 + exp(-z)) and log(1 + exp(z)).
            p_as_one, p_as_zero = -_sigmoid(-zp) @ p / len(zp), _sigmoid(zp) @ p / len(zp)
            u_as_zero = _sigmoid(zu) @ u / len(zu)
            if prior is None:
                slope = p_as_one + u_as_zero
            else:
                risk = np.logaddexp(0, zu).mean() - prior * np.logaddexp(0, zp).mean()
                if risk >= 0:
                    slope = prior * p_as_one + u_as_zero - prior * p_as_zero
                else:
                    slope = prior * p_as_zero - u_as_zero
            slope = slope + DECAY * weights
            step += 1
            first = 0.9 * first + 0.1 * slope
            second = 0.999 * second + 0.001 * slope**2
            rate = RATE * (1 - epoch / EPOCHS)
            weights = weights - rate * (first / (1 - 0.9**step)) / (
                np.sqrt(second / (1 - 0.999**step)) + 1e-8
            )
    return weights


def class_prior(positive: np.ndarray, other: np.ndarray) -> float:
    """Share of positives among ``other`` from scores that rank positives first."""
    slack = np.sqrt(np.log(4 / CONFIDENCE) / 2)
    slack = slack / np.sqrt(len(positive)) + slack / np.sqrt(len(other))
    cuts = np.unique(np.concatenate([positive, other]))
    tail_p = 1 - np.searchsorted(np.sort(positive), cuts, side="left") / len(positive)
    tail_u = 1 - np.searchsorted(np.sort(other), cuts, side="left") / len(other)
    used = tail_p > 0
    bound = (tail_u[used] + slack) / tail_p[used]
    best = int(np.argmin(bound))
    return float(np.clip(tail_u[used][best] / tail_p[used][best], 0.01, 0.99))


def train(data: list[tuple], seed: int = 3) -> QualityModel:
    """Model from packed texts: place, is positive, is unlabelled, shape, buckets, weights."""
    shapes = np.stack([np.frombuffer(r[3], "<f4") for r in data])
    mean, spread = shapes.mean(axis=0), np.maximum(shapes.std(axis=0), 1e-3)

    def part(kind: int, held: bool) -> _Set:
        rows = [r for r in data if r[kind]]
        some = [r for n, r in enumerate(rows) if (n % 3 == 0) == held] or rows
        return _Set(some, mean, spread)

    positive, other = part(1, False), part(2, False)
    ranking = _descend(positive, other, None, seed)
    prior = class_prior(part(1, True).scores(ranking), part(2, True).scores(ranking))
    weights = _descend(positive, other, prior, seed)
    return QualityModel(
        mean,
        spread,
        weights[:SHAPES].astype(np.float32),
        (weights[SHAPES:-1] * WORD_RATE).astype(np.float32),
        float(weights[-1]),
        prior,
    )


def score(docs: DataFrame, model: QualityModel) -> DataFrame:
    """doc_id and score (0 to 1, higher: better) of every row of ``docs``.

    Null and empty texts and texts without a word have a score of their own kind; very long
    texts are read whole. Rows that repeat come out as often as they came in; doc_id may be
    null; other columns are not read. An empty table has no rows.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            found = _sigmoid(logits(batch.column("text"), model))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(found, pa.float64())], ["doc_id", "score"]
            )

    return texts_of(docs).mapInArrow(run, "doc_id long, score double")
