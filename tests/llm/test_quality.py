"""Quality by positive-unlabelled learning: features, prior, held-out accuracy, odd rows."""

from __future__ import annotations

import random
import zlib

import numpy as np
import pyarrow as pa
import pytest

from sigweave.llm import quality, queries

DOCS = "doc_id long, text string, place long, positive string, score string"
LABELS = "doc_id long, quality int, text string"


def _text(rng, good: bool) -> str:
    words = ["".join(rng.choices("aeioubcdlmnrst", k=rng.randint(1, 9))) for _ in range(rng.randint(30, 200))]
    if good:
        return ". ".join(" ".join(words[i : i + 9]).capitalize() for i in range(0, len(words), 9)) + "."
    kind = rng.randrange(3)
    if kind == 0:
        return " ".join(w for w in words[:6] for _ in range(20))
    if kind == 1:
        return " ".join(w.upper() + "!!" for w in words)
    return " ".join(w + rng.choice(["$$$", "###"]) for w in words)


def _corpus(n: int, share: float, labelled: float, seed: int):
    """Documents, true kinds, and labels of some good ones only."""
    rng = random.Random(seed)
    truth = [rng.random() < share for _ in range(n)]
    docs = [(i, _text(rng, t), 5, "p", "s") for i, t in enumerate(truth)]
    labels = [(i, 1, "x") for i, t in enumerate(truth) if t and rng.random() < labelled]
    return docs, truth, labels


@pytest.mark.parametrize("share", [0.4, 0.8])
def test_learns_from_positives_and_unlabelled_only(spark, share):
    docs, truth, labels = _corpus(1500, share, 0.3, 1)
    model = quality.fit(spark.createDataFrame(docs, DOCS), spark.createDataFrame(labels, LABELS))
    # Labelled positives are not among the unlabelled, whose share is therefore lower.
    left = (share - share * 0.3) / (1 - share * 0.3)
    assert abs(model.prior - left) < 0.12
    fresh, kinds, _ = _corpus(400, share, 0, 2)
    scores = {r.doc_id: r.score for r in quality.score(spark.createDataFrame(fresh, DOCS), model).collect()}
    right = sum((scores[i] >= 0.5) == t for i, t in enumerate(kinds))
    assert right >= 0.97 * len(kinds)
    assert all(0 <= s <= 1 for s in scores.values())


def test_prior_of_known_mixtures():
    rng = np.random.default_rng(0)
    for share in (0.2, 0.5, 0.9):
        n = 4000
        positive = rng.normal(3, 1, n)
        other = np.where(rng.random(n) < share, rng.normal(3, 1, n), rng.normal(-3, 1, n))
        assert abs(quality.class_prior(positive, other) - share) < 0.06
    # Nothing parts the two: all others may be positives.
    assert quality.class_prior(rng.normal(0, 1, 4000), rng.normal(0, 1, 4000)) > 0.9


def test_features_of_a_text():
    text = "One two two TWO? $5!\nend."
    (shape, used, values), empty, blank, null = quality.features(pa.array([text, "", " \n ", None]))
    words = text.split()
    chars = sum(map(len, words))
    assert shape[0] == pytest.approx(np.log(len(words) + 1))
    assert shape[2] == pytest.approx(1 / 5)
    assert shape[3] == pytest.approx(2 / 6)
    assert shape[5] == pytest.approx(chars / 6)
    assert shape[6] == pytest.approx(sum(c.isupper() for c in text) / chars)
    assert shape[7] == pytest.approx(1 / chars)
    assert shape[8] == pytest.approx(1 / chars)
    # The same words in another case share a bucket.
    assert len(used) == len({w.lower() for w in words}) and (values**2).sum() == pytest.approx(1, 1e-4)
    for shape, used, values in (empty, blank, null):
        assert shape[-1] == 1 and not shape[:-1].any() and not len(used) and not len(values)


def test_slices_do_not_change_a_text(spark):
    rng = random.Random(3)
    texts = [_text(rng, i % 2 == 0) for i in range(30)] + ["", None]
    together = list(quality.features(pa.array(texts)))
    for text, (shape, used, values) in zip(texts, together, strict=True):
        ((one, at, weight),) = quality.features(pa.array([text], pa.string()))
        assert np.allclose(one, shape) and (at == used).all() and np.allclose(weight, values)


def test_odd_rows_and_tables(spark):
    docs, _, labels = _corpus(300, 0.6, 0.5, 4)
    docs += [(None, "no name", 1, "p", "s"), (900, None, 1, "p", "s"), (901, "", 1, "p", "s"), docs[3], docs[3]]
    docs += [(902, "long text. " * 150_000, 1, "p", "s"), (903, " ", 1, "p", "s")]
    labels += [(None, 1, "x"), (900, 1, "x"), labels[0], (labels[1][0], 0, "x"), (5, None, "x")]
    df = spark.createDataFrame(docs, DOCS)
    model = quality.fit(df, spark.createDataFrame(labels, LABELS))
    rows = quality.score(df, model).collect()
    assert sorted((r.doc_id is None, r.doc_id or 0) for r in rows) == sorted(
        (d[0] is None, d[0] or 0) for d in docs
    )
    by_id = {r.doc_id: r.score for r in rows}
    assert by_id[900] == by_id[901] and all(0 <= s <= 1 for s in by_id.values())
    # The same rows in another order give the same model.
    again = quality.fit(
        spark.createDataFrame(docs[::-1], DOCS), spark.createDataFrame(labels[::-1], LABELS)
    )
    assert np.array_equal(again.words, model.words) and again.bias == model.bias
    empty_docs, empty_labels = spark.createDataFrame([], DOCS), spark.createDataFrame([], LABELS)
    plain = quality.fit(df, empty_labels)
    assert {r.score for r in quality.score(df, plain).collect()} == {0.5}
    assert quality.score(empty_docs, quality.fit(empty_docs, empty_labels)).count() == 0


def test_copies_count_once(spark, monkeypatch):
    """A text repeated many times is one drawn text."""
    monkeypatch.setattr(quality, "TRAIN_ROWS", 100)
    docs, _, labels = _corpus(200, 0.6, 0.5, 5)
    many = [(10_000 + i, docs[0][1], 1, "p", "s") for i in range(3000)]
    seen = {}
    plain_train = quality.train
    monkeypatch.setattr(quality, "train", lambda data, seed: seen.update(n=len(data)) or plain_train(data, seed))
    quality.fit(spark.createDataFrame(docs + many, DOCS), spark.createDataFrame(labels, LABELS), rows=100)
    assert 60 <= seen["n"] <= 300


def test_registered_query(spark, sf_dir, duck):
    rows = {r.doc_id: r for r in queries.QUERIES["op12_quality"](spark, sf_dir).collect()}
    docs = duck.execute("SELECT count(*) FROM documents").fetchone()[0]
    assert len(rows) == docs
    assert all(r.held_out == (zlib.crc32(str(i).encode()) % 3 == 1) for i, r in rows.items())
    assert all(r.predicted == (r.score >= 0.5) and 0 <= r.score <= 1 for r in rows.values())
    held = [
        (rows[i].predicted, q)
        for i, q in duck.execute("SELECT doc_id, quality FROM labels").fetchall()
        if rows[i].held_out
    ]
    assert sum(p == q for p, q in held) >= 0.9 * len(held)
