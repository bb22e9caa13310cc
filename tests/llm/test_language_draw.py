"""The texts that the language model is fitted on."""

import random

from sigweave.llm import langid


def _drawn(spark, monkeypatch, rows, most):
    held = []
    monkeypatch.setattr(langid, "train", lambda data, languages, seed: held.extend(
        languages[y] for *_, y in data
    ))
    langid.fit(spark.createDataFrame(rows, "text string, lang string"), most)
    return {g: held.count(g) for g in set(held)}


def _texts(n, seed):
    rng = random.Random(seed)
    return [" ".join("".join(rng.choices("abcdefgh", k=6)) for _ in range(8)) for _ in range(n)]


def test_copies_do_not_thin_the_draw(spark, monkeypatch):
    rows = [(t, "aa") for t in _texts(600, 1)] + [("one hot text", "aa")] * 30_000
    rows += [(t, "bb") for t in _texts(50, 2)] + [(f"{i} !", "bb") for i in range(3000)]
    found = _drawn(spark, monkeypatch, rows, 100)
    assert 70 <= found["aa"] <= 130
    assert found["bb"] == 50


def test_limit_at_any_size():
    for n in (1, 600, 601, 10**6, 10**9, 10**13):
        share = (langid.last_place(600, n) + 1 + (1 << 63)) / (1 << 64)
        assert abs(share * n - min(n, 600)) < 1e-3
    assert langid.last_place(600, 600) == (1 << 63) - 1


def test_java_and_python_agree_on_letters(spark):
    texts = [chr(c) for c in range(1, 0x3000) if not 0xD800 <= c < 0xE000]
    rows = spark.createDataFrame([(t,) for t in texts], "text string")
    found = {r.text for r in rows.filter(rows.text.rlike(langid._LETTER_JAVA)).collect()}
    differ = found ^ {t for t in texts if langid.has_letter(t)}
    # Letters that only one of the two Unicode versions knows.
    assert len(differ) < 100
