"""Fingerprints, toxicity, languages and URLs on small tables."""

import itertools
import random
import re

import numpy as np
import pytest
import xxhash

from sigweave.llm import langid, simhash, toxicity, urls
from sigweave.llm.common import components
from tests.conftest import rows_of

DOCS = "doc_id long, text string, lang string, fp string, score string, toxic string"


def _docs(spark, rows):
    return spark.createDataFrame([(i, t, g, "f", "s", "t") for i, t, g in rows], DOCS)


def _words(rng, n, letters="abcdefgh"):
    return " ".join("".join(rng.choices(letters, k=rng.randint(2, 7))) for _ in range(n))


def _print(text, words=4):
    found = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not found:
        return 0
    lines = [" ".join(found[i : i + words]) for i in range(len(found) - words + 1)]
    hashes = [xxhash.xxh64_intdigest(x.encode(), 42) for x in lines or [" ".join(found)]]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def test_near_duplicates_equal_brute_force(spark):
    rng = random.Random(1)
    rows = [(i, _words(rng, 300), "en") for i in range(20)]
    for i in range(40):
        words = rng.choice(rows)[1].split()
        for _ in range(rng.randint(0, 3)):
            words[rng.randrange(len(words))] = "changed"
        rows.append((100 + i, " ".join(words), "en"))
    rows += [(200, None, None), (201, "", "en"), (202, " \n\t ", "en"), (203, "One TWO", "en")]
    rows += [(204, "one two", "en"), (None, rows[0][1], "en"), rows[5], rows[5]]
    rows += [(205, _words(rng, 40_000), "en"), (206, "\u00a0a\u00a0 É x y z", "fr")]
    prints = [_print(t) for _, t, _ in rows]
    part = list(range(len(rows)))
    for a, b in itertools.combinations(range(len(rows)), 2):
        if (prints[a] ^ prints[b]).bit_count() <= 4:
            part = [part[a] if p == part[b] else p for p in part]
    first = {}
    for p, (i, _, _) in zip(part, rows, strict=True):
        if i is not None:
            first[p] = min(i, first.get(p, i))
    expected = [
        (i, f"{f:016x}", first.get(p)) for (i, _, _), f, p in zip(rows, prints, part, strict=True)
    ]
    found = simhash.near_duplicates(_docs(spark, rows))
    assert rows_of(found) == sorted(expected, key=repr)


def test_no_documents(spark):
    assert simhash.near_duplicates(_docs(spark, [])).count() == 0


@pytest.mark.parametrize("short", [0, 1000])
def test_links_of_crowded_buckets(spark, monkeypatch, short):
    monkeypatch.setattr(simhash, "CELL_ROWS", 64)
    monkeypatch.setattr(simhash, "SHORT_RUN", short)
    rng = random.Random(2)
    heads = [rng.getrandbits(64) for _ in range(30)]
    prints = set()
    for h in heads * 30:
        for b in rng.sample(range(64), rng.randint(0, 5)):
            h ^= 1 << b
        prints.add(h)
    prints = sorted(prints)
    part = {p: p for p in prints}
    for a, b in itertools.combinations(prints, 2):
        if (a ^ b).bit_count() <= 4 and part[a] != part[b]:
            old, new = part[b], part[a]
            part = {k: new if v == old else v for k, v in part.items()}
    ids = {p: n for n, p in enumerate(prints)}
    first = {}
    for p in prints:
        first[part[p]] = min(ids[p], first.get(part[p], ids[p]))
    signed = [(ids[p], p - (1 << 64) if p >> 63 else p) for p in prints]
    found = simhash.near_groups(spark.createDataFrame(signed, "doc_id long, fp long"))
    assert {r.doc_id: r.component_id for r in found.collect()} == {
        ids[p]: first[part[p]] for p in prints
    }


def test_pivots_never_discard_a_link():
    rng = np.random.default_rng(3)
    a = rng.integers(0, 2**63, 500, dtype=np.uint64)
    b = a ^ np.uint64(0b1011) ^ (np.uint64(1) << np.uint64(60))
    table = simhash.pivot_table(np.concatenate([a, b]))
    kept = simhash._survivors(table, np.arange(500), np.arange(500, 1000), 4)
    assert len(kept) == 500


def test_components_of_a_long_chain_and_a_star(spark):
    edges = [(i, i + 1) for i in range(200)] + [(1000, 1000 + i) for i in range(1, 300)] + [(5, 5)]
    found = dict(rows_of(components(spark.createDataFrame(edges, "a long, b long"))))
    assert found == {**dict.fromkeys(range(1, 201), 0), **dict.fromkeys(range(1001, 1300), 1000)}


def _toxic_rows(n, seed):
    rng = random.Random(seed)
    rows, marks = [], []
    for i in range(n):
        words = _words(rng, rng.randint(10, 80)).split()
        bad = i % 5 == 0
        for _ in range(3 * bad):
            words.insert(rng.randrange(len(words)), rng.choice(["Zork", "zorky!", "quux"]))
        rows.append((i, " ".join(words), "en"))
        marks.append((i, 1, int(bad), "clash"))
    return rows, marks


LABELS = "doc_id long, quality int, toxic int, text string"


def test_toxicity_on_documents_not_seen(spark):
    rows, marks = _toxic_rows(1500, 4)
    labels = spark.createDataFrame([m for m in marks if m[0] % 3], LABELS)
    labels = labels.union(spark.createDataFrame([(None, 1, 1, ""), (3, 1, None, "")], LABELS))
    docs = _docs(spark, rows)
    model = toxicity.fit(docs, labels)
    found = {r.doc_id: r for r in toxicity.score(docs, model).collect()}
    wrong = [i for i, _, bad, _ in marks if i % 3 == 0 and (found[i].score >= 0.5) != bool(bad)]
    assert len(wrong) <= 5
    words = re.split(r"[\W\d_]+", rows[0][1].lower())
    assert any(w.startswith(("zork", "quux")) for p in found[0].passages for w in words[p.start : p.end])
    kept = {r.doc_id for r in toxicity.without_toxic(docs, model).collect()}
    assert kept == {i for i, r in found.items() if r.score < 0.5}


def test_toxicity_of_odd_texts(spark):
    rows, marks = _toxic_rows(300, 5)
    odd = [(1, None, None), (2, "", "en"), (3, "123 --", "en"), (None, "zork quux zorky", "en")]
    odd += [(4, "zork " * 60_000, "en"), (4, "zork " * 60_000, "en")]
    model = toxicity.fit(_docs(spark, rows), spark.createDataFrame(marks, LABELS))
    found = toxicity.score(_docs(spark, odd), model).collect()
    assert len(found) == 6 and all(0 <= r.score <= 1 for r in found)
    by_id = {r.doc_id: r.score for r in found}
    assert by_id[1] == by_id[2] < 0.5 <= by_id[4]
    assert toxicity.score(_docs(spark, []), model).count() == 0


def test_repeated_rows_teach_once(spark):
    rows, marks = _toxic_rows(300, 9)
    labels = spark.createDataFrame(marks, LABELS)
    once = toxicity.fit(_docs(spark, rows), labels)
    often = toxicity.fit(_docs(spark, rows + rows[:40] * 5), labels)
    assert np.array_equal(once.word_odds, often.word_odds) and once.weights == often.weights
    rows = _language_rows(120, 10)
    once, often = (langid.fit(_docs(spark, r)) for r in (rows, rows + rows[:9] * 6))
    assert np.array_equal(once.logits, often.logits)


def test_toxicity_without_labels(spark):
    rows, _ = _toxic_rows(20, 6)
    model = toxicity.fit(_docs(spark, rows), spark.createDataFrame([], LABELS))
    assert all(r.score < 0.5 for r in toxicity.score(_docs(spark, rows), model).collect())


def test_segments_equal_brute_force():
    rng = np.random.default_rng(6)
    for _ in range(200):
        scores = rng.integers(-4, 5, 14).astype(float)
        found = toxicity.segments(scores)
        best = max(
            (scores[a:b].sum() for a in range(14) for b in range(a + 1, 15)), default=0.0
        )
        assert max((s for *_, s in found), default=0.0) == max(best, 0.0)
        assert all(scores[a:b].sum() == s > 0 for a, b, s in found)
        assert all(x[1] <= y[0] for x, y in itertools.pairwise(found))


def _language_rows(n, seed):
    rng = random.Random(seed)
    letters = {"aa": "abcde", "bb": "cdefg", "cc": "éèçab"}
    return [(i, _words(rng, 60, letters[g]), g) for i in range(n) for g in [rng.choice("abc") * 2]]


def test_languages_on_documents_not_seen(spark):
    rows = _language_rows(600, 7)
    model = langid.fit(_docs(spark, rows[:400] + [(9000, None, "aa"), (9001, "abc", None)]))
    assert model.languages == ["aa", "bb", "cc"]
    found = {r.doc_id: r for r in langid.identify(_docs(spark, rows[400:]), model).collect()}
    assert all(found[i].lang_pred == g and not found[i].rejected for i, _, g in rows[400:])


def test_languages_of_odd_texts(spark):
    model = langid.fit(_docs(spark, _language_rows(200, 8)))
    odd = [(1, None, None), (2, "", "aa"), (3, "12 !?", "aa"), (4, "a", "aa"), (5, "русский язык", "")]
    odd += [(6, "abced " * 300_000, "aa"), (None, "éèçab éèç", "x")]
    found = {r.doc_id: r for r in langid.identify(_docs(spark, odd), model).collect()}
    for i in (1, 2, 3):
        assert (found[i].lang_pred, found[i].score, found[i].rejected) == ("und", 0.0, True)
    assert found[5].rejected and not found[6].rejected
    assert all(0 <= r.score <= 1 for r in found.values())
    kept = langid.without_unknown(_docs(spark, odd), model)
    assert kept.columns == DOCS.replace(" long", "").replace(" string", "").split(", ")
    nothing = langid.fit(_docs(spark, []))
    assert [r.lang_pred for r in langid.identify(_docs(spark, odd[3:4]), nothing).collect()] == ["und"]


def test_gram_counts_do_not_depend_on_pieces(monkeypatch):
    text = _words(random.Random(9), 300)
    whole = langid.gram_counts(text)
    monkeypatch.setattr(langid, "PIECE", 17)
    assert (langid.gram_counts(text) == whole).all()


PAGES = "page_id long, url string, html string, host string, rule string"


def test_urls_and_rules(spark):
    cases = {
        "https://A.Example.NET/en/x?q": ("a.example.net", "/en/x", "example.net/en/", "allow"),
        "http://example.net/de/": ("example.net", "/de/", "net/", "block"),
        "http://notexample.net": ("notexample.net", "", None, None),
        "x://example.com/de/1#a": ("example.com", "/de/1", "example.com/de/", "block"),
        "x://badexample.com/de/1": ("badexample.com", "/de/1", None, None),
        "x://b.org/fr/": ("b.org", "/fr/", "org/fr/", "allow"),
        "x://b.org/FR/": ("b.org", "/FR/", None, None),
        "u://h?/x://y": ("h", "", None, None),
        "no scheme/net/": ("", "", None, None),
        "": ("", "", None, None),
        None: ("", "", None, None),
    }
    rows = [(i, u, "h", "clash", "clash") for i, u in enumerate(cases)]
    found = urls.judge(spark.createDataFrame(rows + rows[:1], PAGES)).collect()
    assert len(found) == len(rows) + 1
    for r in found:
        host, path, rule, verdict = list(cases.values())[r.page_id]
        assert (r.host, r.path, r.rule) == (host, path, rule)
        assert r.verdict == (verdict or r.verdict) and r.verdict in ("allow", "block")
    assert urls.judge(spark.createDataFrame([], PAGES)).count() == 0


def test_trees_learn_from_labelled_urls(spark):
    rng = random.Random(10)
    rows = []
    for i in range(600):
        bad = i % 3 == 0
        name = "".join(rng.choices("0123456789" if bad else "abcdefgh", k=9))
        rows.append((i, f"http://{name}.example.info/{'a/' * rng.randint(0, 3)}", int(bad)))
    table = spark.createDataFrame(rows, "page_id long, url string, blocked int")
    found = urls.judge(table.filter("page_id >= 400"), table.filter("page_id < 400").drop("page_id"), [])
    assert all((r.verdict == "block") == (r.page_id % 3 == 0) for r in found.collect())


def test_margin_of_trees_equals_growing():
    rng = np.random.default_rng(11)
    x = rng.normal(size=(300, len(urls.FEATURES)))
    y = (x[:, 3] + x[:, 5] > 0).astype(float)
    assert (((urls.grow(x, y).margin(x) > 0) == y).mean()) > 0.95


def test_without_labels_all_is_allowed(spark):
    pages = spark.createDataFrame([(1, "http://a.com/x"), (2, None), (3, "http://b.net/")], "page_id long, url string")
    none = spark.createDataFrame([], "url string, blocked int")
    found = {r.page_id: r.verdict for r in urls.judge(pages, none).collect()}
    assert found == {1: "allow", 2: "allow", 3: "block"}


def test_copies_of_a_url_are_one_drawn_row(spark, monkeypatch):
    rows = [(f"http://h{i}.info/{'9' * (i % 7)}", i % 2) for i in range(300)]
    rows += [("http://h1.info/9", 1)] * 5000
    seen, plain = [], urls.grow
    monkeypatch.setattr(urls, "grow", lambda x, y: seen.append(len(y)) or plain(x, y))
    labelled = spark.createDataFrame(rows, "url string, blocked int")
    urls.judge(spark.createDataFrame([(1, "http://a.com/")], "page_id long, url string"), labelled).collect()
    assert seen == [300]


def test_many_toxic_words_in_a_text(spark):
    rng = random.Random(12)
    clean = [f"c{rng.randrange(200)}" for _ in range(200)]

    def text(toxic):
        words = rng.choices(clean, k=400)
        if toxic:
            for at in range(0, 400, 10):
                words[at : at + 2] = ["vile", "scum"]
        return "".join(chr(97 + int(c)) if c.isdigit() else c for c in " ".join(words))

    rows = [(i, text(i % 4 == 0), "en") for i in range(240)]
    labels = spark.createDataFrame([(i, int(i % 4 == 0)) for i in range(240)], "doc_id long, toxic int")
    model = toxicity.fit(_docs(spark, rows), labels)
    scored = {r.doc_id: r for r in toxicity.score(_docs(spark, rows), model).collect()}
    assert all((scored[i].score >= 0.5) == (i % 4 == 0) for i in range(240))
    assert all(bool(scored[i].passages) == (i % 4 == 0) for i in range(240))
