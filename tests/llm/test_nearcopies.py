"""Near copies of the pipeline against brute force over five-word shingles."""

import random

import numpy as np
import pyarrow as pa

import corpus_pipeline
from sigweave.llm import nearcopies
from tests.conftest import rows_of

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def _docs(spark, rows):
    return spark.createDataFrame([(i, t, "en", "s", 9) for i, t in rows], DOCS)


def _shingles(text):
    words = (text or "").lower().split()
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def brute_roots(rows):
    """The smallest doc_id of the component of each of ``rows`` (different doc_ids)."""
    _, _, part, names = _linked(rows)
    return {i: names[p] for (i, _), p in zip(rows, part, strict=True)}


def _brute(rows):
    """Smallest doc_id of every component; links have a similarity of 0.8 or more."""
    return _linked(rows)[:2]


def _linked(rows):
    sets, part = [_shingles(t) for _, t in rows], list(range(len(rows)))
    pairs = 0
    for a in range(len(rows)):
        for b in range(a):
            shared, union = len(sets[a] & sets[b]), len(sets[a] | sets[b])
            if shared * 10 >= union * 8:
                pairs += sets[a] != sets[b]
                old, new = part[a], part[b]
                part = [new if p == old else p for p in part]
    names = {}
    for (i, _), p in zip(rows, part, strict=True):
        names[p] = min(i, names.get(p, i))
    return sorted((i,) for i in names.values()), pairs, part, names


def _variants(rng, heads, n, most):
    rows = [(i, " ".join(f"w{rng.randrange(5000)}" for _ in range(200))) for i in range(heads)]
    for i in range(heads, heads + n):
        words = rng.choice(rows[:heads])[1].split()
        for at in rng.sample(range(len(words)), rng.randint(0, most)):
            words[at] = f"x{rng.randrange(5000)}"
        rows.append((i, " ".join(words)))
    return rows


def test_near_copies_equal_brute_force(spark, sf_dir):
    rng = random.Random(3)
    rows = _variants(rng, 12, 90, 9)
    rows += [(500, None), (501, ""), (502, "a b c"), (503, "A  b c"), (504, "a b d")]
    rng.shuffle(rows)
    expected, pairs = _brute(rows)
    assert pairs > 50 and len(expected) < len(rows) - 20
    assert rows_of(corpus_pipeline.near_copies_out(spark, _docs(spark, rows), sf_dir), "doc_id") == sorted(
        expected, key=repr
    )


def test_large_group_of_near_copies(spark, sf_dir):
    rows = _variants(random.Random(4), 1, 250, 6)
    expected, _ = _brute(rows)
    found = corpus_pipeline.near_copies_out(spark, _docs(spark, rows), sf_dir)
    assert rows_of(found, "doc_id") == sorted(expected, key=repr)


def test_texts_that_share_a_doc_id(spark, sf_dir):
    one, two = (" ".join(f"{c}{i}" for i in range(50)) for c in "pq")
    # Document 7 has a copy of document 3's text and another text that nobody repeats.
    rows = [(3, one), (7, one), (7, two), (7, two)]
    for order in (rows, rows[::-1]):
        kept = corpus_pipeline.near_copies_out(spark, _docs(spark, order), sf_dir)
        assert rows_of(kept, "doc_id", "text") == [(3, one), (7, two)]


def test_shingles_are_sets_of_five_words():
    texts = ["a b c d e f", " A b\tc  D e F\n", "a b c d e f a b c d e f", "a b", "", None, "é É a b c d"]
    found = [nearcopies.shingles(w) for w in nearcopies.word_hashes(pa.array(texts))]
    assert [len(f) for f in found] == [len(_shingles(t)) for t in texts[:-1]] + [2]
    assert np.array_equal(found[0], found[1]) and set(found[0]) < set(found[2])
    nodes = [nearcopies.node_of(w) for w in nearcopies.word_hashes(pa.array(texts))]
    assert nodes[0] == nodes[1] and nodes[4] == nodes[5] and len(set(nodes)) == 5


def test_similar_sets_share_a_key_whatever_the_order():
    rng = np.random.default_rng(2)
    for _ in range(200):
        levels = rng.integers(0, 50, 1 << nearcopies.SLOT_BITS).astype(np.uint16)
        n = int(rng.integers(1, 120))
        common = rng.integers(0, 1 << 63, n, dtype=np.uint64)
        more = n // 4 - int(rng.integers(0, 3))
        one = np.unique(np.concatenate([common, rng.integers(0, 1 << 63, max(0, more), dtype=np.uint64)]))
        two = np.unique(common)
        if nearcopies.similar(one, two):
            assert np.intersect1d(nearcopies.prefix(one, levels), nearcopies.prefix(two, levels)).size


def _compared(monkeypatch):
    """Counts the pairs that are compared from now on."""
    seen, plain = [], nearcopies._compared

    def counted(pairs, sets):
        seen.append(pairs.count())
        return plain(pairs, sets)

    monkeypatch.setattr(nearcopies, "_compared", counted)
    return seen


def test_a_passage_in_many_texts_makes_few_pairs(spark, monkeypatch):
    """Different texts share most of their words, but the shared ones are no keys."""
    rng = random.Random(6)
    passage = " ".join(f"p{i}" for i in range(60))
    texts = [f"{passage} " + " ".join(f"w{rng.randrange(10**6)}" for _ in range(40)) for _ in range(400)]
    texts += [texts[0] + " end", texts[1] + " end"]
    seen = _compared(monkeypatch)
    docs = _docs(spark, list(enumerate(texts)))
    assert nearcopies.without_copies(docs).count() == 400
    assert 2 <= sum(seen) < 4 * len(texts)


def test_a_large_group_makes_few_pairs(spark, monkeypatch):
    rows = _variants(random.Random(7), 1, 400, 4)
    expected, pairs = _brute(rows)
    seen = _compared(monkeypatch)
    found = nearcopies.without_copies(_docs(spark, rows))
    assert rows_of(found, "doc_id") == sorted(expected, key=repr)
    assert sum(seen) < pairs / 10


def test_columns_of_any_name(spark):
    rows = [(1, "a b c d e", 1, 2, 3, 4), (2, "a b c d e", 1, 2, 3, 4), (2, "x", 5, 6, 7, 8)]
    docs = spark.createDataFrame(
        rows, "doc_id long, text string, node long, near_node long, near_row long, root long"
    )
    kept = nearcopies.without_copies(docs)
    assert kept.columns == docs.columns and rows_of(kept) == [rows[0], rows[2]]


def test_very_long_texts(spark):
    rng = random.Random(8)
    words = [f"w{rng.randrange(10**6)}" for _ in range(300_000)]
    changed = [*words]
    for at in range(0, 300_000, 60):
        changed[at] = "new"
    rows = [(1, " ".join(words)), (2, " ".join(changed)), (3, " ".join(words[:200_000]))]
    assert rows_of(nearcopies.without_copies(_docs(spark, rows)), "doc_id") == [(1,), (3,)]
