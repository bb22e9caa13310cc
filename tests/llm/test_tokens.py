"""Packing, shards, edit-aware counts and mixing."""

import random
import sys
import zlib

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from sigweave.llm import edits, mixing, packing, shards, tokens
from sigweave.session import run_dir

DOCS = "doc_id long, text string, source string, ids string, slot int, position int, key int"
TOKENIZER = Tokenizer.from_file(tokens.vocabulary_path())


def _ids(text):
    return TOKENIZER.encode(text or "", add_special_tokens=False).ids


def _rows(seed=1, n=60):
    rng = random.Random(seed)
    pool = ["The", "quick,", "naïve", "ÉCOLE", "x|y", "12.5", "don't", "<|endoftext|>", "日本語", "e\u0301"]
    rows = [(i, " ".join(rng.choices(pool, k=rng.randint(0, 200))), f"s{i % 3}") for i in range(n)]
    rows += [(100, None, None), (101, "", "s1"), (102, "\n\t ", "s1"), (103, "ab " * 9000, "s2")]
    return [*rows, rows[4], rows[4], (None, "no id", "s0"), (7, "another seven", "s0")]


def _docs(spark, rows):
    return spark.createDataFrame([(*r, "c", 1, 2, 3) for r in rows], DOCS)


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(max_size=40), max_size=6))
def test_word_by_word_ids_are_those_of_whole_texts(texts):
    texts = [t.encode("utf-8", "ignore").decode() for t in texts]
    ids, at = tokens.encoder(tokens.vocabulary_path()).encode(pa.array(texts, pa.string()), 5)
    assert [ids[a:b].tolist() for a, b in zip(at[:-1], at[1:], strict=True)] == [
        [*_ids(t), 5] for t in texts
    ]


def test_encoder_forgets_without_harm(monkeypatch):
    monkeypatch.setattr(tokens, "MOST_WORDS", 50)
    encode = tokens.WordEncoder(tokens.vocabulary_path())
    rng = random.Random(3)
    for _ in range(30):
        text = " ".join(f"w{rng.randrange(40)}|{rng.randrange(9)} v{rng.randrange(90)}" for _ in range(20))
        ids, _ = encode.encode(pa.array([text]))
        assert ids.tolist() == _ids(text)
        assert encode.count(text) == len(ids)


def test_packing(spark):
    rows = _rows()
    found = packing.pack(_docs(spark, rows)).collect()
    expected = sorted((i, [*_ids(t), 1]) for i, t, _ in rows if i not in (None, 4, 7))
    pieces = {}
    for r in found:
        ids = np.array(r.ids, dtype="<u4")
        assert r.length == len(ids) > 0 and r.ids_crc32 == zlib.crc32(ids.tobytes())
        pieces.setdefault(r.doc_id, []).append((r.start, r.ids, r.doc_tokens))
    joined = [
        (i, [x for _, ids, _ in sorted(p) for x in ids])
        for i, p in pieces.items()
        if i not in (None, 4, 7)
    ]
    assert sorted(joined) == expected
    total = sum(len(_ids(t)) + 1 for _, t, _ in rows)
    sequences = {}
    for r in found:
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
    assert sum(n for s in sequences.values() for _, n in s) == total
    for s in sequences.values():
        at = 0
        for offset, n in sorted(s):
            assert offset == at
            at += n
        assert at <= 2048 and at & (at - 1) == 0
    assert packing.pack(_docs(spark, [])).count() == 0


def test_hilbert_curve_visits_neighbours():
    points = np.array([[x, y, z] for x in range(8) for y in range(8) for z in range(8)])
    key = packing.hilbert(points, 3)
    assert sorted(key) == list(range(512))
    line = points[np.argsort(key)]
    assert (np.abs(np.diff(line, axis=0)).sum(axis=1) == 1).all()


def test_copies_share_a_curve_key():
    encode = tokens.encoder(tokens.vocabulary_path())
    ids, at = encode.encode(pa.array(["a b c", "a b c", "", "z y", None]))
    keys = packing.curve_keys(ids, at, encode.size)
    assert keys[0] == keys[1] and keys[2] == keys[4]


def test_shards_round_trip(spark, monkeypatch):
    monkeypatch.setattr(shards, "SHARD_IDS", 700)
    rows = _rows(2)
    out = run_dir(spark, "shards")
    shards.write(_docs(spark, rows), out)
    found = sorted(shards.read(spark, out).collect(), key=lambda r: r.start)
    ids = [r.doc_id for r in found]
    assert ids == sorted(ids, key=lambda i: -1 if i is None else i)
    at = 0
    for r in found:
        assert r.start == at
        at += r.n_tokens
    expected = [
        (i, len(x), zlib.crc32(np.array(x, dtype="<u4").tobytes()))
        for i, t, _ in rows
        for x in [[*_ids(t), 2]]
    ]
    assert sorted(((r.doc_id, r.n_tokens, r.ids_crc32) for r in found), key=repr) == sorted(
        expected, key=repr
    )
    got = [(r.doc_id, r.ids) for r in shards.fetch(spark, out, [4, 7, 103, 99_999, -5]).collect()]
    assert sorted(got) == sorted((i, [*_ids(t), 2]) for i, t, _ in rows if i in (4, 7, 103))


def test_no_shards(spark):
    out = run_dir(spark, "shards")
    shards.write(_docs(spark, []), out)
    assert shards.read(spark, out).count() == 0


def test_perfect_hash_is_minimal():
    keys = np.unique(np.random.default_rng(4).integers(0, 2**63, 5000, dtype=np.uint64))
    hashing = shards.PerfectHash.build(keys)
    assert sorted(hashing.slots(keys)) == list(range(len(keys)))


def _edited(text, changes):
    text = text or ""
    for e in changes or ():
        if e is not None:
            a, b, new = e
            a = max(0, min(a or 0, len(text)))
            b = max(a, min(b or 0, len(text)))
            text = text[:a] + (new or "") + text[b:]
    return text


@settings(max_examples=120, deadline=None)
@given(
    st.text(alphabet="aB é\n'|.1\u0301", max_size=900),
    st.lists(
        st.tuples(st.integers(-5, 950), st.integers(-5, 950), st.text(alphabet="xY 'é\u0301", max_size=300)),
        max_size=6,
    ),
)
def test_counts_follow_edits(text, changes):
    doc = edits.CountedText.of(text, tokens.encoder(tokens.vocabulary_path()))
    assert doc.tokens.total == len(_ids(text))
    for k, change in enumerate(changes):
        doc.edit(*change)
        now = _edited(text, changes[: k + 1])
        assert doc.text == now and doc.chars.total == len(now)
        assert doc.tokens.total == len(_ids(now))


def test_an_edit_encodes_little_of_a_long_text():
    doc = edits.CountedText.of("some words here " * 5000, tokens.encoder(tokens.vocabulary_path()))
    doc.edit(40_000, 40_010, "new words")
    assert doc.encoded_chars < 4 * edits.LEAF_CHARS


def test_recount(spark):
    rows = _rows(5)
    table = [
        (0, 2, 5, 9, "late"), (0, 1, 0, 0, "first "), (1, 1, None, 3, None), (100, 1, 9, 9, "grown"),
        (103, 1, 100, 26_000, " "), (5555, 1, 0, 0, "nobody"),
    ]
    changes = spark.createDataFrame(table, "doc_id long, seq int, start long, end long, text string")
    found = edits.recount(edits.with_edits(_docs(spark, rows), changes)).collect()
    by_doc = {}
    for i, _, a, b, t in sorted(table, key=lambda r: r[:2]):
        by_doc.setdefault(i, []).append((a, b, t))
    expected = sorted(
        (repr(i), len(_ids(t)), len(_ids(_edited(t, by_doc.get(i)))), len(_edited(t, by_doc.get(i))))
        for i, t, _ in rows
    )
    assert expected == sorted(
        (repr(r.doc_id), r.tokens_before, r.tokens_after, r.chars_after) for r in found
    )
    assert all(sum(r.leaf_tokens) == r.tokens_after for r in found)
    assert edits.recount(edits.with_edits(_docs(spark, []), changes)).count() == 0


@pytest.mark.parametrize("weights", [{"a": 1}, {"a": 7, "b": 2, "c": 1, "d": 90}, {"a": 3, "b": 3, "c": 5}])
def test_schedule_keeps_each_source_within_a_block(weights):
    total, slots = sum(weights.values()), mixing.period(weights)
    assert sorted(t for s in slots.values() for t in s) == list(range(total))
    for name, w in weights.items():
        for t in range(total + 1):
            assert abs(sum(s < t for s in slots[name]) - w * t / total) < 1


@pytest.mark.parametrize("bin_docs", [128, 3])
def test_mixing(spark, monkeypatch, bin_docs):
    monkeypatch.setattr(mixing, "BIN_DOCS", bin_docs)
    rng = random.Random(6)
    rows = [(i, "t", rng.choice(["big"] * 6 + ["b", "c", None, "other"])) for i in range(900)]
    rows += [(None, "t", "big"), rows[0], rows[0]]
    weights = {"big": 2, "b": 3, "c": 1, "absent": 9}
    found = mixing.mixed(_docs(spark, rows), weights, 2, block_docs=4).collect()
    assert sorted((repr(r.doc_id), repr(r.source)) for r in found) == sorted(
        (repr(i), repr(s)) for i, _, s in rows
    )
    found.sort(key=lambda r: r.position)
    assert [r.position for r in found] == list(range(len(rows)))
    blocks = {}
    for r in found:
        blocks.setdefault(r.slot, r.mix_source)
        assert blocks[r.slot] == r.mix_source
    order = [blocks[t] for t in range(len(blocks))]
    counts = {s: order.count(s) for s in set(order)}
    named = {s: weights.get(s, 2) for s in counts}
    # Until the first source ends, and again from there to the next end.
    start = 0
    while named:
        ends = {s: max(t for t, x in enumerate(order) if x == s) for s in named}
        end, total = min(ends.values()) + 1, sum(named.values())
        for t in range(start, end + 1):
            for s, w in named.items():
                assert abs(order[start:t].count(s) - w * (t - start) / total) < 1
        named = {s: w for s, w in named.items() if ends[s] >= end}
        start = end


def test_mixing_is_native_and_needs_no_text(spark, tmp_path):
    path = str(tmp_path / "docs")
    _docs(spark, _rows()).write.parquet(path)
    plan = mixing.mixed(spark.read.parquet(path), {"s0": 1}).select("doc_id", "position")
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in text and "text" not in text.replace("ReadSchema", "")


def test_mixing_of_nothing(spark):
    assert mixing.mixed(_docs(spark, []), {"a": 1}).count() == 0


def test_weights_are_bounded(spark):
    with pytest.raises(ValueError):
        mixing.mixed(_docs(spark, []), {"a": mixing.MOST_WEIGHT})


def test_words_in_lines_have_the_ids_of_words_alone():
    """Contractions, marks, digits and letters that change when they are normalised."""
    words = "it's we'LL don'T 's ''s''t a|b || | 4.5 $%# naïve Straße ÑANDÚ İstanbul ǅ ŉx ﬁne e\u0301 русский 日本 K".split()
    encode = tokens.WordEncoder(tokens.vocabulary_path())
    rng = random.Random(4)
    texts = [" ".join(rng.choices([*words, "plain", "Words,", "end."], k=rng.randint(0, 200))) for _ in range(60)]
    ids, at = encode.encode(pa.array([*texts, None, " \t "]))
    whole = Tokenizer.from_file(tokens.vocabulary_path())
    for n, text in enumerate([*texts, "", ""]):
        assert ids[at[n] : at[n + 1]].tolist() == whole.encode(text, add_special_tokens=False).ids


def test_words_share_the_ids_of_their_letters():
    """Parts of words are encoded once, and texts have the ids that the library gives."""
    path = tokens.vocabulary_path()
    stems = ["hello", "\u00c9t\u00c9", "\u0178ves", "stra\u00dfe", "\u0130stanbul", "\u017fo", "i\u0307x", "e\u0301t", "\u01c5x", "\u03a3\u03a3", "x1", "it's", "\u0149a", "don"]
    tails = ["", ".", ",", "!?", "***", ".$$$", "'", "'s", "'S", "<|", "|>", "<|endoftext|>", "_", "-", "\u00bf", "\u2026", "\u0301", "1", "'t'"]
    words = [w + t for s in stems for w in (s, s.upper(), s.title()) for t in tails]
    words += [t + s for s in stems[:3] for t in tails] + tails
    texts = [" ".join(words), *words, "", None, " \t\n"]
    encode = tokens.WordEncoder(path)
    ids, at = encode.encode(pa.array(texts, pa.string()))
    for n, text in enumerate(texts):
        wanted = encode._tokenizer.encode(text or "", add_special_tokens=False).ids
        assert ids[at[n] : at[n + 1]].tolist() == wanted, text
    encode = tokens.WordEncoder(path)
    cases = [f(s) + t for s in ("hello", "world") for f in (str, str.upper, str.title) for t in tails[:6]]
    encode.encode(pa.array([" ".join(cases)]))
    # Two stems and five runs of signs instead of 36 words.
    assert len(encode._slot) == 7


def test_known_words_cost_no_call_each():
    words = [f"w{'abcdefghij'[i % 10]}{'xyzuvw'[i % 6] * (i // 60 % 90 + 1)}" for i in range(5400)]
    assert len(set(words)) > 2000
    texts = pa.array([" ".join(words), None, "", "é ü"])
    encode = tokens.WordEncoder(tokens.vocabulary_path())
    first = encode.encode(texts)
    calls = []
    sys.setprofile(lambda frame, event, arg: calls.append(event == "call"))
    try:
        again = encode.encode(texts)
    finally:
        sys.setprofile(None)
    assert sum(calls) < 1000
    assert all((a == b).all() for a, b in zip(first, again, strict=True))
    assert tokens.split_words(texts)[1] == list(dict.fromkeys([*words, "", "é", "ü"]))
