"""Steps of the search for near copies."""

import gc
import random
import uuid
import weakref

import numpy as np

from sigweave.llm import common, nearcopies

MARKS = "node long, n long, keys array<long>"


def test_keys_of_one_node_do_not_meet_the_join(spark):
    rng = random.Random(5)
    rows = [(i, 9, [rng.randrange(-(1 << 63), 1 << 63) for _ in range(i % 4)]) for i in range(400)]
    both, ends = rows[7][2][0], [-(1 << 63), (1 << 63) - 1, -1, 0]
    rows += [(400, 9, [both, *ends]), (401, 9, []), (402, 9, ends[::-1])]
    marks = spark.createDataFrame(rows, MARKS)
    shared = spark.createDataFrame([(k, 2) for k in (both, *ends)], "key long, in_key long")
    bits = nearcopies._bits(shared)
    assert int(np.bitwise_count(bits).sum()) == 5
    found = nearcopies._keyed(marks, bits).collect()
    wanted = {(i, n, p, k) for i, n, keys in rows for p, k in enumerate(keys) if k in {both, *ends}}
    assert wanted <= {tuple(r) for r in found}
    assert len(found) < len(wanted) + 20


def test_simhash_names_pairs_before_the_prefix_filter(spark):
    words = [f"w{i}" for i in range(400)]
    texts = [" ".join(words), " ".join([*words[:-1], "x"]), " ".join(f"v{i}" for i in range(400)), "", None]
    marks = []
    for text in texts[:4]:
        own = next(iter(nearcopies.word_hashes(nearcopies.pa.array([text]))))
        found = nearcopies.shingles(own)
        fp = np.array([nearcopies.fingerprint_of(found)], np.uint64).view(np.int64)[0]
        marks.append((nearcopies.node_of(own), len(found), int(fp)))
    pairs = nearcopies._by_fingerprint(spark.createDataFrame(marks, "node long, n long, fp long"))
    near = sorted(m[0] for m in marks[:2])
    assert [tuple(r) for r in pairs.collect()] == [tuple(near)]


def test_sets_are_made_of_texts_in_pairs_only(spark):
    texts = [f"a{i} b{i} c{i} d{i} e{i} f{i}" for i in range(300)] + ["", None, " A0  b0 c0 d0 e0 f0", "a7 b7 c7 d7 e7 f7"]
    rows = spark.createDataFrame([(t,) for t in texts], "text string").selectExpr("text", "xxhash64(text) h")
    nodes = [nearcopies.node_of(w) for w in nearcopies.word_hashes(nearcopies.pa.array(texts))]
    assert nodes[0] == nodes[302] and nodes[300] == nodes[301]
    hashes = [r.h for r in rows.collect()]
    wanted = spark.createDataFrame([(nodes[i], hashes[i]) for i in (7, 301, 302)], "node long, h long")
    # Others are left out before any exchange, also where no join is broadcast.
    keys = wanted.selectExpr("h AS key")
    met = [r.text for r in nearcopies._only(rows, "h", keys).collect()]
    assert len(met) <= 6 and {texts[i] for i in (7, 301, 302)} <= set(met)
    rest = [r.text for r in nearcopies._only(rows, "h", keys, met=False).collect()]
    assert sorted(map(str, met + rest)) == sorted(map(str, texts))
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        sets = nearcopies._sets(rows, wanted).collect()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    found = {r.node: np.frombuffer(r.grams, dtype="<u8") for r in sets}
    assert len(sets) == 3 and set(found) == {nodes[i] for i in (7, 301, 302)}
    for i in (7, 301, 302):
        own = next(iter(nearcopies.word_hashes(nearcopies.pa.array([texts[i]], nearcopies.pa.string()))))
        assert (found[nodes[i]] == nearcopies.shingles(own)).all()


def test_a_task_cuts_texts_with_one_python_worker(spark, monkeypatch):
    """The filter by hashes and the step that reads the texts it lets through are one."""
    plans, keep = [], nearcopies.stored

    def stored(df, name):
        plans.append((name, df._jdf.queryExecution().optimizedPlan().toString()))
        return keep(df, name)

    monkeypatch.setattr(nearcopies, "stored", stored)
    texts = [" ".join(f"w{i}x{j}" for j in range(60)) for i in range(4)]
    rows = [(i, t) for i, t in enumerate([*texts, texts[0] + " z", texts[1], None])]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    kept = nearcopies.without_copies(docs)
    assert sorted(r.doc_id for r in kept.collect()) == [0, 1, 2, 3, 6]
    assert {p.count("MapInArrow") for name, p in plans if name == "grams"} == {1}
    # Rows that are alone, and those that are not.
    assert kept._jdf.queryExecution().optimizedPlan().toString().count("MapInArrow") == 2


def test_a_task_drops_what_the_one_before_held():
    class Held:
        pass

    gc.disable()
    try:
        held = Held()
        held.own, seen = held, weakref.ref(held)
        del held
        batch = nearcopies.pa.RecordBatch.from_arrays([nearcopies.pa.array(["a", "b"])], ["text"])
        assert [b.num_rows for b in nearcopies.slices(iter([batch]), "text")] == [2]
        assert seen() is None
    finally:
        gc.enable()


def _jobs(spark, run):
    """Number of Spark's jobs behind ``run``."""
    context, name, group = spark.sparkContext, "spark.jobGroup.id", uuid.uuid4().hex
    before = context.getLocalProperty(name)
    context.setLocalProperty(name, group)
    try:
        run()
    finally:
        context.setLocalProperty(name, before)
    return len(context.statusTracker().getJobIdsForGroup(group))


def test_each_round_of_components_is_one_query(spark, monkeypatch):
    """What tells the end is gathered while a round is written, not read again."""
    edges = spark.createDataFrame([(i, i + 1) for i in range(60)], "a long, b long")
    writes, keep, found = [], common.stored, []

    def stored(df, name):
        writes.append(_jobs(spark, lambda: found.append(keep(df, name))))
        return found[-1]

    monkeypatch.setattr(common, "stored", stored)
    assert _jobs(spark, lambda: common.components(edges)) == 0 and min(writes) > 0
    assert sorted(tuple(r) for r in found[-1].collect()) == [(i, 0) for i in range(1, 61)]
    found.clear()
    assert common.components(edges.filter("a < 0")).count() == 0 and len(found) == 1


def test_a_turn_without_pairs_seeks_no_components(spark, monkeypatch):
    calls, run = [], nearcopies.components
    monkeypatch.setattr(nearcopies, "components", lambda edges: calls.append(edges.count()) or run(edges))
    rows = [(i, " ".join(f"w{i % 6}x{j}" for j in range(60)) + " z" * (i // 6)) for i in range(12)]
    found = nearcopies.roots(spark.createDataFrame(rows, "doc_id long, text string"))
    assert found.count() == 6 and found.select("root").distinct().count() == 6
    assert len(calls) < 4
