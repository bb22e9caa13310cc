"""As-of and interval joins against brute force; shared look-ups and changing dimensions."""

import random
import re

import pytest
from pyspark.sql import functions as F

from sigweave.operators import intervals, lookup
from sigweave.operators.asof import as_of
from sigweave.operators.intervals import overlapping
from sigweave.operators.slices import plan_slices
from sigweave.plans.rules import (
    AreaRule,
    FunctionRule,
    PartyRule,
    TerminalRule,
    TrackRule,
    attach_rules,
)
from sigweave.sources import VersionedDimension
from tests.conftest import rows_of

FACTS = "id long, at long, site string, place string"
HISTORY = "site string, since long, till long, n int, place string"


def _history(rng, n):
    rows = [
        (rng.choice(["a", "b", "c", None]), rng.choice([None, *range(0, 60, 2)]), rng.choice([None, None, 30]), i, f"p{i}")
        for i in range(n)
    ]
    return rows + rows[:2]


def _facts(rng, n):
    return [
        (i, rng.choice([None, *range(-5, 70)]), rng.choice(["a", "a", "b", "d", None]), "own") for i in range(n)
    ]


def _brute(facts, history, until):
    out = []
    for i, at, site, place in facts:
        fits = [
            h for h in history
            if site is not None and at is not None and h[0] == site and h[1] is not None and h[1] <= at
        ]
        best = max(fits, key=lambda h: (h[1], h[3]), default=None)
        if best and until and best[2] is not None and at >= best[2]:
            best = None
        out.append((i, at, site, place, (best[3], best[4]) if best else None))
    return sorted(out, key=repr)


def _found(rows):
    return sorted(((*r[:4], tuple(r[4]) if r[4] else None) for r in rows.collect()), key=repr)


@pytest.mark.parametrize("until", [None, "till"])
@pytest.mark.parametrize("cut", [None, 20])
def test_as_of_equals_brute_force(spark, until, cut):
    """Also with the keys cut into slices, ties, nulls and names that both sides have."""
    rng = random.Random(1)
    facts, history = _facts(rng, 300), _history(rng, 60)
    df, past = spark.createDataFrame(facts, FACTS), spark.createDataFrame(history, HISTORY)
    slices = "none"
    if cut:
        sequence = df.select(F.col("site").alias("_as_0"), F.col("at").alias("_at"), F.lit(1).alias("_side"))
        slices = plan_slices(sequence.dropna(), ["_as_0"], ["_at", "_side"], rows_per_slice=cut)
        assert slices.hot
    found = as_of(
        df, past, [("site", "site")], "at", "since", ["n", "place"], ties=["n"], until=until, slices=slices
    )
    assert found.columns == [*df.columns, "_entry"]
    assert _found(found) == _brute(facts, history, until)


def test_as_of_on_a_stream(spark, tmp_path):
    rng = random.Random(2)
    facts, history = _facts(rng, 100), _history(rng, 40)
    spark.createDataFrame(facts, FACTS).write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(FACTS).parquet(str(tmp_path / "in"))
    past = spark.createDataFrame(history, HISTORY)
    found = as_of(stream, past, [("site", "site")], "at", "since", ["n", "place"], ties=["n"], until="till")
    query = (
        found.writeStream.format("memory").queryName("as_of").trigger(availableNow=True)
        .option("checkpointLocation", str(tmp_path / "c")).start()
    )
    query.awaitTermination()
    assert _found(spark.table("as_of")) == _brute(facts, history, "till")


def test_as_of_of_empty_tables(spark):
    none, past = spark.createDataFrame([], FACTS), spark.createDataFrame([], HISTORY)
    one = spark.createDataFrame([(1, 5, "a", "x")], FACTS)
    assert as_of(none, past, [("site", "site")], "at", "since", ["n"]).count() == 0
    assert [r._entry for r in as_of(one, past, [("site", "site")], "at", "since", ["n"]).collect()] == [None]


def test_as_of_sorts_once(spark):
    df = spark.range(100).selectExpr("id", "id AS at", "CAST(id % 3 AS STRING) AS site")
    past = spark.range(30).selectExpr("CAST(id % 3 AS STRING) AS site", "id AS since", "id AS n")
    found = as_of(df, past, [("site", "site")], "at", "since", ["n"], slices="none")
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1 and "Join" not in plan


SPANS = "id long, begin long, finish long, k string"


def _spans(rng, n, most):
    rows = []
    for i in range(n):
        begin = rng.randrange(-50, 1000)
        length = rng.choice([0, 1, 1, 2, 3, 7, 8, 9, 30, most])
        rows.append((i, begin, begin + rng.randrange(0, length + 1), rng.choice(["x", "y", None])))
    return [*rows, (n, None, 5, "x"), (n + 1, 5, None, "x"), (n + 2, 9, 3, "x"), rows[0]]


def _pairs(left, right, point, keyed):
    return sorted(
        (a[0], b[0])
        for a in left
        for b in right
        if a[1] is not None and b[1] is not None and b[2] is not None and b[1] < b[2]
        and (point or a[2] is not None and a[1] < a[2])
        and a[1] < b[2] and b[1] < (a[1] + 1 if point else a[2])
        and (not keyed or a[3] is not None and a[3] == b[3])
    )


@pytest.mark.parametrize("point", [True, False])
@pytest.mark.parametrize("keyed", [True, False])
def test_overlaps_equal_brute_force(spark, point, keyed):
    for seed in range(3):
        rng = random.Random(seed)
        left, right = _spans(rng, 80, 400), _spans(rng, 60, 5000 if seed else 3)
        pairs = overlapping(
            spark.createDataFrame(left, SPANS),
            spark.createDataFrame(right, SPANS),
            ("begin", None if point else "finish"),
            ("begin", "finish"),
            on=[("k", "k")] if keyed else [],
        )
        found = sorted((r.left.id, r.right.id) for r in pairs.collect())
        assert found == _pairs(left, right, point, keyed)


@pytest.mark.parametrize("point", [True, False])
@pytest.mark.parametrize("keyed", [True, False])
def test_overlaps_of_small_chunks_equal_brute_force(spark, monkeypatch, point, keyed):
    """Also with levels of bins above the chunks, and a time that fills several chunks."""
    made, cuts = [], intervals._cuts
    monkeypatch.setattr(intervals, "_cuts", lambda *a: made.append(cuts(*a)) or made[-1])
    for name, value in (("LEAST", 3), ("MOST", 3), ("PARTS", 2)):
        monkeypatch.setattr(intervals, name, value)
    rng = random.Random(11)
    left = [*_spans(rng, 120, 600), *[(1000 + i, 77, 90, "x") for i in range(20)]]
    right = [*_spans(rng, 60, 900), *[(1000 + i, -100, 2000, "y") for i in range(30)]]
    # Beyond what doubles tell apart.
    left += [(2000 + i, 2**60 + i, 2**60 + i + 3, "y") for i in range(9)]
    right += [(2000 + i, 2**60 + 2 * i, 2**60 + 2 * i + 2, "y") for i in range(4)]
    pairs = overlapping(
        spark.createDataFrame(left, SPANS),
        spark.createDataFrame(right, SPANS),
        ("begin", None if point else "finish"),
        ("begin", "finish"),
        on=[("k", "k")] if keyed else [],
    )
    rows = pairs.collect()
    assert sorted((r.left.id, r.right.id) for r in rows) == _pairs(left, right, point, keyed)
    assert {tuple(r.left) for r in rows} <= set(left) and {tuple(r.right) for r in rows} <= set(right)
    assert len(made) == 2 - point and len(made[0].levels) > 1 and len(made[0].borders) > 20
    assert 78 in made[0].borders


def _joined(plan):
    """Rows that the joins of a plan that ran gave."""
    if plan.nodeName() == "AdaptiveSparkPlan":
        plan = plan.executedPlan()
    while plan.nodeName().endswith("QueryStage"):
        plan = plan.plan()
    own = plan.metrics().apply("numOutputRows").value() if "Join" in plan.nodeName() else 0
    below = plan.children()
    return own + sum(_joined(below.apply(i)) for i in range(below.size()))


@pytest.mark.parametrize("point", [True, False])
def test_dense_spans_meet_in_blocks(spark, point):
    """Pairs equal brute force, and rows of bins, not single rows, are joined."""
    rng = random.Random(7)
    left = [(i, b := rng.randrange(20_000), b + rng.randrange(1, 90), "x") for i in range(1500)]
    right = [(i, b := rng.randrange(20_000), b + rng.randrange(1, 3000), "x") for i in range(120)]
    pairs = overlapping(
        spark.createDataFrame(left, SPANS).coalesce(1),
        spark.createDataFrame(right, SPANS),
        ("begin", None if point else "finish"),
        ("begin", "finish"),
    )
    found = sorted((r.left.id, r.right.id) for r in pairs.collect())
    assert found == _pairs(left, right, point, False)
    assert 0 < 2 * _joined(pairs._jdf.queryExecution().executedPlan()) < len(found)


def _exchanged(plan):
    """Bytes that the exchanges of a plan that ran wrote, before compression."""
    if plan.nodeName() == "AdaptiveSparkPlan":
        plan = plan.executedPlan()
    while plan.nodeName().endswith("QueryStage"):
        plan = plan.plan()
    own = plan.metrics().apply("dataSize").value() if plan.nodeName() == "Exchange" else 0
    below = plan.children()
    return own + sum(_exchanged(below.apply(i)) for i in range(below.size()))


def test_overlaps_exchange_little_more_than_their_rows(spark):
    """Some 80 bytes a row: starts are not copied for each level, nor spans for each bin within them."""
    events = spark.range(10_000).selectExpr("id", "id * 100 AS begin")
    spans = spark.range(6_000).selectExpr(
        "id", "id * 160 AS begin", "id * 160 + if(id % 1000 = 0, 200000, id % 30 * 1000 + 1) AS finish"
    )
    pairs = overlapping(events, spans, ("begin", None), ("begin", "finish")).select("left.id", "right.id")
    found = len(pairs.collect())
    assert found > 500_000
    assert 0 < _exchanged(pairs._jdf.queryExecution().executedPlan()) < 160 * (10_000 + 6_000)


def test_one_span_covers_everything(spark):
    """It is one row of a high level, not one for each bin, and no cross join is planned."""
    events = spark.range(5000).selectExpr("id", "id * 1000 AS begin", "id * 1000 + 1 AS finish", "'x' AS k")
    rows = [(i, i * 100_000, i * 100_000 + 700, "x") for i in range(40)]
    spans = spark.createDataFrame([*rows, (99, -(10**12), 10**12, "x")], SPANS)
    pairs = overlapping(events, spans, ("begin", "finish"), ("begin", "finish"))
    counts = {r[0]: r[1] for r in pairs.groupBy("right.id").count().collect()}
    assert counts.pop(99) == 5000 and set(counts.values()) == {1} and len(counts) == 40
    plan = pairs._jdf.queryExecution().executedPlan().toString()
    assert "Cartesian" not in plan and "NestedLoop" not in plan


def test_overlaps_of_empty_tables(spark):
    none = spark.createDataFrame([], SPANS)
    one = spark.createDataFrame([(1, 2, 3, "x")], SPANS)
    for a, b in ((none, one), (one, none), (none, none)):
        found = overlapping(a, b, ("begin", "finish"), ("begin", "finish"))
        assert found.columns == ["left", "right"] and found.count() == 0


def _scans(df, path):
    """Number of scans of files below ``path`` in the plan that ran."""
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString()
    final = plan.split("== Initial Plan ==")[0]
    return len(re.findall(rf"FileScan parquet [^\n]*{re.escape(str(path))}", final))


def _dims(spark, tmp_path):
    sites = spark.range(20).selectExpr(
        "CAST(id AS STRING) AS lac", "'A, B' AS areas", "concat('s', id) AS site_name",
        "CAST(id AS DOUBLE) AS geo_longitude", "CAST(id AS DOUBLE) AS geo_latitude",
    )
    users = spark.range(30).selectExpr("lpad(id, 15, '1') AS imsi", "concat('n', id) AS name", "id AS kind")
    dims = {}
    for name, df in (("sites", sites), ("users", users)):
        df.write.parquet(str(tmp_path / name))
        dims[name] = spark.read.parquet(str(tmp_path / name))
    rows = spark.range(60).selectExpr(
        "id AS event_id", "id AS ts_ms", "CAST(id % 25 AS STRING) AS lac", "CAST(id % 3 AS STRING) AS ci",
        "lpad(id % 30, 15, '1') AS imsi", "lpad(id % 7, 15, '1') AS callingimsi", "lpad(id % 30, 15, '1') AS calledimsi",
    )
    return rows, dims


CHAIN = [
    AreaRule("area", "sites", [("lac", "lac")], areas=["A", "C"], attributes=["site_name"]),
    TrackRule("track", "sites", [("lac", "lac")]),
    PartyRule("party", "users", ["name"]),
    PartyRule("more", "users", ["name", "kind"]),
]


@pytest.mark.parametrize("limit", ["10485760", "-1"])
def test_a_chain_reads_each_dimension_once(spark, tmp_path, limit):
    """With broadcast joins, and with a dimension that is exchanged."""
    rows, dims = _dims(spark, tmp_path)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
    try:
        found = attach_rules(rows, CHAIN, dims, ["imsi"], ["ts_ms", "event_id"], slices="none")
        assert _scans(found, tmp_path / "sites") == 1
        assert _scans(found, tmp_path / "users") == 1
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    # The same labels as from look-ups of their own.
    plain = lookup.area_labels(rows, dims["sites"], [("lac", "lac")], areas=["A", "C"], attributes=["site_name"])
    plain = lookup.party_labels(plain, dims["users"], ["name", "kind"])
    assert not [c for c in found.columns if c.startswith("_")]
    assert rows_of(found, *plain.columns) == rows_of(plain)


def test_a_rule_that_changes_a_key_is_seen(spark, tmp_path):
    """After any other function the look-up is made again with the new key."""
    rows, dims = _dims(spark, tmp_path)
    chain = [
        AreaRule("area", "sites", [("lac", "lac")], attributes=["site_name"]),
        FunctionRule("move", lambda df: df.withColumn("lac", F.lit("7")).drop("geo_longitude")),
        TrackRule("track", "sites", [("lac", "lac")]),
    ]
    found = attach_rules(rows, chain, dims, ["imsi"], ["ts_ms", "event_id"], slices="none")
    assert {r.geo_longitude for r in found.collect()} == {7.0}
    assert {r.areainfo_site_name for r in found.filter("event_id = 3").collect()} == {"s3"}


def test_rules_alone_look_up_for_themselves(spark, tmp_path):
    from sigweave.plans.rules import RuleContext

    rows, dims = _dims(spark, tmp_path)
    terms = spark.createDataFrame([("00000001", "x")], "code string, brand string")
    context = RuleContext({**dims, "terms": terms}, ["imsi"], ["ts_ms"])
    phones = rows.selectExpr("*", "'000000012' AS imei", "'000000012' AS callingimei", "'' AS calledimei")
    found = TerminalRule("t", "terms", ["brand"]).attach(phones, context)
    assert {r.brand for r in found.collect()} == {"x"}


SITES = "lac string, name string"


def _stream_of(spark, tmp_path, dim, out):
    stream = spark.readStream.schema("id long, lac string").parquet(str(tmp_path / "in"))
    rows = stream.join(dim.latest(), "lac", "left")
    return (
        rows.writeStream.format("parquet").option("path", str(tmp_path / out))
        .option("checkpointLocation", str(tmp_path / "c")).start()
    )


def test_a_running_stream_meets_new_versions(spark, tmp_path):
    dim = VersionedDimension.open(spark, str(tmp_path / "dim"), SITES, lead_ms=700)
    assert dim.latest().count() == 0 and dim.versions() == []
    (tmp_path / "in").mkdir()
    query = _stream_of(spark, tmp_path, dim, "out")
    for n in range(3):
        if n:
            dim.wait(dim.publish(spark.createDataFrame([("a", f"v{n}")], SITES)))
        spark.createDataFrame([(n, "a")], "id long, lac string").write.mode("append").parquet(str(tmp_path / "in"))
        query.processAllAvailable()
    query.stop()
    found = spark.read.parquet(str(tmp_path / "out"))
    assert rows_of(found, "id", "name") == sorted([(0, None), (1, "v1"), (2, "v2")], key=repr)
    assert rows_of(dim.at(dim.versions()[0])) == [("a", "v1")]


def test_a_repeated_batch_meets_its_version_again(spark, tmp_path):
    """The batch fails after its plan; meanwhile a new version counts; the next run repeats it."""
    dim = VersionedDimension.open(spark, str(tmp_path / "dim"), SITES, lead_ms=700)
    dim.wait(dim.publish(spark.createDataFrame([("a", "old")], SITES)))
    spark.createDataFrame([(1, "a")], "id long, lac string").write.parquet(str(tmp_path / "in"))
    seen = []

    def start(handle):
        stream = spark.readStream.schema("id long, lac string").parquet(str(tmp_path / "in"))
        return (
            stream.join(dim.latest(), "lac", "left").writeStream.foreachBatch(handle)
            .option("checkpointLocation", str(tmp_path / "c")).trigger(availableNow=True).start()
        )

    def fail(batch, batch_id):
        seen.append((batch_id, rows_of(batch, "id", "name")))
        raise RuntimeError("lost")

    def keep(batch, batch_id):
        seen.append((batch_id, rows_of(batch, "id", "name")))

    with pytest.raises(Exception, match="lost"):
        start(fail).awaitTermination()
    dim.wait(dim.publish(spark.createDataFrame([("a", "new")], SITES)))
    spark.createDataFrame([(2, "a")], "id long, lac string").write.mode("append").parquet(str(tmp_path / "in"))
    start(keep).awaitTermination()
    assert seen == [(0, [(1, "old")]), (0, [(1, "old")]), (1, [(2, "new")])]


def test_versions_outlive_the_catalog(spark, tmp_path):
    dim = VersionedDimension.open(spark, str(tmp_path / "dim"), SITES, lead_ms=0)
    dim.wait(dim.publish(spark.createDataFrame([("a", "one")], SITES)))
    again = VersionedDimension.open(spark, str(tmp_path / "dim"), SITES)
    assert rows_of(again.latest()) == [("a", "one")]
    dim.wait(dim.publish(spark.createDataFrame([("b", "two")], SITES)))
    again.refresh()
    assert rows_of(again.latest()) == [("b", "two")] and len(again.versions()) == 2
