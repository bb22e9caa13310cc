"""Sliced hot keys give the same rows as whole keys."""

import random

import pytest
from pyspark.sql import functions as F

from sigweave.operators import keyed, stay
from sigweave.operators.slices import NO_SLICES, SLICE, plan_slices
from sigweave.operators.throttle import throttle
from tests.conftest import rows_of

KEYS = ["who"]
ORDER = ["t", "id"]


@pytest.fixture(scope="module")
def rows(spark):
    """One key holds a third of the rows, in bursts; keys and values may be null."""
    rng = random.Random(7)
    data = []
    for i in range(3000):
        who = rng.choice(["hot", f"u{rng.randrange(40)}", f"u{rng.randrange(40)}"])
        if rng.random() < 0.2:
            who = None
        if rng.random() < 0.1:
            who = "same"
        burst = rng.choice([0, 0, 50_000, 400_000])
        t = burst + rng.randrange(rng.choice([300, 20_000, 300_000]))
        if who == "same":
            t = 77
        data.append(
            (
                who,
                t,
                i,
                rng.choice(["a", "b", None]),
                rng.choice(["true", ""]),
                rng.choice(["true", "", ""]),
                rng.uniform(-80, 80),
                rng.uniform(-170, 170),
            )
        )
    schema = (
        "who string, t long, id long, v string, area_A string, area_B string,"
        " geo_latitude double, geo_longitude double"
    )
    return spark.createDataFrame(data, schema).repartition(5).cache()


@pytest.fixture(scope="module")
def plan(rows):
    found = plan_slices(rows, KEYS, ORDER, rows_per_slice=100)
    assert found.hot
    return found


def test_slices_follow_time_and_are_balanced(rows, plan):
    tagged = plan.tag(rows)
    hot = tagged.filter(F.col(SLICE).isNotNull())
    assert {r.who for r in hot.select("who").distinct().collect()} == {"hot", "same", None}
    spans = (
        hot.groupBy("who", SLICE)
        .agg(
            F.min(F.struct("t", "id")).alias("lo"),
            F.max(F.struct("t", "id")).alias("hi"),
            F.count("*").alias("n"),
        )
        .orderBy("who", SLICE)
        .collect()
    )
    assert len(spans) > 15
    for before, after in zip(spans, spans[1:]):
        if before.who == after.who:
            assert tuple(before.hi) < tuple(after.lo)
    assert max(s.n for s in spans) <= 100
    assert tagged.count() == rows.count()


def test_sampled_cuts_are_nearly_even(spark):
    df = spark.range(0, 40_000, 1, 4).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")).alias("who"),
        # All of a burst, then a long tail.
        F.when(F.col("id") < 39_000, F.col("id") % 50).otherwise(F.col("id") * 1000).alias("t"),
        "id",
    )
    plan = plan_slices(df, KEYS, ORDER, rows_per_slice=2_000)
    counts = {
        r[SLICE]: r["count"]
        for r in plan.tag(df).filter("who = 'hot'").groupBy(SLICE).count().collect()
    }
    assert 5 <= len(counts) <= 9
    assert max(counts.values()) < 3_500


def test_no_hot_key_keeps_the_plain_plan(rows):
    assert not plan_slices(rows, KEYS, ORDER, rows_per_slice=100_000).hot
    assert not plan_slices(rows.limit(0), KEYS, ORDER, rows_per_slice=1).hot


def test_slices_keep_their_size_in_larger_data(spark):
    """Ten times the rows of a key make ten times the slices."""
    for n in (2_000, 20_000):
        df = spark.range(n).select(F.lit("hot").alias("who"), (F.col("id") * 3).alias("t"), "id")
        plan = plan_slices(df, KEYS, ORDER, rows_per_slice=100)
        sizes = [r["count"] for r in plan.tag(df).groupBy(SLICE).count().collect()]
        assert len(sizes) >= n // 100 and max(sizes) <= 100


def test_plan_for_other_keys_is_refused(rows, plan):
    with pytest.raises(ValueError):
        keyed.previous_value(rows, ["v"], ORDER, "v", slices=plan)


def test_previous_value(rows, plan):
    whole = keyed.previous_value(rows, KEYS, ORDER, "v", name="p", slices=NO_SLICES)
    cut = keyed.previous_value(rows, KEYS, ORDER, "v", name="p", slices=plan)
    assert rows_of(cut) == rows_of(whole)


def test_user_track(rows, plan):
    whole = keyed.user_track(rows, KEYS, ORDER, site=["v", "area_A"], slices=NO_SLICES)
    cut = keyed.user_track(rows, KEYS, ORDER, site=["v", "area_A"], slices=plan)
    assert rows_of(cut) == rows_of(whole)


@pytest.mark.parametrize("timeout", [40, 900, 30_000, 10**9])
def test_location_stay(rows, plan, timeout):
    args = (KEYS, ORDER, ["A", "B"], [100, 1000, 20_000])
    whole = stay.location_stay(rows, *args, timeout_ms=timeout, slices=NO_SLICES)
    cut = stay.location_stay(rows, *args, timeout_ms=timeout, slices=plan)
    assert rows_of(cut) == rows_of(whole)


def _kept(data, seconds):
    """Plain sequential throttle."""
    last, kept = {}, []
    for who, t, i in sorted(data, key=lambda r: (repr(r[0]), r[1], r[2])):
        if who not in last or t >= last[who] + seconds * 1000:
            last[who] = t
            kept.append(i)
    return sorted(kept)


@pytest.mark.parametrize("seconds", [1, 3, 17, 90, 100_000])
def test_throttle(rows, plan, seconds):
    data = [(r.who, r.t, r.id) for r in rows.collect()]
    expected = _kept(data, seconds)
    for slices in (plan, NO_SLICES):
        found = throttle(rows, KEYS, ORDER, seconds, slices=slices)
        assert sorted(r.id for r in found.collect()) == expected
        assert found.columns == rows.columns


def test_throttle_of_few_rows_with_cuts_of_many(rows, plan):
    """Whole slices may be empty if the cuts were made for more rows."""
    for part in ("t > 400000", "t < 300 OR t > 420000", "id % 50 = 0", "id < 0"):
        chosen = rows.filter(part)
        data = [(r.who, r.t, r.id) for r in chosen.collect()]
        found = throttle(chosen, KEYS, ORDER, 7, slices=plan)
        assert sorted(r.id for r in found.collect()) == _kept(data, 7)


def test_throttle_with_an_interval_per_key(rows, plan):
    gap = F.when(F.col("who") == "hot", 5).otherwise(0)
    data = [(r.who, r.t, r.id) for r in rows.collect()]
    expected = sorted(
        _kept([d for d in data if d[0] == "hot"], 5) + [d[2] for d in data if d[0] != "hot"]
    )
    for slices in (plan, NO_SLICES):
        found = throttle(rows, KEYS, ORDER, gap, slices=slices)
        assert sorted(r.id for r in found.collect()) == expected
