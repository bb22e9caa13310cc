"""Streams against batch results, late rows, and restarts."""

import random

import pytest
from pyspark.sql import functions as F

from sigweave.operators import keyed, latest, stay
from sigweave.operators.slices import NO_SLICES
from sigweave.operators.throttle import throttle
from sigweave.session import run_dir
from sigweave.streaming.keyed import (
    STATE_LAST_EMIT,
    STATE_LATEST,
    STATE_RULES,
    keyed_rules,
    read_state,
    throttle_stream,
)
from sigweave.streaming.monitor import StageMonitor
from sigweave.streaming.run import run_to_table, start_batches, trigger_options
from sigweave.streaming.steps import PreviousStep, StayStep, TrackStep
from tests.conftest import rows_of

SCHEMA = (
    "who string, t long, id long, imei string, lac string, ci string, area_A string,"
    " area_B string, geo_latitude double, geo_longitude double"
)
KEYS, ORDER = ["who"], ["t", "id"]


def _rows(n=600, seed=3):
    rng = random.Random(seed)
    times = sorted(rng.randrange(1, 40_000) for _ in range(n))
    return [
        (
            rng.choice(["hot", f"u{rng.randrange(12)}"]),
            t,
            i,
            rng.choice(["x", "y", None]),
            str(rng.randrange(3)),
            str(rng.randrange(2)),
            rng.choice(["true", ""]),
            rng.choice(["true", "", ""]),
            rng.uniform(-80, 80),
            rng.uniform(-170, 170),
        )
        for i, t in enumerate(times)
    ]


class Feed:
    """A folder of parquet files that become one micro-batch each."""

    def __init__(self, spark, schema=SCHEMA):
        self.spark, self.schema = spark, schema
        self.path = run_dir(spark, "feed")
        self.checkpoint = run_dir(spark, "checkpoint")
        self.out = run_dir(spark, "out")
        spark.createDataFrame([], schema).write.parquet(self.path)

    def add(self, rows):
        frame = self.spark.createDataFrame(rows, self.schema).coalesce(1)
        frame.write.mode("append").parquet(self.path)

    def stream(self):
        return (
            self.spark.readStream.schema(self.schema)
            .option("maxFilesPerTrigger", 1)
            .parquet(self.path)
        )

    def run(self, transform):
        return run_to_table(transform(self.stream()), self.checkpoint, self.out)


def _thirds(rows):
    n = len(rows) // 3
    return [rows[:n], rows[n : 2 * n], rows[2 * n :]]


@pytest.fixture(scope="module")
def rows():
    return _rows()


@pytest.fixture(scope="module")
def table(spark, rows):
    return spark.createDataFrame(rows, SCHEMA).cache()


STEPS = [
    PreviousStep("imei"),
    TrackStep("t"),
    StayStep("t", ["A", "B"], [100, 400, 2000], timeout_ms=900),
]


def test_rules_equal_batch(spark, rows, table):
    feed = Feed(spark)
    for part in _thirds(rows):
        feed.add(part)
    found = feed.run(lambda s: keyed_rules(s, KEYS, ORDER, STEPS))
    expected = keyed.previous_value(table, KEYS, ORDER, "imei", slices=NO_SLICES)
    expected = keyed.user_track(expected, KEYS, ORDER, slices=NO_SLICES)
    expected = stay.location_stay(
        expected, KEYS, ORDER, ["A", "B"], [100, 400, 2000], timeout_ms=900, slices=NO_SLICES
    )
    assert found.columns == expected.columns
    # The last digit of a distance may differ between the two runtimes.
    shown = [c for c in expected.columns if c not in ("distance", "speed")]
    assert rows_of(found, *shown) == rows_of(expected, *shown)
    pairs = found.join(
        expected.select("id", F.col("distance").alias("d"), F.col("speed").alias("s")), "id"
    )
    near = (F.coalesce(F.abs(F.col("distance") - F.col("d")), F.lit(0)) <= 1) & (
        F.col("distance").isNull() == F.col("d").isNull()
    )
    assert pairs.filter(~near | (F.col("speed").isNull() != F.col("s").isNull())).count() == 0
    state = read_state(spark, feed.checkpoint, STATE_RULES)
    newest = latest.latest_per_key(table, KEYS, ORDER)
    assert rows_of(state, "who", "track_time") == rows_of(newest, "who", "t")


@pytest.mark.parametrize("seconds", [1, 4])
def test_throttle_equals_batch_over_a_restart(spark, rows, table, seconds):
    feed = Feed(spark)
    parts = _thirds(rows)

    def kept(stream):
        return throttle_stream(stream, KEYS, ORDER, seconds)

    feed.add(parts[0])
    first = feed.run(kept).count()
    feed.add(parts[1])
    feed.add(parts[2])
    found = feed.run(kept)
    expected = throttle(table, KEYS, ORDER, seconds, slices=NO_SLICES)
    assert 0 < first < expected.count()
    assert rows_of(found) == rows_of(expected)
    stamps = read_state(spark, feed.checkpoint, STATE_LAST_EMIT)
    assert rows_of(stamps, "who", "last") == rows_of(
        expected.groupBy("who").agg(F.max("t").alias("last"))
    )


def test_many_rows_of_a_key_are_sorted_on_disk(rows, monkeypatch):
    from pyspark.sql import Row

    from sigweave.streaming import keyed as stream_keyed

    monkeypatch.setattr(stream_keyed, "SORT_IN_MEMORY", 50)
    make = Row("t", "id")
    shuffled = [make(None if r[2] % 9 == 0 else r[1], r[2]) for r in rows]
    random.Random(1).shuffle(shuffled)
    found = list(stream_keyed._in_order(iter(shuffled), ORDER))
    assert found == sorted(shuffled, key=lambda r: (r.t is not None, r.t or 0, r.id))


def test_throttle_edges(spark):
    data = [("a", t, i) for i, t in enumerate([0, 999, 1000, 1999, 2000, 2000, 3500])]
    df = spark.createDataFrame(data, "who string, t long, id long")
    kept = throttle(df, KEYS, ORDER, 1, slices=NO_SLICES)
    assert [r.id for r in kept.orderBy("id").collect()] == [0, 2, 4, 6]
    assert throttle(df, KEYS, ORDER, 0).count() == len(data)
    # Thirty-one days do not overflow.
    month = 31 * 86_400
    data = [("a", 0, 0), ("a", month * 1000 - 1, 1), ("a", month * 1000, 2)]
    df = spark.createDataFrame(data, "who string, t long, id long")
    kept = throttle(df, KEYS, ORDER, month, slices=NO_SLICES)
    assert sorted(r.id for r in kept.collect()) == [0, 2]


def test_row_without_time_is_never_due(spark):
    df = spark.createDataFrame([("a", None, 0), ("a", 5, 1)], "who string, t long, id long")
    kept = throttle(df, KEYS, ORDER, 1, slices=NO_SLICES)
    assert [r.id for r in kept.collect()] == [1]


def test_throttle_by_the_clock_of_the_batch(spark, rows):
    feed = Feed(spark)
    feed.add(rows[:200])
    feed.add(rows[200:])
    found = feed.run(lambda s: throttle_stream(s, KEYS, ORDER, 3600, clock="processing"))
    firsts = {}
    for r in rows:
        firsts.setdefault(r[0], r[2])
    assert rows_of(found, "who", "id") == sorted(firsts.items())


def test_latest_rows_are_kept(spark, rows, table):
    feed = Feed(spark)
    for part in reversed(_thirds(rows)):
        feed.add(part)
    feed.run(
        lambda s: throttle_stream(
            s, KEYS, ORDER, 0, keep_latest=F.col("who") != "hot"
        )
    )
    found = read_state(spark, feed.checkpoint, STATE_LATEST)
    expected = latest.latest_per_key(table.filter("who <> 'hot'"), KEYS, ORDER)
    assert rows_of(found, *table.columns) == rows_of(expected, *table.columns)


def test_latest_table_is_merged(table):
    early, late = table.filter("t < 20000"), table.filter("t >= 20000")
    first = latest.merge_latest(None, late, KEYS, ORDER)
    found = latest.merge_latest(first, early, KEYS, ORDER)
    assert rows_of(found) == rows_of(latest.latest_per_key(table, KEYS, ORDER))


def test_latest_per_key_reduces_before_the_shuffle(table):
    plan = latest.latest_per_key(table, KEYS, ORDER)._jdf.queryExecution().executedPlan()
    text = plan.toString()
    assert text.index("Final") < text.index("Exchange") < text.index("Partial")


STAY_SCHEMA = "who string, t long, id long, area_A string, area_B string"


def _stays(spark, *batches, **options):
    """Labels of A and B by id for rows (t, areas) given batch by batch."""
    feed = Feed(spark, STAY_SCHEMA)
    i = 0
    for batch in batches:
        out = []
        for t, areas in batch:
            out.append(("u", t, i, *["true" if a in areas else "" for a in "AB"]))
            i += 1
        feed.add(out)
    step = StayStep("t", ["A", "B"], [10, 50], timeout_ms=100, **options)
    found = feed.run(lambda s: keyed_rules(s, KEYS, ORDER, [step]))
    return [(r.stay_A, r.stay_B) for r in found.orderBy("id").collect()]


@pytest.mark.parametrize(
    "batches, labels",
    [
        # In order: start, limits passed, same time, new stay after a gap.
        (
            [[(1000, "A"), (1020, "A"), (1060, "A"), (1060, "A"), (1161, "A"), (1171, "A")]],
            ["0", "10", "50", "0", "0", "10"],
        ),
        # A gap of exactly the timeout does not break the stay.
        ([[(1000, "A"), (1100, "A")]], ["0", "50"]),
        # Too late: nothing changes, the next row goes on from the old stay.
        ([[(1000, "A"), (1020, "A")], [(900, "A")], [(1060, "A")]], ["0", "10", "0", "50"]),
        # Late before the stay: the start moves back and limits may be passed.
        ([[(1000, "A"), (1005, "A")], [(950, "A")], [(1010, "A")]], ["0", "0", "50", "0"]),
        # Late inside the stay: no change.
        ([[(1000, "A"), (1020, "A")], [(1010, "A")], [(1060, "A")]], ["0", "10", "0", "50"]),
    ],
)
def test_stay_with_late_rows(spark, batches, labels):
    assert [a for a, _ in _stays(spark, *batches)] == labels


def test_old_areas_are_forgotten(spark):
    found = _stays(spark, [(1000, "A")], [(1090, "B")], [(1195, "A")], [(1210, "AB")])
    # B at 1090 is within the timeout of A; A at 1195 forgets both; B starts anew.
    assert found == [("0", "0"), ("0", "0"), ("0", "0"), ("10", "0")]


def test_late_row_far_before_one_area(spark):
    found = _stays(spark, [(1000, "A"), (1090, "B"), (1180, "A")], [(1085, "B"), (1080, "A")])
    # For A the stay began at 1180, as 1000 was too long ago; 1080 is near enough to it.
    assert found[3:] == [("0", "0"), ("50", "0")]


def test_true_duration_and_least_limit(spark):
    rows = [(1000, "A"), (1060, "A")]
    assert _stays(spark, rows, output_threshold=False)[1][0] == "60"
    assert _stays(spark, rows, match_max=False)[1][0] == "10"
    assert _stays(spark, [(1000, "A"), (1010, "A"), (1015, "A")])[2][0] == "10"
    assert _stays(spark, [(1000, "A"), (1010, "A"), (1015, "A")], strict=True)[2][0] == "0"


def test_row_value_wins_in_a_stream(spark):
    schema = "who string, t long, id long, imei string, last_imei string"
    feed = Feed(spark, schema)
    feed.add([("u", 1, 1, "a", "mine"), ("u", 2, 2, "b", "mine")])
    found = feed.run(lambda s: keyed_rules(s, KEYS, ORDER, [PreviousStep("imei")]))
    assert found.columns == ["who", "t", "id", "imei", "last_imei"]
    assert {r.last_imei for r in found.collect()} == {"mine"}


def test_state_can_expire(spark):
    """A stream with expiry runs until it is stopped, as time itself is its input."""
    import time

    feed = Feed(spark)
    feed.add(_rows(30))
    seen = []
    query = start_batches(
        keyed_rules(feed.stream(), KEYS, ORDER, [PreviousStep("imei")], ttl_ms=3_600_000),
        feed.checkpoint,
        lambda batch, _: seen.append(batch.count()),
        interval_s=0.2,
    )
    try:
        for _ in range(300):
            if sum(seen) >= 30:
                break
            time.sleep(0.1)
    finally:
        query.stop()
    assert sum(seen) == 30


def test_monitor_sees_batches(spark, rows):
    import time

    monitor = StageMonitor()
    spark.streams.addListener(monitor)
    try:
        feed = Feed(spark)
        for part in _thirds(rows):
            feed.add(part)
        feed.run(lambda s: s.observe("seen", F.count(F.lit(1)).alias("n")))
        for _ in range(100):
            if sum(b["rows"] for b in monitor.batches) >= len(rows):
                break
            time.sleep(0.1)
    finally:
        spark.streams.removeListener(monitor)
    assert sum(b["observed"]["seen"]["n"] for b in monitor.batches if b["rows"]) == len(rows)
    assert all(b["durations_ms"] for b in monitor.batches)


def test_trigger():
    assert trigger_options(None) == {"availableNow": True}
    assert trigger_options(5) == {"processingTime": "5 seconds"}
