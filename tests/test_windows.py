"""Stream windows with late rows, joins of streams, and streams that start from a state."""

import random
from itertools import groupby

import pytest
from pyspark.sql import functions as F

from sigweave.operators.slices import plan_slices
from sigweave.plans.rules import AreaRule, PreviousRule, StayRule, TrackRule, attach_rules, rules_state
from sigweave.session import run_dir
from sigweave.streaming.joins import within
from sigweave.streaming.keyed import STATE_LAST_EMIT, STATE_RULES, read_state, throttle_stream
from sigweave.streaming.run import run_to_table
from sigweave.streaming.windows import WindowSpec, table_windows, windowed
from tests.conftest import rows_of

ROWS = "who string, t long, v double, at string"
SPECS = [WindowSpec(100), WindowSpec(100, 30), WindowSpec(gap_ms=40)]


def _rows(n, seed):
    rng = random.Random(seed)
    return [
        (rng.choice("abc"), rng.choice([None, *range(1000)]), rng.choice([None, 1.0, 2.5]), "x")
        for _ in range(n)
    ]


def _runs(times, gap):
    """Runs of ascending (time, value)."""
    found = []
    for t, v in times:
        if not found or t - found[-1][-1][0] >= gap:
            found.append([])
        found[-1].append((t, v))
    return found


def _brute(rows, spec):
    out = []
    timed = sorted((r[0], r[1], r[2] or 0.0) for r in rows if r[1] is not None)
    for who, mine in groupby(timed, key=lambda r: r[0]):
        mine = [r[1:] for r in mine]
        if spec.gap_ms:
            for run in _runs(mine, spec.gap_ms):
                out.append((who, run[0][0], run[-1][0] + spec.gap_ms, len(run), sum(v for _, v in run)))
            continue
        slide = spec.slide_ms or spec.size_ms
        starts = {t // slide * slide - b * slide for t, _ in mine for b in range(10)}
        for start in starts:
            held = [v for t, v in mine if start <= t < start + spec.size_ms]
            if held:
                out.append((who, start, start + spec.size_ms, len(held), sum(held)))
    return sorted(out, key=repr)


@pytest.mark.parametrize("spec", SPECS)
def test_windows_of_a_table(spark, spec):
    rows = _rows(300, 1)
    found = table_windows(spark.createDataFrame(rows, ROWS), ["who"], "t", spec, ["v"])
    assert rows_of(found, "who", "start_ms", "end_ms", "n", "v") == _brute(rows, spec)


def _streamed(spark, parts, spec, delay):
    folder, checkpoint, out = (run_dir(spark, n) for n in ("in", "checkpoint", "out"))
    for part in parts:
        spark.createDataFrame(part, ROWS).write.mode("append").parquet(folder)
        stream = spark.readStream.schema(ROWS).parquet(folder)
        found = windowed(stream, ["who"], "t", spec, ["v"], delay_ms=delay)
        table = run_to_table(found, checkpoint, out)
    return table


@pytest.mark.parametrize("spec", SPECS)
def test_streamed_windows_equal_the_table(spark, spec):
    """In three parts with a restart after each; a last row far ahead closes all others."""
    rows = sorted((r for r in _rows(240, 2) if r[1] is not None), key=lambda r: r[1])
    parts = [rows[:80], rows[80:160], rows[160:], [("z", 10**6, 1.0, "x")]]
    found = _streamed(spark, parts, spec, delay=50)
    assert found.filter("kind = 'late'").count() == 0
    assert rows_of(found, "who", "start_ms", "end_ms", "n", "v") == _brute(rows, spec)


def test_late_rows_are_set_aside(spark):
    parts = [
        [("a", 10, 1.0, "x"), ("a", 500, 1.0, "x")],
        # The watermark is 450: the window of 20 is closed, that of 460 is open.
        [("a", 20, 2.0, "x"), ("a", 460, 4.0, "x"), ("b", 449, 8.0, "x"), ("b", 399, 8.0, "x")],
        [("a", 2000, 1.0, "x")],
    ]
    found = _streamed(spark, parts, WindowSpec(100), delay=50)
    assert rows_of(found.drop("end_ms"), "kind", "who", "start_ms", "time_ms", "n", "v") == [
        ("late", "a", 0, 20, 1, 2.0),
        ("late", "b", 300, 399, 1, 8.0),
        ("window", "a", 0, None, 1, 1.0),
        ("window", "a", 400, None, 1, 4.0),
        ("window", "a", 500, None, 1, 1.0),
        ("window", "b", 400, None, 1, 8.0),
    ]


def test_late_rows_of_sessions(spark):
    parts = [
        [("a", 100, 1.0, "x"), ("a", 500, 1.0, "x")],
        # 130 would have gone on with a session that is closed; 480 joins the open one.
        [("a", 130, 2.0, "x"), ("a", 480, 4.0, "x"), ("c", 430, 8.0, "x")],
        [("a", 2000, 1.0, "x")],
    ]
    found = _streamed(spark, parts, WindowSpec(gap_ms=40), delay=50)
    assert rows_of(found, "kind", "who", "start_ms", "end_ms", "n", "v") == [
        ("late", "a", 130, 170, 1, 2.0),
        ("window", "a", 100, 140, 1, 1.0),
        ("window", "a", 480, 540, 2, 5.0),
        ("window", "c", 430, 470, 1, 8.0),
    ]


def test_window_specs():
    for bad in ({}, {"size_ms": 5, "gap_ms": 5}, {"size_ms": 5, "slide_ms": 6}):
        with pytest.raises(ValueError):
            WindowSpec(**bad)


LEFT, RIGHT = "k string, a long, ta long", "k string, b long, tb long"


def _sides(seed):
    rng = random.Random(seed)
    one = [(rng.choice(["x", "y", None]), i, rng.randrange(0, 3000) * 10) for i in range(60)]
    two = [(rng.choice(["x", "y", None]), i, rng.randrange(0, 3000) * 10 + 5) for i in range(60)]
    return sorted(one, key=lambda r: r[2]), sorted(two, key=lambda r: r[2])


def _matches(one, two, before, after):
    return [
        (a, b) for a in one for b in two
        if a[0] is not None and a[0] == b[0] and a[2] - before <= b[2] <= a[2] + after
    ]


def test_within_on_tables(spark):
    one, two = _sides(1)
    left, right = spark.createDataFrame(one, LEFT), spark.createDataFrame(two, RIGHT)
    found = within(left, right, ["k"], "ta", "tb", after_ms=2000, before_ms=300, how="full_outer")
    pairs = _matches(one, two, 300, 2000)
    expected = [(a[0], a[1], a[2], b[1], b[2]) for a, b in pairs]
    expected += [(*a, None, None) for a in one if a not in [p[0] for p in pairs]]
    expected += [(b[0], None, None, b[1], b[2]) for b in two if b not in [p[1] for p in pairs]]
    assert found.columns == ["k", "a", "ta", "b", "tb"]
    assert rows_of(found) == sorted(expected, key=repr)


def test_within_on_streams(spark):
    """Three parts with a restart after each; rows without a partner come when none can come."""
    one, two = _sides(2)
    folders = [run_dir(spark, n) for n in "ab"]
    checkpoint, out = run_dir(spark, "checkpoint"), run_dir(spark, "out")
    for low, high in ((0, 10_000), (10_000, 20_000), (20_000, 10**9)):
        streams = []
        for rows, schema, folder in ((one, LEFT, folders[0]), (two, RIGHT, folders[1])):
            part = [r for r in rows if low <= r[2] < high]
            spark.createDataFrame(part, schema).write.mode("append").parquet(folder)
            streams.append(spark.readStream.schema(schema).parquet(folder))
        found = within(*streams, ["k"], "ta", "tb", after_ms=2000, delay_ms=103, how="left_outer")
        table = run_to_table(found, checkpoint, out)
    pairs = _matches(one, two, 0, 2000)
    mark = min(max(r[2] for r in one), max(r[2] for r in two)) - 103
    alone = [a for a in one if a not in [p[0] for p in pairs] and a[2] + 2000 < mark]
    expected = [(a[0], a[1], a[2], b[1], b[2]) for a, b in pairs] + [(*a, None, None) for a in alone]
    assert alone and pairs
    assert rows_of(table) == sorted(expected, key=repr)


SIGNALS = "who string, t long, id long, imei string, lac string, ci string"
KEYS, ORDER = ["who"], ["t", "id"]
CHAIN = [
    AreaRule("area", "sites", [("lac", "lac")], areas=["A", "B"]),
    StayRule("stay", areas=["A", "B"], limits=[50, 500], timeout_ms=300),
    PreviousRule("previous"),
    TrackRule("track", "sites", [("lac", "lac")]),
]
LABELS = ["id", "stay_A", "stay_B", "last_imei", "distance", "speed", "last_lac_ci"]


def _signals(n, seed):
    rng = random.Random(seed)
    times = sorted(rng.randrange(1, 9000) for _ in range(n))
    return [
        (
            rng.choice(["hot", "hot", *(f"u{i}" for i in range(9)), None]),
            t, i, rng.choice(["x", "y", None]), rng.choice(["0", "1", "2", "9"]), str(rng.randrange(2)),
        )
        for i, t in enumerate(times)
    ]


def _sites(spark):
    return spark.createDataFrame(
        [("0", "A", 117.0, 36.0), ("1", "B, A", 118.0, 36.5), ("2", "", 119.0, 37.0)],
        "lac string, areas string, geo_longitude double, geo_latitude double",
    )


@pytest.mark.parametrize("cut", [None, 15])
def test_a_stream_goes_on_from_the_state_of_a_table(spark, cut):
    """Table over the first part, stream over the rest: together what one run over all gives."""
    rows = _signals(500, 4)
    dims = {"sites": _sites(spark)}
    whole = attach_rules(spark.createDataFrame(rows, SIGNALS), CHAIN, dims, KEYS, ORDER, slices="none")
    expected = {r.id: r for r in whole.select(*LABELS).collect()}
    first = spark.createDataFrame(rows[:250], SIGNALS)
    slices = plan_slices(first, KEYS, ORDER, rows_per_slice=cut) if cut else "none"
    state = rules_state(first, CHAIN, dims, KEYS, ORDER, slices=slices)
    folder = run_dir(spark, "in")
    spark.createDataFrame(rows[250:], SIGNALS).write.parquet(folder)
    stream = spark.readStream.schema(SIGNALS).parquet(folder)
    labelled = attach_rules(stream, CHAIN, dims, KEYS, ORDER, initial=state)
    found = run_to_table(labelled.select(*LABELS), run_dir(spark, "checkpoint"), run_dir(spark, "out"))
    assert found.count() == 250
    assert [r for r in found.collect() if r != expected[r.id]] == []


def test_the_state_of_a_table_is_that_of_a_stream(spark):
    rows = spark.createDataFrame(_signals(400, 5), SIGNALS)
    dims = {"sites": _sites(spark)}
    state = rules_state(rows, CHAIN, dims, KEYS, ORDER)
    folder, checkpoint = run_dir(spark, "in"), run_dir(spark, "checkpoint")
    rows.write.parquet(folder)
    labelled = attach_rules(spark.readStream.schema(SIGNALS).parquet(folder), CHAIN, dims, KEYS, ORDER)
    run_to_table(labelled, checkpoint, run_dir(spark, "out"))
    kept = read_state(spark, checkpoint, STATE_RULES)
    fields = [c for c in kept.columns if c not in KEYS]
    assert rows_of(state, *KEYS, *fields) == rows_of(kept, *KEYS, *fields)


def test_state_moves_to_another_number_of_partitions(spark):
    """Read from one checkpoint, it starts another one that has more partitions."""
    rows = [(f"u{i % 7}", i * 10, i) for i in range(60)]
    schema = "who string, t long, id long"
    folder, one, two = (run_dir(spark, n) for n in ("in", "one", "two"))

    def run(checkpoint, part, initial=None):
        place = run_dir(spark, "part")
        spark.createDataFrame(part, schema).write.parquet(place)
        stream = spark.readStream.schema(schema).parquet(place)
        due = throttle_stream(stream, ["who"], ["t", "id"], 1, initial=initial)
        return rows_of(run_to_table(due.withColumn("t", F.col("t")), checkpoint, run_dir(spark, "out")))

    timed = [(w, t * 20, i) for w, t, i in rows]
    whole = run(folder, timed)
    first = run(one, timed[:30])
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "7")
    try:
        rest = run(two, timed[30:], read_state(spark, one, STATE_LAST_EMIT))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert sorted(first + rest, key=repr) == whole
