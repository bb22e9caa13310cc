"""Late rows on tables against streams, and roll-ups against exact aggregates."""

import random

import pytest
from pyspark.sql import functions as F

from sigweave.operators import keyed
from sigweave.operators.arrival import by_arrival
from sigweave.session import run_dir
from sigweave.streaming.keyed import keyed_rules
from sigweave.streaming.rollups import RollupSpec, compacted, partials, start_rollup
from sigweave.streaming.run import run_to_table
from sigweave.streaming.steps import PreviousStep, StayStep, TrackStep
from tests.conftest import rows_of

SCHEMA = (
    "who string, t long, id long, part int, imei string, lac string, ci string, area_A string,"
    " area_B string, geo_latitude double, geo_longitude double"
)
STEPS = [PreviousStep("imei"), TrackStep("t"), StayStep("t", ["A", "B"], [100, 400], timeout_ms=900)]
LABELS = ["id", "last_imei", "distance", "speed", "last_lac_ci", "stay_A", "stay_B"]


def _rows(n, seed):
    rng = random.Random(seed)
    return [
        (
            rng.choice(["hot", "hot", "a", "b", None]), rng.choice([None, *range(1, 5000)]), i, rng.randrange(3),
            rng.choice(["x", "y", None]), str(rng.randrange(3)), rng.choice(["0", None]),
            rng.choice(["true", "", None]), rng.choice(["true", ""]), rng.uniform(-80, 80), rng.uniform(-170, 170),
        )
        for i in range(n)
    ]


def test_a_table_is_labelled_as_the_stream_was(spark):
    """Rows come in any order: early, late, too late, without a time."""
    rows = _rows(300, 1)
    found = by_arrival(spark.createDataFrame(rows, SCHEMA), ["who"], "part", ["t", "id"], STEPS)
    folder, checkpoint, out = (run_dir(spark, n) for n in ("in", "checkpoint", "out"))
    for part in range(3):
        mine = spark.createDataFrame([r for r in rows if r[3] == part], SCHEMA)
        mine.coalesce(1).write.mode("append").parquet(folder)
        stream = spark.readStream.schema(SCHEMA).parquet(folder)
        table = run_to_table(keyed_rules(stream, ["who"], ["t", "id"], STEPS), checkpoint, out)
    assert found.columns == table.columns
    assert rows_of(found, *LABELS) == rows_of(table, *LABELS)


def test_in_order_it_equals_the_table_form(spark):
    rows = [(*r[:3], 0, *r[4:]) for r in _rows(200, 2) if r[1] is not None]
    df = spark.createDataFrame(rows, SCHEMA)
    found = by_arrival(df, ["who"], "part", ["t", "id"], [PreviousStep("imei")])
    plain = keyed.previous_value(df, ["who"], ["t", "id"], "imei", slices="none")
    assert rows_of(found) == rows_of(plain)


def test_names_that_a_row_has_win_and_empty_tables(spark):
    df = spark.createDataFrame([("a", 1, "m", "own"), ("a", 2, "n", "own")], "who string, t long, imei string, last_imei string")
    step = PreviousStep("imei")
    found = by_arrival(df.withColumn("part", F.lit(0)), ["who"], "part", ["t"], [step])
    assert found.columns == [*df.columns, "part"] and {r.last_imei for r in found.collect()} == {"own"}
    assert by_arrival(df.limit(0).withColumn("part", F.lit(0)), ["who"], "part", ["t"], [step]).count() == 0


SPEC = RollupSpec(["a", "b"], ["v"], ["user"], ["v"])
SETS = [["a", "b"], ["a"], []]


@pytest.fixture(scope="module")
def rolled(spark):
    rng = random.Random(3)
    rows = [
        (rng.choice(["x", "y", None]), rng.choice(["p", "q"]), rng.choice([None, *range(100)]), rng.randrange(3000))
        for _ in range(6000)
    ]
    schema = "a string, b string, v long, user long"
    folder, checkpoint, out = (run_dir(spark, n) for n in ("in", "checkpoint", "out"))
    for part in range(3):
        spark.createDataFrame(rows[part::3], schema).write.mode("append").parquet(folder)
        stream = spark.readStream.schema(schema).parquet(folder)
        start_rollup(stream, SPEC, checkpoint, out).awaitTermination()
    return rows, out


def test_rollups_of_micro_batches(spark, rolled):
    rows, out = rolled
    found = SPEC.read(SPEC.merged(partials(spark, out), SETS), (0.25, 0.5)).collect()
    seen = 0
    for r in found:
        by = {3: 0, 1: 1, 0: 2}[r.grouping]
        mine = [x for x in rows if by == 0 or x[0] == r.a and (by == 1 or x[1] == r.b)]
        values = sorted(x[2] for x in mine if x[2] is not None)
        assert r.n == len(mine) and r.sum_v == sum(values)
        assert abs(r.distinct_user - len({x[3] for x in mine})) <= 0.05 * len({x[3] for x in mine})
        for p, q in zip((0.25, 0.5), r.quantiles_v, strict=True):
            low, high = (sum(v < q for v in values), sum(v <= q for v in values))
            assert low - 0.03 * len(values) <= p * len(values) <= high + 0.03 * len(values)
        seen += by == 2
    assert seen == 6 and len(found) == 6 + 3 + 1


def test_compacted_partials_say_the_same(spark, rolled):
    _, out = rolled
    rows = partials(spark, out)
    small = compacted(SPEC, rows)
    assert rows.count() == 18 and small.count() == 6
    exact = [c for c in ("a", "b", "grouping", "n", "sum_v")]
    assert rows_of(SPEC.merged(small, SETS), *exact) == rows_of(SPEC.merged(rows, SETS), *exact)
