"""The latest-row table: upserts, replays, readers, and pipelines that keep one."""

import random

from pyspark.sql import functions as F

from sigweave.plans.pipeline import Pipeline
from sigweave.session import run_dir
from sigweave.sinks.latest_table import LatestTable
from sigweave.specs import EventSpec, InterfaceSpec, SinkSpec
from tests.conftest import rows_of

SCHEMA = "k string, t long, v string"


def _newest(rows):
    best = {}
    for k, t, v in rows:
        if k not in best or t >= best[k][1]:
            best[k] = (k, t, v)
    return sorted(best.values(), key=repr)


def test_upserts_replays_and_touched_buckets(spark):
    table = LatestTable(run_dir(spark, "latest"), ["k"], ["t"], buckets=8)
    assert table.read(spark) is None
    rng = random.Random(1)
    rows = [(rng.choice([None, *map(str, range(30))]), i * 7 % 211, f"v{i}") for i in range(200)]
    done = []
    for n in range(4):
        part = rows[n * 50 : n * 50 + 50]
        done += part
        assert table.upsert(spark.createDataFrame(part, SCHEMA), batch_id=n)
        assert rows_of(table.read(spark)) == _newest(done)
    # A repeated batch changes nothing, whatever it holds.
    again = spark.createDataFrame([("1", 10**6, "again")], SCHEMA)
    assert not table.upsert(again, batch_id=3) and rows_of(table.read(spark)) == _newest(done)
    # One key touches one bucket; a reader that began before keeps what it saw.
    before, places = table.read(spark), table.places(spark)
    assert table.upsert(again, batch_id=4)
    after = table.places(spark)
    assert sum(places[b] != after[b] for b in places) == 1
    assert rows_of(before) == _newest(done)
    assert rows_of(table.read(spark)) == _newest([*done, ("1", 10**6, "again")])
    # An older row does not replace a newer one, and an empty batch is fine.
    assert table.upsert(spark.createDataFrame([("1", 5, "old")], SCHEMA), batch_id=5)
    assert table.upsert(spark.createDataFrame([], SCHEMA), batch_id=6)
    assert rows_of(table.read(spark)) == _newest([*done, ("1", 10**6, "again")])


def _flow(path, sent):
    return Pipeline(
        InterfaceSpec(["k", "at", "v"], ["k"], "t", derived=[("t", "CAST(at AS BIGINT)")]),
        events=[
            EventSpec(
                "e", "v <> 'no'", [("upper(v)", "name")], interval_s=1, keep_latest=True, latest_path=path,
                sinks=(SinkSpec("parquet", path=sent),),
            ),
            EventSpec("plain", "v = 'a'", ["v"], sinks=(SinkSpec("parquet", path=sent + "-plain"),)),
        ],
    )


def test_a_stream_keeps_a_table_of_rows_sent_or_not(spark):
    path, sent, feed, checkpoint = (run_dir(spark, n) for n in ("latest", "sent", "in", "checkpoint"))
    flow = _flow(path, sent)
    batches = [["x,0,a", "x,500,b", "y,10,a"], ["x,400,c", "y,20,no", "z,1,a"], ["x,1500,d"]]
    expected = [
        [("A", "y", 10), ("B", "x", 500)],
        [("A", "y", 10), ("A", "z", 1), ("B", "x", 500)],
        [("A", "y", 10), ("A", "z", 1), ("D", "x", 1500)],
    ]
    for lines, rows in zip(batches, expected, strict=True):
        spark.createDataFrame([(x,) for x in lines], "value string").coalesce(1).write.mode("append").text(feed)
        stream = spark.readStream.text(feed)
        flow.start(stream, checkpoint, now=0).awaitTermination()
        assert rows_of(LatestTable(path, ["k"], ["t"]).read(spark), "name", "k", "t") == rows
    # The throttle lets through what it did before.
    values = [r.value.split(",")[0] for r in spark.read.parquet(sent).collect()]
    assert sorted(values) == ["A", "A", "A", "D"]
    assert spark.read.parquet(sent + "-plain").count() == 3


def test_a_table_of_lines_keeps_one_too(spark):
    path, sent = run_dir(spark, "latest"), run_dir(spark, "sent")
    lines = spark.createDataFrame([("x,0,a",), ("x,500,b",), ("y,10,no",)], "value string")
    _flow(path, sent).process(lines, now=0)
    assert rows_of(LatestTable(path, ["k"], ["t"]).read(spark), "name", "k", "t") == [("B", "x", 500)]
    assert spark.read.parquet(sent).count() == 1
    assert spark.read.parquet(sent + "-plain").select(F.count("*")).first()[0] == 1
