"""Rule order, pipelines, sources and sinks."""

import time

import pytest
from pyspark.sql import functions as F

from sigweave.operators.parse import derive_and_filter
from sigweave.operators.slices import plan_slices
from sigweave.plans import queries as q
from sigweave.plans import tables as t
from sigweave.plans.pipeline import EVENT, Pipeline
from sigweave.plans.rules import (
    RULES,
    BaseRule,
    FunctionRule,
    PreviousRule,
    StayRule,
    attach_rules,
    ordered_rules,
    register_rule,
)
from sigweave.session import run_dir
from sigweave.sinks import all_columns_message, jdbc_options, key_partition, keyed_message
from sigweave.sinks.writers import kafka_sink_options, of_batch, write_sink
from sigweave.sources import kafka_options, read_dimension, read_lines
from sigweave.specs import EventSpec, InterfaceSpec, SinkSpec, SourceSpec
from sigweave.streaming.monitor import StageMonitor
from sigweave.streaming.run import run_to_table
from tests.conftest import rows_of


def _rule(name, *parents):
    return BaseRule(name, depends_on=parents)


def test_rules_follow_their_parents():
    rules = [_rule("c", "b"), _rule("a"), _rule("b", "a"), _rule("d")]
    assert [r.name for r in ordered_rules(rules)] == ["a", "b", "c", "d"]


def test_rule_cycles_and_unknown_parents():
    with pytest.raises(ValueError, match="a -> b -> a"):
        ordered_rules([_rule("a", "b"), _rule("b", "a")])
    with pytest.raises(ValueError, match="unknown rule 'x'"):
        ordered_rules([_rule("a", "x")])
    with pytest.raises(ValueError, match="unique"):
        ordered_rules([_rule("a"), _rule("a")])


def test_user_rules(spark):
    @register_rule("shout")
    class Shout(BaseRule):
        def attach(self, df, context):
            return df.withColumn("loud", F.upper(context.keys[0]))

    try:
        df = spark.createDataFrame([("a", 1)], "who string, t long")
        chain = [
            FunctionRule("twice", lambda d: d.withColumn("two", F.concat("loud", "loud")), depends_on=["s"]),
            RULES["shout"]("s"),
        ]
        found = attach_rules(df, chain, {}, ["who"], ["t"])
        assert found.first()[:] == ("a", 1, "A", "AA")
        with pytest.raises(ValueError):
            register_rule("shout")(Shout)
    finally:
        del RULES["shout"]


def test_neighbouring_keyed_rules_share_one_state(spark, sf_dir):
    schema = t.table(spark, sf_dir, "events").schema
    stream = spark.readStream.schema(schema).parquet(f"{sf_dir}/events.parque[t]")
    rows = q._chain_input(t.as_signals(stream))
    dims = {"sites": t.sites(spark, sf_dir)}
    labelled = attach_rules(rows, q.CHAIN, dims, q.KEYS, q.ORDER)
    plan = labelled._jdf.queryExecution().logical().toString()
    assert plan.count("TransformWithState") == 1


def test_pipeline_with_cut_keys(spark, sf_dir):
    flow = q._flow(spark, sf_dir)
    rows = flow.parse(q._flow_lines(t.signals(spark, sf_dir)))
    plan = plan_slices(rows, q.KEYS, q.ORDER, rows_per_slice=10)
    assert plan.hot
    cut = flow.detect(flow.enrich(rows, plan), plan)
    whole = flow.run(q._flow_lines(t.signals(spark, sf_dir)))
    assert rows_of(cut, *whole.columns) == rows_of(whole)


def test_one_shuffle_for_stay_and_throttle(spark, sf_dir):
    plan = q.enriched_events(spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1


def test_streamed_pipeline_sends_to_all_sinks(spark, sf_dir):
    source = run_dir(spark, "lines")
    lines = q._flow_lines(t.signals(spark, sf_dir))
    lines.coalesce(1).write.text(source)
    out = run_dir(spark, "sinks")
    flow = q._flow(spark, sf_dir)
    event = EventSpec(
        **{
            **q.FLOW_EVENTS[0].__dict__,
            "keep_latest": True,
            "sinks": (
                SinkSpec("parquet", path=f"{out}/a", topic="stays"),
                SinkSpec("parquet", path=f"{out}/b", delim="|", partitions=7),
            ),
        }
    )
    flow = Pipeline(**{**flow.__dict__, "events": [event]})
    checkpoint = run_dir(spark, "checkpoint")
    stream = read_lines(spark, SourceSpec("text", path=source))
    flow.start(stream, checkpoint, now=q.NOW).awaitTermination()
    expected = q.enriched_events(spark, sf_dir)
    found = spark.read.parquet(f"{out}/a")
    assert rows_of(found) == rows_of(expected)
    other = spark.read.parquet(f"{out}/b")
    assert other.count() == found.count()
    assert other.columns == ["key", "value", "partition"]
    assert other.filter("partition < 0 OR partition > 6").count() == 0
    newest = flow.latest_of_stream(spark, checkpoint, event)
    by_batch = flow.latest(flow.enrich(flow.parse(lines)), event)
    assert rows_of(newest, *by_batch.columns) == rows_of(by_batch)


def test_stages_are_counted(spark, sf_dir):
    source = run_dir(spark, "lines")
    lines = q._flow_lines(t.signals(spark, sf_dir))
    lines.coalesce(1).write.text(source)
    flow = Pipeline(**{**q._flow(spark, sf_dir).__dict__, "observe": "flow"})
    monitor = StageMonitor()
    spark.streams.addListener(monitor)
    try:
        stream = read_lines(spark, SourceSpec("text", path=source))
        found = run_to_table(flow.run(stream), run_dir(spark, "c"), run_dir(spark, "o"))
        for _ in range(100):
            if any(b["rows"] for b in monitor.batches):
                break
            time.sleep(0.1)
    finally:
        spark.streams.removeListener(monitor)
    seen = {}
    for batch in monitor.batches:
        if batch["rows"]:
            for counts in batch["observed"].values():
                seen.update(counts)
    assert seen["lines"] == lines.count()
    assert seen["rejected"] == lines.filter("size(split(value, ',')) <> 6").count() > 0
    assert seen["rows"] == flow.parse(lines).count()
    assert seen["events"] == found.count()
    assert found.count() == flow.run(lines).count()


def test_events_without_interval_need_no_state(spark):
    interface = InterfaceSpec(["who", "t"], ["who"], "t")
    flow = Pipeline(interface, events=[EventSpec("all", "", ["who"]), EventSpec("b", "who = 'b'", ["t"])])
    lines = spark.createDataFrame([("a,1",), ("b,2",), ("b",)], "value string")
    found = flow.run(lines)
    assert rows_of(found, EVENT, "who") == [("all", "a"), ("all", "b"), ("b", "b")]
    assert "MapInArrow" not in found._jdf.queryExecution().executedPlan().toString()


def test_kafka_source_options():
    spec = SourceSpec(
        "kafka",
        topics=["a", "b"],
        brokers="h:1",
        group="g",
        min_partitions=6,
        offsets={"a": {1: 7, 0: 5}, "b": {2: 1}},
        options={"maxOffsetsPerTrigger": "10"},
    )
    assert kafka_options(spec) == {
        "kafka.bootstrap.servers": "h:1",
        "assign": '{"a": [0, 1], "b": [2]}',
        "kafka.group.id": "g",
        "minPartitions": "6",
        "startingOffsets": '{"a": {"1": 7, "0": 5}, "b": {"2": 1}}',
        "maxOffsetsPerTrigger": "10",
    }
    with pytest.raises(ValueError):
        kafka_options(SourceSpec("kafka", topics=["a"]))
    with pytest.raises(ValueError):
        kafka_options(
            SourceSpec("kafka", topics=["a", "b"], brokers="h:1", offsets={"a": {0: 1}})
        )


class _Recorder:
    """Stands in for a reader or writer and notes what is asked of it."""

    def __init__(self, frame=None):
        self.frame, self.calls = frame, {}

    def format(self, name):
        self.calls["format"] = name
        return self

    def option(self, name, value):
        self.calls[name] = value
        return self

    def options(self, **options):
        self.calls["options"] = options
        return self

    def mode(self, mode):
        self.calls["mode"] = mode
        return self

    def load(self):
        return self.frame

    def save(self):
        self.calls["saved"] = True


class _Session:
    def __init__(self, reader):
        self.readStream = self.read = reader


def test_kafka_payload(spark):
    frame = spark.createDataFrame(
        [(bytearray(b"k"), bytearray(b"v"))], "key binary, value binary"
    )
    for payload, text in (("value", "v"), ("key", "k")):
        spec = SourceSpec("kafka", topics=["a"], brokers="h:1", payload=payload)
        reader = _Recorder(frame)
        found = read_lines(_Session(reader), spec)
        assert found.columns == ["value"] and found.first()[0] == text
        assert reader.calls["format"] == "kafka"
    with pytest.raises(ValueError):
        read_lines(_Session(_Recorder(frame)), SourceSpec("kafka", topics=["a"], brokers="h", payload="x"))


def test_other_kinds_are_refused(spark):
    with pytest.raises(ValueError):
        read_lines(spark, SourceSpec("socket"))
    with pytest.raises(ValueError):
        read_dimension(spark, "socket")
    with pytest.raises(ValueError):
        write_sink(spark.range(1), SinkSpec("hdfs"))
    with pytest.raises(ValueError):
        jdbc_options(SinkSpec("jdbc", url="u"))
    with pytest.raises(ValueError):
        kafka_sink_options(SinkSpec("kafka", topic="t"))


def test_writers_get_their_options():
    class Frame:
        write = _Recorder()

    spec = SinkSpec("jdbc", url="jdbc:x", table="t", options={"user": "u", "batchsize": "500"})
    write_sink(Frame, spec)
    assert Frame.write.calls == {
        "format": "jdbc",
        "options": {"url": "jdbc:x", "dbtable": "t", "user": "u", "batchsize": "500"},
        "mode": "append",
        "saved": True,
    }
    Frame.write = _Recorder()
    write_sink(Frame, SinkSpec("kafka", brokers="h:1", topic="t"))
    assert Frame.write.calls["options"] == {"kafka.bootstrap.servers": "h:1"}


def test_text_table(spark):
    path = run_dir(spark, "text")
    spark.createDataFrame([("a,b",)], "value string").write.text(path)
    assert read_lines(spark, SourceSpec("text", path=path), streaming=False).first()[0] == "a,b"


def test_dimension_with_composite_key(spark):
    path = run_dir(spark, "dim")
    spark.createDataFrame(
        [("site:1:7", "A"), ("user:5", "B"), ("site:2:8:9", "C")], "key string, areas string"
    ).write.parquet(path)
    found = read_dimension(spark, "parquet", path=path, key=["lac", "ci"], prefix="site")
    assert rows_of(found, "lac", "ci", "areas") == [("1", "7", "A"), ("2", "8:9", "C")]


def test_messages(spark):
    df = spark.createDataFrame(
        [("u", None, 1), (None, "x", 2), (None, None, 3)], "a string, b string, n int"
    )
    found = keyed_message(df, ["a", "b"], ["n", "b"], delim="|", topic="out", now=0)
    stamp = "19700101 00:00:00.000"
    assert [tuple(r) for r in found.collect()] == [
        ("u,", f"1||{stamp}", "out"),
        (",x", f"2|x|{stamp}", "out"),
        (None, f"3||{stamp}", "out"),
    ]
    shifted = keyed_message(df, ["a"], ["n", "b"], now=0, skip_nulls=True)
    assert shifted.first().value == f"1,{stamp}"
    assert keyed_message(df, [], ["n"], now=0).first().key is None
    assert all_columns_message(df, "absent", now=0).first()[:] == (None, f"u,,1,{stamp}")


def test_messages_without_key_are_spread(spark):
    df = spark.range(200).select(
        F.lit(None).cast("string").alias("key"), F.col("id").cast("string").alias("value")
    )
    found = key_partition(df, 8)
    assert found.select("partition").distinct().count() == 8


def _flow(**more):
    return Pipeline(
        InterfaceSpec(
            fields=["who", "t", "flag"],
            keys=["who"],
            time="ms",
            derived=[("ms", "try_cast(t AS BIGINT)"), ("on", "flag = 'y'")],
        ),
        **more,
    )


def _text_stream(spark, lines):
    path = run_dir(spark, "lines")
    spark.createDataFrame([(x,) for x in lines], "value string").coalesce(1).write.text(path)
    return spark.readStream.text(path)


def test_bad_time_and_no_sink_do_not_stop_a_stream(spark):
    flow = _flow(
        rules=[FunctionRule("near", lambda d: d.withColumn("area_A", F.lit("true"))),
               StayRule("stay", areas=["A"], limits=[5], depends_on=["near"])],
        events=[EventSpec("all", None, [], keep_latest=True)],
    )
    checkpoint = run_dir(spark, "checkpoint")
    query = flow.start(_text_stream(spark, ["a,1,y", "a,bad,y", "a,9,n"]), checkpoint)
    query.awaitTermination()
    assert query.exception() is None
    latest = flow.latest_of_stream(spark, checkpoint, flow.events[0])
    assert rows_of(latest, "who", "ms", "stay_A") == [("a", 9, "5")]


def test_processing_clock_on_a_table(spark):
    event = EventSpec("all", None, [], interval_s=10)
    lines = spark.createDataFrame([("a,1,y",), ("a,99000,y",), ("b,2,n",)], "value string")
    assert rows_of(_flow(events=[event]).run(lines), "who", "ms") == [("a", 1), ("a", 99000), ("b", 2)]
    found = _flow(events=[event], clock="processing").run(lines)
    assert rows_of(found, "who", "ms") == [("a", 1), ("b", 2)]


def test_previous_value_of_a_boolean_is_the_same_on_streams(spark):
    flow = _flow(rules=[PreviousRule("last", column="on", label="was")], events=[EventSpec("all", None, [])])
    lines = ["a,1,y", "a,2,n", "a,3,y"]
    table = spark.createDataFrame([(x,) for x in lines], "value string")
    expected = flow.run(table)
    found = run_to_table(
        flow.run(_text_stream(spark, lines)), run_dir(spark, "checkpoint"), run_dir(spark, "out")
    )
    assert found.columns == expected.columns
    assert rows_of(found) == rows_of(expected)
    assert rows_of(found, "was") == [("",), ("false",), ("true",)]


def test_quoted_names_in_a_filter(spark):
    rows = spark.createDataFrame([(1,), (5,)], "x int")
    found = derive_and_filter(rows, [("my-col", "x + 1"), ("y", "x")], "`my-col` > 3")
    assert rows_of(found) == [(5, 6, 5)]


def test_a_repeated_batch_replaces_its_first_try(spark):
    path = run_dir(spark, "sink")
    sink = SinkSpec("parquet", path=path, by_batch=True)
    flow = _flow(events=[EventSpec(i, None, ["who"], sinks=(sink,)) for i in ("e", "f")])
    rows = flow.run(spark.createDataFrame([("a,1,y",), ("b,2,n",)], "value string"))
    for batch_id in (0, 1, 1):
        flow.send(rows, batch_id=batch_id)
    found = spark.read.parquet(path)
    assert rows_of(found.groupBy("batch_id", "output").count()) == [
        (0, 0, 2), (0, 1, 2), (1, 0, 2), (1, 1, 2)
    ]
    frame, _ = of_batch(spark.range(1), SinkSpec("jdbc", by_batch=True), 7, 0)
    assert rows_of(frame, "batch_id") == [(7,)]
