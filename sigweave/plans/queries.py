"""The registered queries: one or more for every operator."""

from __future__ import annotations

import json
from collections.abc import Callable
from dataclasses import replace

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from sigweave import functions as sf
from sigweave.functions.sql import register_functions
from sigweave.operators import keyed, latest, lookup, parse, project, stay
from sigweave.operators.arrival import by_arrival
from sigweave.operators.asof import as_of
from sigweave.operators.intervals import overlapping
from sigweave.operators.throttle import throttle
from sigweave.plans import config
from sigweave.plans import tables as t
from sigweave.plans.pipeline import EVENT, Pipeline
from sigweave.plans.rules import (
    AreaRule,
    FunctionRule,
    PreviousRule,
    StayRule,
    TrackRule,
    attach_rules,
    rules_state,
)
from sigweave.session import prepare, run_dir
from sigweave.sinks import all_columns_message, key_partition, keyed_message
from sigweave.sinks.latest_table import LatestTable
from sigweave.sinks.writers import event_frame
from sigweave.sources import VersionedDimension, read_dimension, read_lines
from sigweave.specs import EventSpec, InterfaceSpec, SinkSpec, SourceSpec
from sigweave.streaming.keyed import (
    STATE_RULES,
    keyed_rules,
    read_state,
    throttle_stream,
)
from sigweave.streaming.joins import within
from sigweave.streaming.rollups import RollupSpec, partials, start_rollup
from sigweave.streaming.run import run_to_table
from sigweave.streaming.steps import PreviousStep, StayStep
from sigweave.streaming.windows import WindowSpec, windowed

NOW = 1_717_200_000_123
HOUR_MS = 3_600_000
DAY_S = 86_400
KEYS = ["imsi"]
ORDER = ["ts_ms", "event_id"]
SITE_KEY = [("lac", "lac")]
STAY_LIMITS = [6 * HOUR_MS, 24 * HOUR_MS, 48 * HOUR_MS]
STAY_TIMEOUT = 24 * HOUR_MS
LINE_FIELDS = ["event_id", "lac", "ci", "imsi", "event_type"]

Query = DataFrame


# Parse, projection, filter, JSON


def parse_delimited(spark: SparkSession, sf_dir: str) -> Query:
    return parse.parse_delimited(t.lines_of(t.signals(spark, sf_dir)), LINE_FIELDS)


def parse_counts(spark: SparkSession, sf_dir: str) -> Query:
    """Lines read and lines rejected, as seen by the parse stage's observation."""
    lines = t.lines_of(t.signals(spark, sf_dir))
    counts = Observation("parse")
    rows = parse.parse_delimited(lines, LINE_FIELDS, observe=counts)
    rows.write.format("noop").mode("overwrite").save()
    found = counts.get
    return spark.createDataFrame(
        [(found["lines"], found["rejected"])], "lines long, rejected long"
    )


TYPED_FIELDS = [
    {"pname": "event_id", "ptype": "Long"},
    {"pname": "lac", "ptype": "int"},
    {"pname": "ci", "ptype": "Short"},
    {"pname": "amount", "ptype": "double"},
    {"pname": "event_type", "ptype": "Integer"},
    {"pname": "even", "ptype": "boolean"},
    {"pname": "day", "ptype": "java.sql.Date"},
    {"pname": "imsi", "ptype": "String"},
]


def typed_cast(spark: SparkSession, sf_dir: str) -> Query:
    text = t.signals(spark, sf_dir).selectExpr(
        "CAST(event_id AS STRING) AS event_id",
        "lac",
        "ci",
        "CASE WHEN k % 10 = 0 THEN '' ELSE CAST(CAST(floor(value) AS BIGINT) AS STRING) END"
        " AS amount",
        "event_type",
        "CASE WHEN k % 2 = 0 THEN 'true' ELSE 'false' END AS even",
        "concat('2024-02-', lpad(CAST(k % 31 + 1 AS STRING), 2, '0')) AS day",
        "imsi",
    )
    return parse.cast_fields(text, TYPED_FIELDS)


DERIVED = [
    ("lac_ci", "concat(lac, ':', ci)"),
    ("is_sale", "CASE WHEN event_type = 'purchase' THEN '1' ELSE '0' END"),
    ("hour", "CAST(ts_ms DIV 3600000 AS BIGINT)"),
]


def derive_filter(spark: SparkSession, sf_dir: str) -> Query:
    rows = t.signals(spark, sf_dir).select("event_id", "ts_ms", "event_type", "lac", "ci")
    return parse.derive_and_filter(rows, DERIVED, "is_sale = '1' AND lac_ci <> '0003:1'")


def event_select(spark: SparkSession, sf_dir: str) -> Query:
    return project.select_event(
        t.signals(spark, sf_dir),
        "event_type IN ('click', 'view') AND length(imei) >= 8",
        ["event_id", ("concat(lac, ci)", "site"), "event_id"],
        keys=KEYS,
        ext=[("'news'", "kind"), ("k * 2", "twice")],
    )


def json_roundtrip(spark: SparkSession, sf_dir: str) -> Query:
    rows = t.table(spark, sf_dir, "events").select("event_id", "event_type", "user_id", "props")
    text = rows.select(
        sf.row_to_json("event_id", "event_type", F.nullif("user_id", F.lit(3)).alias("user")).alias(
            "js"
        ),
        sf.json_to_map("props")["k"].alias("k"),
    )
    parsed = sf.json_to_columns(text, "js", "event_id long, event_type string")
    return parsed.select(
        "event_id",
        "event_type",
        "k",
        sf.json_to_map("js")["user"].alias("user_text"),
        F.size(sf.json_to_map("js")).alias("members"),
    )


def json_to_delimited(spark: SparkSession, sf_dir: str) -> Query:
    rows = t.signals(spark, sf_dir).select(
        "event_id",
        sf.row_to_json(
            "imsi", F.when(F.col("k") % 5 > 0, F.col("lac")).alias("lac"), "event_type"
        ).alias("js"),
    )
    names = ["imsi", "lac", "missing", "event_type"]
    return rows.select(
        "event_id",
        sf.json_to_delimited("js", names, "|").alias("kept"),
        sf.json_to_delimited("js", names, "|", skip_nulls=True).alias("shifted"),
    )


def json_array_explode(spark: SparkSession, sf_dir: str) -> Query:
    pairs = F.array(
        *[
            F.struct(F.lit(c).alias("pname"), F.col(c).alias("pvalue"))
            for c in ("lac", "ci", "event_type")
        ]
    )
    rows = t.signals(spark, sf_dir).select(
        "event_id", F.to_json(F.struct(pairs.alias("fields"))).alias("js")
    )
    return sf.explode_json_maps(rows, "js", ["pname", "pvalue"], "fields").drop("js")


# Scalar functions


def hex_code(spark: SparkSession, sf_dir: str) -> Query:
    rows = t.signals(spark, sf_dir).selectExpr(
        "event_id", "CAST((event_id % 1000) * 137 - 5000 AS STRING) AS number"
    )
    return rows.select("event_id", "number", sf.hex_code("number").alias("code"))


def time_convert(spark: SparkSession, sf_dir: str) -> Query:
    rows = t.signals(spark, sf_dir).select("event_id", "ts_ms")
    texts = rows.select(
        "event_id",
        sf.ms_to_text("ts_ms").alias("plain"),
        sf.ms_to_text("ts_ms", sf.MESSAGE_TIME_FORMAT).alias("stamp"),
    )
    return texts.select(
        "event_id",
        "plain",
        "stamp",
        sf.text_to_ms("plain").alias("plain_ms"),
        sf.text_to_ms("stamp", sf.MESSAGE_TIME_FORMAT).alias("stamp_ms"),
        sf.parse_time("stamp", sf.MESSAGE_TIME_FORMAT).alias("printed"),
    )


def time_offset(spark: SparkSession, sf_dir: str) -> Query:
    rows = t.signals(spark, sf_dir).select("event_id", (F.col("k") * 1000).alias("n"))
    return rows.select(
        "event_id",
        sf.now_ms(NOW).alias("now"),
        sf.now_minus("n", NOW).alias("before"),
        sf.now_plus("n", NOW).alias("after"),
    )


def geo_distance(spark: SparkSession, sf_dir: str) -> Query:
    rows = t.signals(spark, sf_dir).selectExpr(
        "event_id", "34.0 + (event_id % 1000) * 0.017 AS lat", "115.0 - k * 0.31 AS lon"
    )
    lat, lon = F.col("lat").cast("double"), F.col("lon").cast("double")
    distance = sf.great_circle_km(lat, lon, F.lit(36.65), F.lit(117.12))
    return rows.select("event_id", sf.whole_km(distance).alias("km"))


def composite_key(spark: SparkSession, sf_dir: str) -> Query:
    rows = t.signals(spark, sf_dir).select("event_id", "imsi", "lac", "k")
    maybe = F.when(F.col("k") % 6 > 0, F.col("lac"))
    return rows.select(
        "event_id",
        sf.composite_key("imsi", maybe, "k").alias("state_key"),
        sf.composite_key("imsi", maybe, sep=":").alias("event_key"),
        sf.text_concat("lac", "k").alias("both"),
    )


def identity_clean(spark: SparkSession, sf_dir: str) -> Query:
    return t.signals(spark, sf_dir).select(
        "event_id",
        sf.clean_identity("callingimsi").alias("caller"),
        sf.clean_identity("calledimsi").alias("called"),
        sf.device_code("callingimei").alias("caller_code"),
        sf.device_code("calledimei").alias("called_code"),
    )


def threshold_crossing(spark: SparkSession, sf_dir: str) -> Query:
    rows = t.signals(spark, sf_dir).selectExpr(
        "event_id",
        "CAST(k AS BIGINT) AS old",
        "CAST(k + event_id % 40 AS BIGINT) AS new",
    )
    limits = [60, 10, 30]
    old, new = F.col("old"), F.col("new")
    return rows.select(
        "event_id",
        sf.crossed_limit(old, new, limits).alias("greatest"),
        sf.crossed_limit(old, new, limits, match_max=False).alias("least"),
        sf.crossed_limit(old, new, limits, output_threshold=False).alias("true_value"),
        sf.crossed_limit(old, new, limits, strict=True).alias("strict"),
    )


def sql_functions(spark: SparkSession, sf_dir: str) -> Query:
    """The functions inside expression texts, as events and derived columns use them."""
    rows = t.signals(spark, sf_dir)
    register_functions(spark, NOW)
    found = rows.selectExpr(
        "event_id",
        "hex_code(CAST(k * 700 AS STRING)) AS code",
        "currenttimesub(k * 1000) AS before",
        "currenttimeadd(k * 1000) AS after",
        "text_to_ms(ms_to_text(ts_ms, 'yyyyMMdd HH:mm:ss.SSS'), 'yyyyMMdd HH:mm:ss.SSS')"
        " AS same_ms",
        "floor(great_circle_km(34 + event_id % 20, 115, 36.65, 117 + k)) AS km",
        "clean_identity(calledimsi) AS called",
        "device_code(imei) AS code8",
        "parse_time(ms_to_text(ts_ms, 'yyyyMMdd'), 'yyyyMMdd') AS printed",
    )
    # The fixed clock holds for this query only.
    register_functions(spark)
    return found


# Enrichment


def dimension_lookup(spark: SparkSession, sf_dir: str) -> Query:
    """Dimension source and plain look-up."""
    prepare(spark)
    users = read_dimension(
        spark,
        "parquet",
        path=f"{sf_dir}/customer.parquet",
        columns=["c_custkey", "c_name", "c_nationkey"],
    )
    rows = t.signals(spark, sf_dir).select("event_id", "k")
    missing = F.when(F.col("k") % 9 > 0, F.col("k"))
    found = lookup.lookup(
        rows.withColumn("who", missing), users, [("who", "c_custkey")], ["c_name", "c_nationkey"]
    )
    return found.select("event_id", "who", "_dim.c_name", "_dim.c_nationkey")


def area_flags(spark: SparkSession, sf_dir: str) -> Query:
    rows = t.signals(spark, sf_dir).select("event_id", "lac")
    return lookup.area_labels(rows, t.sites(spark, sf_dir), SITE_KEY, areas=[*t.AREAS, "R9"])


def area_attributes(spark: SparkSession, sf_dir: str) -> Query:
    rows = t.signals(spark, sf_dir).select("event_id", "lac", "ci")
    return lookup.area_labels(
        rows, t.sites(spark, sf_dir), SITE_KEY, attributes=["site_name", "areas"]
    )


def site_position(spark: SparkSession, sf_dir: str) -> Query:
    rows = t.signals(spark, sf_dir).select("event_id", "lac")
    return lookup.site_position(rows, t.sites(spark, sf_dir), SITE_KEY)


def party_info(spark: SparkSession, sf_dir: str) -> Query:
    rows = t.signals(spark, sf_dir).select("event_id", "imsi", "callingimsi", "calledimsi")
    return lookup.party_labels(rows, t.users(spark, sf_dir), ["c_name", "c_mktsegment"])


def terminal_info(spark: SparkSession, sf_dir: str) -> Query:
    rows = t.signals(spark, sf_dir).select("event_id", "imei", "callingimei", "calledimei")
    return lookup.terminal_labels(rows, t.terminals(spark, sf_dir), ["p_brand", "p_type"])


def site_as_of(spark: SparkSession, sf_dir: str) -> Query:
    """Where the row's site was at the row's time."""
    rows = t.signals(spark, sf_dir).select("event_id", "ts_ms", "lac")
    moves = t.site_moves(spark, sf_dir)
    found = as_of(
        rows,
        moves,
        SITE_KEY,
        "ts_ms",
        "valid_from",
        ["o_orderkey", "geo_longitude", "geo_latitude"],
        ties=["o_orderkey"],
    )
    return found.select("event_id", "lac", "_entry.*")


def events_in_periods(spark: SparkSession, sf_dir: str) -> Query:
    """All pairs of an event and a period that holds its time."""
    rows = t.signals(spark, sf_dir).select("event_id", "ts_ms")
    pairs = overlapping(
        rows, t.periods(spark, sf_dir), ("ts_ms", None), ("start_ms", "end_ms")
    )
    return pairs.select("left.event_id", "right.o_orderkey")


CHANGES = 3


def _changed_sites(spark: SparkSession, sf_dir: str, version: int) -> DataFrame:
    """Sites as they are while a part of the events arrives: some closed, others renamed."""
    sites = t.sites(spark, sf_dir).filter(F.col("lac").cast("int") % 5 != version)
    return sites.withColumn("site_name", F.concat("site_name", F.lit(f"/{version}")))


def changing_dimension_stream(spark: SparkSession, sf_dir: str) -> Query:
    """Area labels of a stream whose sites change while it runs, and after a restart."""
    prepare(spark)
    folder, checkpoint, out, place = (
        run_dir(spark, n) for n in ("arrivals", "checkpoint", "rows", "sites")
    )
    events = t.table(spark, sf_dir, "events")
    sites = VersionedDimension.open(spark, place, t.sites(spark, sf_dir).schema)
    rule = AreaRule("area", "sites", SITE_KEY, areas=["R1", "R2"], attributes=["site_name"])
    query = None
    for version in range(CHANGES):
        sites.wait(sites.publish(_changed_sites(spark, sf_dir, version)))
        arrived = events.filter(F.col("event_id") % CHANGES == version)
        arrived.write.mode("append").parquet(folder)
        if query is None:
            stream = t.as_signals(spark.readStream.schema(events.schema).parquet(folder))
            rows = attach_rules(
                stream.select("event_id", "lac"), [rule], {"sites": sites.latest()}, KEYS, ORDER
            )
            query = (
                rows.writeStream.format("parquet")
                .option("checkpointLocation", checkpoint)
                .option("path", out)
                .start()
            )
        query.processAllAvailable()
        # The first two parts meet one running stream, the last one another after a restart.
        if version != 0:
            query.stop()
            query = None
    return spark.read.schema(rows.schema).parquet(out)


# Keyed rules


def previous_value(spark: SparkSession, sf_dir: str) -> Query:
    rows = t.signals(spark, sf_dir).select("event_id", "ts_ms", "imsi", "imei")
    return keyed.previous_value(rows, KEYS, ORDER, "imei")


def _track_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = t.signals(spark, sf_dir).select("event_id", "ts_ms", "imsi", "lac", "ci")
    return lookup.site_position(rows, t.sites(spark, sf_dir), SITE_KEY)


def user_track(spark: SparkSession, sf_dir: str) -> Query:
    return keyed.user_track(_track_rows(spark, sf_dir), KEYS, ORDER)


def location_stay(spark: SparkSession, sf_dir: str) -> Query:
    rows = t.signals(spark, sf_dir).select("event_id", "ts_ms", "imsi", "lac")
    placed = lookup.area_labels(rows, t.sites(spark, sf_dir), SITE_KEY, areas=t.AREAS)
    stays = stay.location_stay(
        placed, KEYS, ORDER, t.AREAS, STAY_LIMITS, timeout_ms=STAY_TIMEOUT
    )
    return stays.select("event_id", "imsi", *[f"stay_{a}" for a in t.AREAS])


def _throttle_rows(rows: DataFrame) -> DataFrame:
    return rows.select("event_id", "ts_ms", "imsi", "event_type")


def event_throttle(spark: SparkSession, sf_dir: str) -> Query:
    return throttle(_throttle_rows(t.signals(spark, sf_dir)), KEYS, ORDER, DAY_S)


def _on_signals(
    spark: SparkSession,
    sf_dir: str,
    build: Callable[[DataFrame], DataFrame],
    arrived: list[DataFrame] | None = None,
) -> tuple[DataFrame, str]:
    """Rows and checkpoint of ``build`` on a stream of signals.

    The signals arrive in several batches in order of time. The stream ends after each and
    goes on from its checkpoint, so its state has to outlive both.
    """
    folder, checkpoint, out = (run_dir(spark, n) for n in ("arrivals", "checkpoint", "rows"))
    for part in arrived or t.arrivals(spark, sf_dir):
        part.write.mode("append").parquet(folder)
        stream = spark.readStream.schema(part.schema).parquet(folder)
        found = run_to_table(build(t.as_signals(stream)), checkpoint, out)
    return found, checkpoint


def _on_lines(
    spark: SparkSession,
    sf_dir: str,
    lines_of: Callable[[DataFrame], DataFrame],
    run: Callable[[DataFrame], Query],
) -> Query:
    """What the last call of ``run`` gives, one call for every batch of lines that arrives."""
    folder = run_dir(spark, "lines")
    for part in t.arrivals(spark, sf_dir):
        lines_of(t.as_signals(part)).write.mode("append").text(folder)
        found = run(read_lines(spark, SourceSpec("text", path=folder)))
    return found


def event_throttle_stream(spark: SparkSession, sf_dir: str) -> Query:
    def build(rows: DataFrame) -> DataFrame:
        return throttle_stream(_throttle_rows(rows), KEYS, ORDER, DAY_S)

    return _on_signals(spark, sf_dir, build)[0]


def dedup_latest(spark: SparkSession, sf_dir: str) -> Query:
    rows = t.signals(spark, sf_dir).select("event_id", "ts_ms", "imsi", "event_type", "value")
    return latest.latest_per_key(rows, KEYS, ORDER)


def latest_event_row(spark: SparkSession, sf_dir: str) -> Query:
    """Latest row table of an event after an earlier table was updated."""
    rows = project.select_event(
        t.signals(spark, sf_dir),
        "event_type = 'purchase'",
        ["event_id", "ts_ms", "value"],
        keys=KEYS,
    )
    middle = F.lit(1_705_276_800_000)
    older = latest.merge_latest(None, rows.filter(F.col("ts_ms") < middle), KEYS, ORDER)
    return latest.merge_latest(older, rows.filter(F.col("ts_ms") >= middle), KEYS, ORDER)


def state_snapshot(spark: SparkSession, sf_dir: str) -> Query:
    def build(rows: DataFrame) -> DataFrame:
        chosen = rows.select("event_id", "ts_ms", "imsi", "imei")
        return keyed_rules(chosen, KEYS, ORDER, [PreviousStep("imei")])

    return read_state(spark, _on_signals(spark, sf_dir, build)[1], STATE_RULES)


def greatest_payload(spark: SparkSession, sf_dir: str) -> Query:
    rows = t.signals(spark, sf_dir).select(
        "imsi", F.concat_ws(",", "imei", "event_type", "lac").alias("value")
    )
    return latest.greatest_payload(rows, KEYS)


# Windows and joins of streams


def _parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Signals with the part that they arrive with; some come one part late."""
    return t.signals(spark, sf_dir).withColumn("part", F.expr(t.LATE_PART))


WINDOW_MS, WINDOW_DELAY_MS = 6 * HOUR_MS, 2 * HOUR_MS


def windows_stream(spark: SparkSession, sf_dir: str) -> Query:
    """Closed windows of six hours per area, and the rows that came too late for theirs."""
    rows = _parts(spark, sf_dir).select("lac", "ts_ms", "k", "part")
    folder, checkpoint, out = (run_dir(spark, n) for n in ("arrivals", "checkpoint", "windows"))
    for part in range(3):
        rows.filter(F.col("part") == part).write.mode("append").parquet(folder)
        stream = spark.readStream.schema(rows.schema).parquet(folder)
        found = windowed(
            stream, ["lac"], "ts_ms", WindowSpec(WINDOW_MS), ["k"], delay_ms=WINDOW_DELAY_MS
        )
        table = run_to_table(found, checkpoint, out)
    return table.groupBy("kind", "lac", "start_ms", "end_ms").agg(
        F.sum("n").alias("n"), F.sum("k").alias("k")
    )


def _late_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _parts(spark, sf_dir).select("event_id", "ts_ms", "imsi", "lac", "part")
    return lookup.area_labels(rows, t.sites(spark, sf_dir), SITE_KEY, areas=["R1"])


LATE_STEP = StayStep("ts_ms", ["R1"], STAY_LIMITS, timeout_ms=STAY_TIMEOUT)


def late_stay(spark: SparkSession, sf_dir: str) -> Query:
    """Stay labels of a table some rows of which arrived late."""
    found = by_arrival(_late_rows(spark, sf_dir), KEYS, "part", ORDER, [LATE_STEP])
    return found.select("event_id", "stay_R1")


def late_stay_stream(spark: SparkSession, sf_dir: str) -> Query:
    """The same rows as they arrive in a stream."""
    rows = _late_rows(spark, sf_dir)
    folder, checkpoint, out = (run_dir(spark, n) for n in ("arrivals", "checkpoint", "stays"))
    for part in range(3):
        rows.filter(F.col("part") == part).write.mode("append").parquet(folder)
        stream = spark.readStream.schema(rows.schema).parquet(folder)
        labelled = keyed_rules(stream, KEYS, ORDER, [LATE_STEP])
        found = run_to_table(labelled.select("event_id", "stay_R1"), checkpoint, out)
    return found


ROLLUP = RollupSpec(["lac", "event_type", "hour"], ["k"], ["user_id"], ["k"])
ROLLUP_SETS = [["lac", "event_type", "hour"], ["lac", "event_type"], ["hour"], []]


def rollup_stream(spark: SparkSession, sf_dir: str) -> Query:
    """Counts and sums in four sets of groups, merged from three micro-batches, and whether the
    sketched number of users is within five percent of the true one."""
    rows = _parts(spark, sf_dir).select(
        "lac", "event_type", F.expr("ts_ms DIV 3600000 % 24").alias("hour"), "k", "user_id", "part"
    )
    folder, checkpoint, out = (run_dir(spark, n) for n in ("arrivals", "checkpoint", "partials"))
    for part in range(3):
        rows.filter(F.col("part") == part).write.mode("append").parquet(folder)
        stream = spark.readStream.schema(rows.schema).parquet(folder)
        start_rollup(stream, ROLLUP, checkpoint, out).awaitTermination()
    found = ROLLUP.read(ROLLUP.merged(partials(spark, out), ROLLUP_SETS))
    sets = [[F.col(c) for c in s] for s in ROLLUP_SETS]
    exact = rows.groupingSets(sets, *[F.col(c) for c in ROLLUP.groups]).agg(
        F.grouping_id().alias("grouping"), F.count_distinct("user_id").alias("users")
    )
    place = [*ROLLUP.groups, "grouping"]
    same = F.lit(True)
    for c in place:
        same = same & found[c].eqNullSafe(exact[c])
    close = F.abs(found["distinct_user_id"] - exact["users"]) <= 0.05 * exact["users"]
    return found.join(exact, same).select(
        *[found[c] for c in place], "n", "sum_k", close.alias("users_close")
    )


PAIR_MS, PAIR_DELAY_MS = 6 * HOUR_MS, 607_000


def _pair_sides(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Clicks and sales of users, with times of their own."""
    minute = F.expr("ts_ms DIV 60000 * 60000")
    clicks = rows.filter("event_type = 'click'").select(
        "imsi", F.col("event_id").alias("click_id"), (minute + 15_000).alias("click_ms"), "part"
    )
    sales = rows.filter("event_type = 'purchase'").select(
        "imsi", F.col("event_id").alias("sale_id"), (minute + 30_000).alias("sale_ms"), "part"
    )
    return clicks, sales


def pair_stream(spark: SparkSession, sf_dir: str) -> Query:
    """Sales up to six hours after a click of the same user; clicks without one once none can come."""
    rows = t.signals(spark, sf_dir).withColumn("part", F.expr(t.PART))
    sides = _pair_sides(rows)
    folders = [run_dir(spark, n) for n in ("clicks", "sales")]
    checkpoint, out = run_dir(spark, "checkpoint"), run_dir(spark, "pairs")
    for part in range(3):
        streams = []
        for side, folder in zip(sides, folders, strict=True):
            side.filter(F.col("part") == part).drop("part").write.mode("append").parquet(folder)
            streams.append(spark.readStream.schema(side.drop("part").schema).parquet(folder))
        found = within(
            *streams, ["imsi"], "click_ms", "sale_ms",
            after_ms=PAIR_MS, delay_ms=PAIR_DELAY_MS, how="left_outer",
        )
        table = run_to_table(found, checkpoint, out)
    return table


# Output


def _message_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return t.signals(spark, sf_dir).select(
        "event_id", "imsi", F.when(F.col("k") % 8 > 0, F.col("lac")).alias("lac"), "event_type"
    )


def keyed_message_query(spark: SparkSession, sf_dir: str) -> Query:
    rows = _message_rows(spark, sf_dir)
    return keyed_message(
        rows, ["imsi", "lac"], ["event_id", "lac", "event_type"], delim="|", topic="out", now=NOW
    )


def whole_row_message(spark: SparkSession, sf_dir: str) -> Query:
    return all_columns_message(_message_rows(spark, sf_dir), "lac", now=NOW)


def partition_by_key(spark: SparkSession, sf_dir: str) -> Query:
    rows = t.signals(spark, sf_dir).selectExpr(
        "event_id", "concat(imsi, '/', imei) AS key", "event_type AS value"
    )
    return key_partition(rows, 12)


EVENTS = [
    EventSpec(
        "sale",
        "event_type = 'purchase'",
        ["event_id", ("concat(lac, ':', ci)", "site")],
        ext=[("'S'", "kind")],
        sinks=(SinkSpec("parquet", topic="sales", delim="|"), SinkSpec("parquet", topic="copy")),
    ),
    EventSpec(
        "visit",
        "event_type IN ('view', 'click') AND k < 50",
        ["event_id", "event_type"],
        interval_s=DAY_S,
        sinks=(SinkSpec("parquet", topic="visits", delim=";"),),
    ),
]


def fan_out_sinks(spark: SparkSession, sf_dir: str) -> Query:
    """What every sink of two events received."""
    out = run_dir(spark, "sinks")
    interface = InterfaceSpec([], KEYS, "ts_ms", ["event_id"])
    flow = Pipeline(interface, events=EVENTS)

    def write(df: DataFrame, sink: SinkSpec) -> None:
        df.write.mode("append").parquet(f"{out}/{sink.topic}")

    flow.send(flow.detect(t.signals(spark, sf_dir)), now=NOW, write=write)
    parts = [
        spark.read.parquet(f"{out}/{sink.topic}") for e in EVENTS for sink in e.sinks
    ]
    result = parts[0]
    for part in parts[1:]:
        result = result.unionByName(part)
    return result


# Whole chains


def text_stream_ingest(spark: SparkSession, sf_dir: str) -> Query:
    checkpoint, out = run_dir(spark, "checkpoint"), run_dir(spark, "parsed")

    def run(lines: DataFrame) -> Query:
        return run_to_table(parse.parse_delimited(lines, LINE_FIELDS), checkpoint, out)

    return _on_lines(spark, sf_dir, t.lines_of, run)


CHAIN = [
    StayRule("stay", areas=t.AREAS, limits=STAY_LIMITS, timeout_ms=STAY_TIMEOUT, depends_on=["area"]),
    AreaRule("area", "sites", SITE_KEY, areas=t.AREAS, attributes=["site_name"]),
    PreviousRule("previous"),
    TrackRule("track", "sites", SITE_KEY),
    FunctionRule("moved", lambda df: df.withColumn("moved", F.col("distance") > 0), depends_on=["track"]),
]
CHAIN_OUTPUT = [
    "event_id",
    "imsi",
    "areainfo_site_name",
    "last_imei",
    "distance",
    "speed",
    "last_lac_ci",
    "moved",
    *[f"stay_{a}" for a in t.AREAS],
]


def _chain_input(rows: DataFrame) -> DataFrame:
    return rows.select("event_id", "ts_ms", "imsi", "imei", "lac", "ci")


def rule_chain(spark: SparkSession, sf_dir: str) -> Query:
    rows = _chain_input(t.signals(spark, sf_dir))
    dims = {"sites": t.sites(spark, sf_dir)}
    return attach_rules(rows, CHAIN, dims, KEYS, ORDER).select(*CHAIN_OUTPUT)


def rule_chain_stream(spark: SparkSession, sf_dir: str) -> Query:
    dims = {"sites": t.sites(spark, sf_dir)}

    def build(rows: DataFrame) -> DataFrame:
        return attach_rules(_chain_input(rows), CHAIN, dims, KEYS, ORDER).select(*CHAIN_OUTPUT)

    return _on_signals(spark, sf_dir, build)[0]


def rule_chain_resumed(spark: SparkSession, sf_dir: str) -> Query:
    """The chain on a table of the first part, then on a stream of the rest from its state."""
    dims = {"sites": t.sites(spark, sf_dir)}
    arrived = t.arrivals(spark, sf_dir)
    first = _chain_input(t.as_signals(arrived[0]))
    done = attach_rules(first, CHAIN, dims, KEYS, ORDER).select(*CHAIN_OUTPUT)
    state = rules_state(first, CHAIN, dims, KEYS, ORDER)

    def build(rows: DataFrame) -> DataFrame:
        chosen = _chain_input(rows)
        return attach_rules(chosen, CHAIN, dims, KEYS, ORDER, initial=state).select(*CHAIN_OUTPUT)

    if not arrived[1:]:
        return done
    return done.unionByName(_on_signals(spark, sf_dir, build, arrived[1:])[0])


FLOW_FIELDS = [
    {"pname": "event_id", "ptype": "long"},
    {"pname": "time", "ptype": "string"},
    {"pname": "lac", "ptype": "string"},
    {"pname": "ci", "ptype": "string"},
    {"pname": "imsi", "ptype": "string"},
    {"pname": "event_type", "ptype": "string"},
]
FLOW_EVENTS = [
    EventSpec(
        "stayed",
        "stay_R1 <> '0' OR stay_R2 <> '0'",
        ["event_id", "time", "event_type", "stay_R1", "stay_R2"],
        ext=[("'stay'", "kind")],
        interval_s=3 * DAY_S,
    )
]
FLOW_MESSAGE = ["event_id", "time", "event_type", "stay_R1", "stay_R2", "kind"]


def _flow(spark: SparkSession, sf_dir: str) -> Pipeline:
    return Pipeline(
        InterfaceSpec(
            FLOW_FIELDS,
            KEYS,
            "ts_ms",
            ["event_id"],
            derived=[("ts_ms", "unix_millis(try_to_timestamp(time, 'yyyyMMdd HH:mm:ss.SSS'))")],
            condition="event_type <> '' AND ts_ms IS NOT NULL",
            typed=True,
        ),
        rules=[
            AreaRule("area", "sites", SITE_KEY, areas=["R1", "R2"]),
            StayRule(
                "stay",
                areas=["R1", "R2"],
                limits=STAY_LIMITS,
                timeout_ms=STAY_TIMEOUT,
                depends_on=["area"],
            ),
        ],
        events=FLOW_EVENTS,
        dims={"sites": t.sites(spark, sf_dir)},
    )


def _flow_lines(rows: DataFrame) -> DataFrame:
    timed = rows.withColumn("time", sf.ms_to_text("ts_ms", sf.MESSAGE_TIME_FORMAT))
    return t.lines_of(timed, [f["pname"] for f in FLOW_FIELDS])


def _flow_messages(detected: DataFrame) -> DataFrame:
    event = FLOW_EVENTS[0]
    rows = project.project_event(
        detected.filter(F.col(EVENT) == event.id), event.select, keys=KEYS, ext=event.ext
    )
    return keyed_message(rows, KEYS, FLOW_MESSAGE, topic="stays", now=NOW)


def enriched_events(spark: SparkSession, sf_dir: str) -> Query:
    """Lines to messages: parse, area and stay labels, event, throttle, message."""
    flow = _flow(spark, sf_dir)
    return _flow_messages(flow.run(_flow_lines(t.signals(spark, sf_dir))))


def enriched_events_stream(spark: SparkSession, sf_dir: str) -> Query:
    flow = _flow(spark, sf_dir)
    checkpoint, out = run_dir(spark, "checkpoint"), run_dir(spark, "messages")

    def run(lines: DataFrame) -> Query:
        return run_to_table(_flow_messages(flow.run(lines)), checkpoint, out)

    return _on_lines(spark, sf_dir, _flow_lines, run)


def _named(**values: str) -> list[dict[str, str]]:
    return [{"pname": k, "pvalue": v} for k, v in values.items()]


# A pipeline as configuration records describe it.
CONFIG_FIELDS = ["event_id", "time", "lac", "ci", "imsi", "imei", "event_type"]
CONFIG_STORE = {
    "type": "kafka",
    "properties": json.dumps(_named(**{"metadata.broker.list": "host:9092"})),
}
CONFIG_INTERFACE = {
    "properties": json.dumps(
        {
            "props": _named(uniqKeys="imsi", delim="[|]", filter_expr="event_type <> ''"),
            "fields": [{"pname": n, "ptype": "String", "pvalue": ""} for n in CONFIG_FIELDS],
            "userFields": _named(lac_code="Conv(lac)", ci_code="convertHex(ci)"),
        }
    )
}
CONFIG_LABELS = [
    {
        "id": "11",
        "class_name": "labels.ExtLastimeiRule",
        "p_label_id": "10",
        "properties": json.dumps({"props": [], "labelItems": []}),
    },
    {
        "id": "10",
        "class_name": "labels.SiteRule",
        "p_label_id": "",
        "properties": json.dumps(
            {
                "props": [],
                "labelItems": [{"pname": "x", "pvalue": v} for v in ("area_R1", "areainfo_site_name")],
            }
        ),
    },
]
CONFIG_EVENT = {
    "id": "moved",
    "select_expr": "event_id, concat(lac_code, ':', ci_code) as site, last_imei, areainfo_site_name",
    "filter_expr": "area_R1 = 'true' and last_imei <> '' and last_imei <> imei",
    "properties": json.dumps(
        {
            "props": _named(ext_fields="'1' as kind"),
            "output_dis": [{"diid": "9", "interval": "0", "delim": "#"}],
        }
    ),
}
CONFIG_OUTPUT = {"properties": json.dumps({"props": _named(topic="moves")})}


def configured_pipeline(spark: SparkSession, sf_dir: str) -> Query:
    """Messages of a pipeline that is made from configuration records."""
    interface = config.interface_spec(CONFIG_INTERFACE)
    event = config.event_spec(CONFIG_EVENT, {"9": (CONFIG_STORE, CONFIG_OUTPUT)})
    cells = t.sites(spark, sf_dir).withColumn("ci", F.explode(F.array(*[F.lit(str(i)) for i in range(3)])))
    flow = Pipeline(
        # The records name no order within a time.
        replace(interface, order=["event_id"]),
        config.rule_chain(CONFIG_LABELS),
        [event],
        {"sites": cells},
    )
    rows = t.signals(spark, sf_dir)
    timed = rows.withColumn("time", sf.ms_to_text("ts_ms", sf.MESSAGE_TIME_FORMAT))
    detected = flow.run(t.lines_of(timed, CONFIG_FIELDS, "|"))
    return event_frame(detected, event, event.sinks[0], flow.interface.keys, now=NOW)


def bad_time_stream(spark: SparkSession, sf_dir: str) -> Query:
    """Stay labels of a stream in which some records have a time that cannot be read."""
    base = _flow(spark, sf_dir)
    flow = replace(base, interface=replace(base.interface, condition="event_type <> ''"))
    checkpoint, out = run_dir(spark, "checkpoint"), run_dir(spark, "stays")

    def lines_of(rows: DataFrame) -> DataFrame:
        stamp = sf.ms_to_text("ts_ms", sf.MESSAGE_TIME_FORMAT)
        time = F.when(F.col("event_id") % 13 == 0, "no time").otherwise(stamp)
        return t.lines_of(rows.withColumn("time", time), [f["pname"] for f in FLOW_FIELDS])

    def run(lines: DataFrame) -> Query:
        labelled = flow.enrich(flow.parse(lines))
        chosen = labelled.select("event_id", "time", "stay_R1", "stay_R2")
        return run_to_table(chosen, checkpoint, out)

    return _on_lines(spark, sf_dir, lines_of, run)


def latest_without_sink(spark: SparkSession, sf_dir: str) -> Query:
    """Latest rows that a started pipeline keeps for an event that sends nothing."""
    event = EventSpec("sale", "event_type = 'purchase'", ["event_id"], keep_latest=True)
    flow = replace(_flow(spark, sf_dir), rules=(), events=[event])
    checkpoint = run_dir(spark, "checkpoint")

    def run(lines: DataFrame) -> Query:
        flow.start(lines, checkpoint).awaitTermination()
        kept = flow.latest_of_stream(spark, checkpoint, event)
        return kept.select("imsi", "event_id", "time", "ts_ms")

    return _on_lines(spark, sf_dir, _flow_lines, run)


def latest_table_stream(spark: SparkSession, sf_dir: str) -> Query:
    """Table of the latest sale of each user, kept by a stream that sends one sale a day."""
    folder = run_dir(spark, "latest")
    event = EventSpec(
        "sale", "event_type = 'purchase'", ["event_id", "time"],
        interval_s=DAY_S, keep_latest=True, latest_path=folder,
    )
    flow = replace(_flow(spark, sf_dir), rules=(), events=[event])
    checkpoint = run_dir(spark, "checkpoint")

    def run(lines: DataFrame) -> Query:
        flow.start(lines, checkpoint).awaitTermination()
        table = LatestTable(folder, KEYS, flow.order).read(spark)
        return table.select("imsi", "event_id", "time", "ts_ms")

    return _on_lines(spark, sf_dir, _flow_lines, run)


QUERIES = {
    "parse_delimited": parse_delimited,
    "parse_counts": parse_counts,
    "typed_cast": typed_cast,
    "derive_filter": derive_filter,
    "event_select": event_select,
    "json_roundtrip": json_roundtrip,
    "json_to_delimited": json_to_delimited,
    "json_array_explode": json_array_explode,
    "hex_code": hex_code,
    "time_convert": time_convert,
    "time_offset": time_offset,
    "geo_distance": geo_distance,
    "composite_key": composite_key,
    "identity_clean": identity_clean,
    "threshold_crossing": threshold_crossing,
    "sql_functions": sql_functions,
    "dimension_lookup": dimension_lookup,
    "area_flags": area_flags,
    "area_attributes": area_attributes,
    "site_position": site_position,
    "site_as_of": site_as_of,
    "events_in_periods": events_in_periods,
    "changing_dimension_stream": changing_dimension_stream,
    "party_info": party_info,
    "terminal_info": terminal_info,
    "previous_value": previous_value,
    "user_track": user_track,
    "location_stay": location_stay,
    "event_throttle": event_throttle,
    "event_throttle_stream": event_throttle_stream,
    "dedup_latest": dedup_latest,
    "latest_event_row": latest_event_row,
    "state_snapshot": state_snapshot,
    "greatest_payload": greatest_payload,
    "windows_stream": windows_stream,
    "pair_stream": pair_stream,
    "late_stay": late_stay,
    "late_stay_stream": late_stay_stream,
    "rollup_stream": rollup_stream,
    "keyed_message": keyed_message_query,
    "whole_row_message": whole_row_message,
    "fan_out_sinks": fan_out_sinks,
    "partition_by_key": partition_by_key,
    "text_stream_ingest": text_stream_ingest,
    "rule_chain": rule_chain,
    "rule_chain_stream": rule_chain_stream,
    "rule_chain_resumed": rule_chain_resumed,
    "enriched_events": enriched_events,
    "enriched_events_stream": enriched_events_stream,
    "configured_pipeline": configured_pipeline,
    "bad_time_stream": bad_time_stream,
    "latest_without_sink": latest_without_sink,
    "latest_table_stream": latest_table_stream,
}
