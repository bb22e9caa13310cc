"""Signalling-shaped views over the supplied tables, for Spark and for the SQL checks."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sigweave.session import prepare

# The expressions of a signal row, valid in Spark SQL and in DuckDB alike.
_PAD = "concat('46', lpad(CAST({} AS STRING), 13, '0'))"
_SIGNAL = [
    ("event_id", "event_id"),
    ("ts_ms", "ts_ms"),
    ("user_id", "user_id"),
    ("event_type", "event_type"),
    ("value", "value"),
    ("k", "k"),
    ("lac", "lpad(CAST(event_id % 26 AS STRING), 4, '0')"),
    ("ci", "CAST(k % 4 AS STRING)"),
    ("imsi", _PAD.format("user_id")),
    (
        "callingimsi",
        "CASE WHEN k % 50 = 12 THEN ''"
        f" WHEN k % 50 = 15 THEN {_PAD.format('k + 1')}"
        f" WHEN k % 7 = 0 THEN {_PAD.format('k')}"
        f" ELSE {_PAD.format('user_id')} END",
    ),
    (
        "calledimsi",
        f"CASE WHEN k % 7 = 0 THEN {_PAD.format('user_id')}"
        " WHEN k % 10 = 1 THEN ''"
        " WHEN k % 10 = 2 THEN '000000000000000'"
        f" WHEN k % 10 = 3 THEN {_PAD.format('user_id')}"
        f" ELSE {_PAD.format('k')} END",
    ),
    (
        "imei",
        "CASE WHEN k % 25 = 24 THEN '123'"
        " ELSE concat(lpad(CAST(user_id % 200 AS STRING), 8, '0'),"
        " lpad(CAST(k % 3 AS STRING), 7, '0')) END",
    ),
    (
        "calledimei",
        "CASE WHEN k % 10 = 2 THEN '000000000000000'"
        " ELSE concat(lpad(CAST(k AS STRING), 8, '0'), '0000009') END",
    ),
]
_SITE = [
    ("lac", "lpad(CAST(n_nationkey AS STRING), 4, '0')"),
    (
        "areas",
        "concat('R', CAST(n_regionkey AS STRING), ', R',"
        " CAST((n_regionkey + 1) % 5 AS STRING))",
    ),
    ("site_name", "n_name"),
    ("geo_longitude", "CAST(n_nationkey * 0.5 + 115.0 AS DOUBLE)"),
    ("geo_latitude", "CAST(n_nationkey * 0.25 + 34.0 AS DOUBLE)"),
]
_USER = [
    ("imsi", _PAD.format("c_custkey")),
    ("c_name", "c_name"),
    ("c_mktsegment", "c_mktsegment"),
]
_TERM = [
    ("code", "lpad(CAST(p_partkey AS STRING), 8, '0')"),
    ("p_brand", "p_brand"),
    ("p_type", "p_type"),
]
# Times of the derived tables lie in the thirty days of the events.
_MINUTE = "1704067200000 + (o_orderkey * {} % 43200) * 60000"
# Where a site was from a time on: each order moves one.
_SITE_MOVE = [
    ("lac", "lpad(CAST(o_custkey % 26 AS STRING), 4, '0')"),
    ("valid_from", _MINUTE.format(7919)),
    ("o_orderkey", "o_orderkey"),
    ("geo_longitude", "CAST(o_custkey % 26 * 0.5 + o_orderkey % 10 * 0.01 + 115.0 AS DOUBLE)"),
    ("geo_latitude", "CAST(o_custkey % 26 * 0.25 + o_orderkey % 7 * 0.01 + 34.0 AS DOUBLE)"),
]
# A span of time for each order, some of them empty, some long.
_PERIOD = [
    ("o_orderkey", "o_orderkey"),
    ("start_ms", _MINUTE.format(104729)),
    (
        "end_ms",
        _MINUTE.format(104729) + " + CASE WHEN o_orderkey % 1000 = 0 THEN 172800000"
        " ELSE o_custkey % 30 * 60000 END",
    ),
]
# The part of the events that a row arrives with: thirds of the thirty days, and some rows late.
PART = "least(2, CAST(floor((ts_ms - 1704067200000) / 864000000) AS INT))"
LATE_PART = f"CASE WHEN event_id % 37 = 0 THEN least(2, {PART} + 1) ELSE {PART} END"
_LINE = [
    "event_id",
    "lac",
    "ci",
    "imsi",
    "event_type",
]
AREAS = ["R0", "R1", "R2", "R3", "R4"]


def _select(pairs) -> str:
    return ", ".join(e if e == n else f"{e} AS {n}" for n, e in pairs)


def _exprs(pairs) -> list[str]:
    return [f"{e} AS {n}" for n, e in pairs]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    prepare(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def as_signals(events: DataFrame) -> DataFrame:
    timed = events.withColumns(
        {
            "ts_ms": F.unix_millis(F.col("ts").cast("timestamp")),
            "k": F.get_json_object("props", "$.k").cast("int"),
        }
    )
    return timed.selectExpr(*_exprs(_SIGNAL)).withColumn("callingimei", F.col("imei"))


def signals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return as_signals(table(spark, sf_dir, "events"))


def arrivals(spark: SparkSession, sf_dir: str) -> list[DataFrame]:
    """All events in three stretches of time of about equal size, as a stream gets them."""
    events = table(spark, sf_dir, "events")
    ms = F.unix_millis(F.col("ts").cast("timestamp"))
    cuts = events.agg(F.percentile_approx(ms, [1 / 3, 2 / 3])).first()[0]
    if not cuts:
        return [events]
    place = F.when(ms <= cuts[0], 0).when(ms <= cuts[1], 1).otherwise(2)
    return [events.filter(place == i) for i in range(3)]


def sites(spark: SparkSession, sf_dir: str) -> DataFrame:
    nation = table(spark, sf_dir, "nation")
    return nation.selectExpr(*_exprs(_SITE))


def users(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "customer").selectExpr(*_exprs(_USER))


def terminals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").selectExpr(*_exprs(_TERM))


def site_moves(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").selectExpr(*_exprs(_SITE_MOVE))


def periods(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").selectExpr(*_exprs(_PERIOD))


def lines_of(rows: DataFrame, columns=_LINE, delim: str = ",") -> DataFrame:
    """Raw lines; some lack the last field, some have it empty."""
    last = (
        F.when(F.col("event_id") % 89 == 0, F.lit(""))
        .when(F.col("event_id") % 97 == 0, F.lit(None).cast("string"))
        .otherwise(F.col(columns[-1]))
    )
    # concat_ws leaves out a null, which cuts the field off.
    return rows.select(
        F.concat_ws(delim, *[F.col(c).cast("string") for c in columns[:-1]], last).alias("value")
    )


# The same views as DuckDB common table expressions.
SIGNALS_SQL = (
    "signals AS (SELECT "
    + _select(_SIGNAL)
    + ", "
    + dict(_SIGNAL)["imei"]
    + " AS callingimei FROM (SELECT *, epoch_us(ts) // 1000 AS ts_ms,"
    " CAST(json_extract_string(props, '$.k') AS INT) AS k FROM events))"
)
SITES_SQL = f"sites AS (SELECT {_select(_SITE)} FROM nation)"
USERS_SQL = f"users AS (SELECT {_select(_USER)} FROM customer)"
TERMINALS_SQL = f"terminals AS (SELECT {_select(_TERM)} FROM part)"

SITE_MOVES_SQL = f"site_moves AS (SELECT {_select(_SITE_MOVE)} FROM orders)"
PERIODS_SQL = f"periods AS (SELECT {_select(_PERIOD)} FROM orders)"


def lines_sql(columns=_LINE) -> str:
    head = ", ".join(f"CAST({c} AS STRING)" for c in columns[:-1])
    return (
        f"lines AS (SELECT concat_ws(',', {head}, CASE WHEN event_id % 89 = 0 THEN ''"
        f" WHEN event_id % 97 = 0 THEN NULL ELSE {columns[-1]} END) AS value FROM signals)"
    )
