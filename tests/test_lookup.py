import pytest
from pyspark.sql import functions as F

from sigweave.operators import lookup
from tests.conftest import rows_of

UNKNOWN = "000000000000000"


@pytest.fixture(params=["broadcast", "shuffle"])
def join_kind(request, spark):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    if request.param == "shuffle":
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield request.param
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


@pytest.fixture(scope="module")
def users(spark):
    return spark.createDataFrame(
        [("u1", "Ann", "x"), ("u2", "Bob", None), ("u3", "Cy", "z")],
        "imsi string, name string, grade string",
    )


@pytest.mark.parametrize(
    "own, calling, called, plain, called_name, calling_name",
    [
        ("u1", "u1", "u2", "Ann", "Bob", ""),  # own user calls
        ("u1", "u2", "u1", "Ann", "", "Bob"),  # own user is called
        ("u1", "u2", "u3", "", "Cy", "Bob"),  # own user is neither
        ("u1", "u1", "u1", "Ann", "", ""),  # one distinct party
        ("u1", "u2", "u2", "", "", ""),  # one party, not the own user
        ("u1", "u1", UNKNOWN, "Ann", "", ""),
        ("u1", "u2", UNKNOWN, "", "", ""),
        ("u1", "", "u1", "Ann", "", ""),
        ("u1", None, "u2", "", "", ""),
        ("u1", None, UNKNOWN, "", "", ""),  # no party
        ("u9", "u9", "u2", "", "Bob", ""),  # own user unknown to the dimension
        ("u1", "u1", "u9", "Ann", "", ""),  # other party unknown
        (None, "u1", "u2", "", "Bob", "Ann"),
    ],
)
def test_party(spark, users, own, calling, called, plain, called_name, calling_name):
    df = spark.createDataFrame(
        [(own, calling, called)], "imsi string, callingimsi string, calledimsi string"
    )
    row = lookup.party_labels(df, users, ["name", "grade"]).first()
    assert (row["name"], row["called_name"], row["calling_name"]) == (
        plain,
        called_name,
        calling_name,
    )
    assert None not in (row["grade"], row["called_grade"], row["calling_grade"])


def test_terminal(spark):
    terminals = spark.createDataFrame(
        [("11111111", "P1"), ("22222222", "P2")], "code string, brand string"
    )
    one, two = "111111110000001", "222222220000002"
    data = [
        (1, one, one, two, "P1", "P2", ""),
        (2, one, two, one, "P1", "", "P2"),
        (3, "123", one, two, "", "", ""),  # own id too short
        (4, one, one, "12345", "P1", "", ""),
        (5, one, UNKNOWN, "11111111", "P1", "", ""),  # code alone is long enough
        (6, None, one, two, "", "", ""),
        (7, one, "111111119999999", one, "P1", "", ""),  # two devices of one type
    ]
    df = spark.createDataFrame(
        [d[:4] for d in data], "id int, imei string, callingimei string, calledimei string"
    )
    found = lookup.terminal_labels(df, terminals, ["brand"])
    assert rows_of(found, "id", "brand", "called_brand", "calling_brand") == [
        (d[0], *d[4:]) for d in data
    ]


def test_areas(spark, join_kind):
    sites = spark.createDataFrame(
        [("1", "A, B ,C", "n1"), ("2", "", None), ("3", None, "n3")],
        "lac string, areas string, name string",
    )
    df = spark.createDataFrame([("1", 1), ("2", 2), ("3", 3), ("4", 4), (None, 5)], "lac string, id int")
    found = lookup.area_labels(
        df, sites, [("lac", "lac")], areas=["B", "D"], attributes=["name", "areas"]
    )
    assert found.columns == [
        "lac",
        "id",
        "area_B",
        "area_D",
        "areainfo_name",
        "areainfo_areas",
    ]
    assert rows_of(found, "id", "area_B", "area_D", "areainfo_name", "areainfo_areas") == [
        (1, "true", "", "n1", "A, B ,C"),
        (2, "", "", "", ""),
        (3, "", "", "n3", ""),
        (4, "", "", "", ""),
        (5, "", "", "", ""),
    ]


def test_composite_site_key(spark):
    sites = spark.createDataFrame(
        [("1", "7", 5.0, 6.0)], "lac string, ci string, geo_longitude double, geo_latitude double"
    )
    df = spark.createDataFrame([("1", "7"), ("1", "8"), (None, "7")], "lac string, ci string")
    found = lookup.site_position(df, sites, [("lac", "lac"), ("ci", "ci")])
    assert rows_of(found, "lac", "ci", "geo_longitude", "geo_latitude") == [
        ("1", "7", 5.0, 6.0),
        ("1", "8", 0.0, 0.0),
        (None, "7", 0.0, 0.0),
    ]


def test_row_value_wins(spark):
    sites = spark.createDataFrame([("1", "A")], "lac string, areas string")
    df = spark.createDataFrame([("1", "mine")], "lac string, area_A string")
    found = lookup.area_labels(df, sites, [("lac", "lac")], areas=["A", "B"])
    assert found.columns == ["lac", "area_A", "area_B"]
    assert found.first()[:] == ("1", "mine", "")


def test_rows_without_key_are_kept(spark, users, join_kind):
    """A third of the rows has no key, a third has the same one."""
    df = spark.range(900).select(
        "id",
        F.when(F.col("id") % 3 == 0, "u1").when(F.col("id") % 3 == 1, "u2").alias("who"),
    )
    found = lookup.lookup(df, users, [("who", "imsi")], ["name"])
    plan = found._jdf.queryExecution().executedPlan().toString()
    if join_kind == "shuffle":
        assert "BroadcastHashJoin" not in plan
        assert "SortMergeJoin [_k0" in plan and "_k1" not in plan
    counts = {r.name: r["count"] for r in found.groupBy("_dim.name").count().collect()}
    assert counts == {"Ann": 300, "Bob": 300, None: 300}


def test_lookup_reads_the_needed_columns_only(spark, users, tmp_path):
    path = str(tmp_path / "facts")
    spark.range(5).selectExpr("id", "'u1' AS who", "'x' AS wide").write.parquet(path)
    found = lookup.lookup(spark.read.parquet(path), users, [("who", "imsi")], ["name"])
    plan = found.select("id", "_dim.name")._jdf.queryExecution().executedPlan().toString()
    assert "wide" not in plan


def test_hot_key_is_split_at_run_time(spark, users):
    """Adaptive execution splits the shuffled partition of a hot key."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20000",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20000",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
        "spark.sql.shuffle.partitions": "16",
    }
    before = {k: spark.conf.get(k) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        df = spark.range(0, 60_000, 1, 8).select(
            "id",
            F.when(F.col("id") % 2 == 0, "u1")
            .otherwise(F.concat(F.lit("v"), F.col("id").cast("string")))
            .alias("who"),
        )
        found = lookup.lookup(df, users, [("who", "imsi")], ["name"])
        counts = found.groupBy(F.col("_dim.name")).count()
        assert {r.name: r["count"] for r in counts.collect()} == {"Ann": 30_000, None: 30_000}
        assert "skew=true" in counts._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
