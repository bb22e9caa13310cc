import datetime

import pytest
from pyspark.sql import Observation
from pyspark.sql import types as T

from sigweave.operators import parse, project


def _lines(spark, *lines):
    return spark.createDataFrame([(x,) for x in lines], "value string")


def test_arity(spark):
    rows = parse.parse_delimited(
        _lines(spark, "a,b,c", "a,b", "a,b,", ",,", "a,b,c,d", "", None), ["x", "y", "z"]
    )
    assert [tuple(r) for r in rows.collect()] == [
        ("a", "b", "c"),
        ("a", "b", ""),
        ("", "", ""),
    ]


def test_delimiters(spark):
    for delim in ("|", "||", "^A", "."):
        line = delim.join(["a", "b", ""])
        rows = parse.parse_delimited(_lines(spark, line), ["x", "y", "z"], delim)
        assert rows.first()[:] == ("a", "b", "")
    rows = parse.parse_delimited(_lines(spark, "a  b c"), ["x", "y", "z"], " +", regex=True)
    assert rows.first()[:] == ("a", "b", "c")


def test_counts(spark):
    seen = Observation("seen")
    rows = parse.parse_delimited(_lines(spark, "a,b", "a", None), ["x", "y"], observe=seen)
    assert rows.count() == 1
    assert seen.get == {"lines": 3, "rejected": 2}


def test_split_is_planned_once(spark):
    rows = parse.parse_delimited(_lines(spark, "a,b"), ["x", "y"]).filter("x <> '' AND y <> ''")
    plan = rows._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("split(") == 1


FIELDS = [
    {"pname": "b", "ptype": "Byte"},
    {"pname": "i", "ptype": "INT"},
    {"pname": "l", "ptype": "Long"},
    {"pname": "d", "ptype": "Double"},
    {"pname": "o", "ptype": "boolean"},
    {"pname": "y", "ptype": "Array[Byte]"},
    {"pname": "t", "ptype": "java.sql.Timestamp"},
    {"pname": "a", "ptype": "java.sql.Date"},
    {"pname": "s", "ptype": "String"},
]


def test_typed(spark):
    line = "7,8,9,1.5,true,xyz,2024-01-02 03:04:05,2024-01-02,t"
    names = [f["pname"] for f in FIELDS]
    rows = parse.cast_fields(parse.parse_delimited(_lines(spark, line), names), FIELDS)
    assert rows.schema == parse.schema_of(FIELDS, typed=True)
    found = rows.first().asDict()
    assert found["b"] == 7 and found["d"] == 1.5 and found["o"] is True
    assert bytes(found["y"]) == b"xyz"
    assert found["a"] == datetime.date(2024, 1, 2)
    bad = ",".join(["?"] * len(names))
    rows = parse.cast_fields(parse.parse_delimited(_lines(spark, bad), names), FIELDS)
    assert {k for k, v in rows.first().asDict().items() if v is not None} == {"y", "s"}


def test_type_names():
    assert parse.data_type("Integer") == T.IntegerType()
    with pytest.raises(ValueError):
        parse.data_type("decimal")
    assert parse.data_type("decimal", unknown_as_string=True) == T.StringType()


def test_fields_from_json():
    text = '{"fields":[{"pname":"a","ptype":"Int"},{},{"pname":"b"}],"other":1}'
    fields = parse.fields_from_json(text)
    assert fields == [{"pname": "a", "ptype": "Int"}, {"pname": "b"}]
    assert parse.schema_of(fields).simpleString() == "struct<a:string,b:string>"


def test_derived_columns_and_filter(spark):
    df = spark.createDataFrame([("a", 1), ("b", 2), ("c", None)], "s string, n int")
    derived = [("up", "upper(s)"), ("twice", "n * 2")]
    for condition, left in [
        ("twice > 2", ["b"]),
        ("up IN ('A', 'C') AND n IS NULL", ["c"]),
        ("n = 1", ["a"]),
        ("  ", ["a", "b", "c"]),
        (None, ["a", "b", "c"]),
    ]:
        found = parse.derive_and_filter(df, derived, condition)
        assert found.columns == ["s", "n", "up", "twice"]
        assert [r.s for r in found.collect()] == left
        assert all(r.up == r.s.upper() for r in found.collect())
        same = parse.filter_rows(parse.derive(df, derived), condition)
        assert same.collect() == found.collect()


def test_derived_column_replaces_a_base_column(spark):
    df = spark.createDataFrame([("a", "1"), ("b", "2")], "s string, n string")
    found = parse.derive_and_filter(df, [("s", "upper(s)"), ("m", "concat(s, n)")], "s = 'B'")
    assert found.columns == ["s", "n", "m"]
    assert [tuple(r) for r in found.collect()] == [("B", "2", "b2")]


def test_filter_on_a_derived_column_computes_it_once(spark):
    df = spark.createDataFrame([("20240101", "x")], "t string, s string")
    found = parse.derive_and_filter(
        df, [("ms", "unix_millis(try_to_timestamp(t, 'yyyyMMdd'))")], "ms IS NOT NULL AND s = 'x'"
    )
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("gettimestamp") == 1


def test_projection_order():
    found = project.output_columns(
        ["a", ("concat(a, b)", "ab"), "a"], ["k", "a"], [("'x'", "kind"), ("'x'", "kind")]
    )
    assert found == [("a", "a"), ("concat(a, b)", "ab"), ("k", "k"), ("'x'", "kind")]
