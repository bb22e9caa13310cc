import pytest
from pyspark.sql import functions as F

from sigweave import functions as sf
from sigweave.functions.sql import register_functions


def _one(spark, *columns):
    return tuple(spark.range(1).select(*columns).first())


@pytest.mark.parametrize(
    "number, code",
    [
        ("0", "0000"),
        ("255", "00FF"),
        ("65535", "FFFF"),
        ("70000", "11170"),
        ("-1", "FFFFFFFF"),
        ("x", None),
        (None, None),
        ("99999999999", None),
    ],
)
def test_hex_code(spark, number, code):
    register_functions(spark)
    df = spark.createDataFrame([(number,)], "n string")
    assert df.select(sf.hex_code("n")).first()[0] == code
    assert df.selectExpr("hex_code(n)", "convertHex(n)").first()[:] == (code, code)


def test_times(spark):
    stamp = F.lit("20240229 13:05:06.789")
    fmt = sf.MESSAGE_TIME_FORMAT
    found = _one(
        spark,
        sf.text_to_ms(stamp, fmt),
        sf.ms_to_text(sf.text_to_ms(stamp, fmt), fmt),
        sf.parse_time(stamp, fmt),
        sf.text_to_ms(F.lit("no time")),
        sf.now_minus(5, now=100),
        sf.now_plus(5, now=100),
    )
    assert found == (
        1709211906789,
        "20240229 13:05:06.789",
        "Thu Feb 29 13:05:06 UTC 2024",
        None,
        95,
        105,
    )


def test_clock_functions_read_the_clock(spark):
    import time

    now = _one(spark, sf.now_ms())[0]
    assert abs(now - time.time() * 1000) < 600_000


def test_distance(spark):
    def km(a, b, c, d):
        lits = [F.lit(x).cast("double") for x in (a, b, c, d)]
        distance = sf.great_circle_km(*lits)
        return _one(spark, distance, sf.whole_km(distance))

    assert km(10, 20, 10, 20) == (0.0, 0.0)
    exact, whole = km(36.65, 117.12, 39.9, 116.4)
    assert whole == int(exact) and 360 < exact < 370
    assert km(0, 0, 0, 180)[1] == 20037.0
    assert km(0, None, 0, 1) == (None, None)


def test_identities(spark):
    df = spark.createDataFrame(
        [("123456789",), ("1234567",), ("000000000000000",), ("",), (None,)], "id string"
    )
    found = df.select(sf.clean_identity("id"), sf.device_code("id")).collect()
    assert [tuple(r) for r in found] == [
        ("123456789", "12345678"),
        ("1234567", None),
        (None, None),
        (None, None),
        (None, None),
    ]


@pytest.mark.parametrize(
    "old, new, options, label",
    [
        (0, 9, {}, "0"),
        (0, 10, {}, "10"),
        (10, 12, {}, "10"),
        (10, 12, {"strict": True}, "0"),
        (5, 100, {}, "60"),
        (5, 100, {"match_max": False}, "10"),
        (5, 100, {"output_threshold": False}, "100"),
        (61, 100, {}, "0"),
        (60, 100, {}, "60"),
        (11, 29, {}, "0"),
    ],
)
def test_crossed_limit(spark, old, new, options, label):
    value = sf.crossed_limit(F.lit(old), F.lit(new), [60, 10, 30], **options)
    assert _one(spark, value) == (label,)


def test_crossed_limit_needs_limits():
    with pytest.raises(ValueError):
        sf.crossed_limit(F.lit(1), F.lit(2), [])


def _jvm_hash(text):
    value = 0
    for ch in text:
        value = (value * 31 + ord(ch)) % (1 << 32)
    return value - (1 << 32) if value >= 1 << 31 else value


def test_java_string_hash(spark):
    texts = ["", "a", "460020033977918", "héllo wörld", "x" * 50]
    df = spark.createDataFrame([(x,) for x in texts], "s string")
    found = [r[0] for r in df.select(sf.java_string_hash("s")).collect()]
    assert found == [_jvm_hash(x) for x in texts]


def test_json(spark):
    df = spark.createDataFrame(
        [('{"a":"1","b":null,"n":5}', '{"fields":[{"pname":"x","pvalue":"y"},{"pname":"z"}]}')],
        "js string, conf string",
    )
    assert df.select(sf.json_to_delimited("js", ["a", "b", "n"], ";")).first()[0] == "1;;5"
    assert (
        df.select(sf.json_to_delimited("js", ["a", "b", "n"], ";", skip_nulls=True)).first()[0]
        == "1;5"
    )
    assert df.select(sf.json_to_map("js")).first()[0] == {"a": "1", "b": None, "n": "5"}
    wide = sf.json_to_columns(df, "js", "a string, n int")
    assert wide.select("a", "n").first()[:] == ("1", 5)
    pairs = sf.explode_json_maps(df, "conf", ["pname", "pvalue"], "fields")
    assert [tuple(r)[2:] for r in pairs.collect()] == [("x", "y"), ("z", None)]
    row = spark.createDataFrame([("v", None)], "a string, b string")
    assert row.select(sf.row_to_json("a", "b")).first()[0] == '{"a":"v"}'
