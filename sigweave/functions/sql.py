"""The scalar functions for use in expression texts.

They are SQL functions, which Spark replaces by their bodies when it analyses a query, so
they cost the same as the expressions themselves. Names of built-in functions are left
alone: ``hex_code`` and ``parse_time`` stand in for one-argument ``conv`` and for the
parsing two-argument ``from_unixtime``, ``now_ms`` for ``unix_timestamp`` in milliseconds.
"""

from __future__ import annotations

from pyspark.sql import SparkSession

from sigweave.functions.codes import DEVICE_CODE_LENGTH, HEX_WIDTH, UNKNOWN_ID
from sigweave.functions.geo import EARTH_RADIUS_KM
from sigweave.functions.times import DATE_PRINT_FORMAT

_HEX = "hex(CAST(try_cast(n AS INT) AS BIGINT) & 4294967295)"
_HEX_BODY = (
    f"CASE WHEN length({_HEX}) < {HEX_WIDTH} THEN lpad({_HEX}, {HEX_WIDTH}, '0')"
    f" ELSE {_HEX} END"
)
_HAVERSINE = (
    "pow(sin((radians(lat1) - radians(lat2)) / 2), 2) + cos(radians(lat1))"
    " * cos(radians(lat2)) * pow(sin((radians(lon1) - radians(lon2)) / 2), 2)"
)


def _bodies(now: int | None) -> dict[str, tuple[str, str, str]]:
    """name -> (parameters, result type, body)."""
    clock = (
        "unix_millis(current_timestamp())" if now is None else f"CAST({int(now)} AS BIGINT)"
    )
    valid = f"id <> '{UNKNOWN_ID}'"
    return {
        "hex_code": ("n STRING", "STRING", _HEX_BODY),
        "convertHex": ("n STRING", "STRING", _HEX_BODY),
        "parse_time": (
            "t STRING, fmt STRING",
            "STRING",
            f"date_format(try_to_timestamp(t, fmt), '{DATE_PRINT_FORMAT}')",
        ),
        "now_ms": ("", "BIGINT", clock),
        "currenttimesub": ("ms BIGINT", "BIGINT", f"{clock} - ms"),
        "currenttimeadd": ("ms BIGINT", "BIGINT", f"{clock} + ms"),
        "text_to_ms": (
            "t STRING, fmt STRING",
            "BIGINT",
            "unix_millis(try_to_timestamp(t, fmt))",
        ),
        "ms_to_text": (
            "ms BIGINT, fmt STRING",
            "STRING",
            "date_format(timestamp_millis(ms), fmt)",
        ),
        "great_circle_km": (
            "lat1 DOUBLE, lon1 DOUBLE, lat2 DOUBLE, lon2 DOUBLE",
            "DOUBLE",
            f"nanvl(asin(sqrt({_HAVERSINE})), pi() / 2) * (2 * {EARTH_RADIUS_KM}D)",
        ),
        "clean_identity": (
            "id STRING",
            "STRING",
            f"CASE WHEN length(id) >= 1 AND {valid} THEN id END",
        ),
        "device_code": (
            "id STRING",
            "STRING",
            f"CASE WHEN length(id) >= {DEVICE_CODE_LENGTH} AND {valid}"
            f" THEN substring(id, 1, {DEVICE_CODE_LENGTH}) END",
        ),
    }


def register_functions(spark: SparkSession, now: int | None = None) -> list[str]:
    """Makes the functions known to the session; ``now`` fixes their clock (epoch ms)."""
    bodies = _bodies(now)
    for name, (parameters, result, body) in bodies.items():
        spark.sql(
            f"CREATE OR REPLACE TEMPORARY FUNCTION {name}({parameters})"
            f" RETURNS {result} RETURN {body}"
        )
    return list(bodies)
