"""Column functions; every one of them stays inside the JVM."""

from sigweave.functions.codes import (
    clean_identity,
    composite_key,
    device_code,
    hex_code,
    java_string_hash,
    text_concat,
)
from sigweave.functions.geo import EARTH_RADIUS_KM, great_circle_km, whole_km
from sigweave.functions.jsons import (
    explode_json_maps,
    json_to_columns,
    json_to_delimited,
    json_to_map,
    row_to_json,
)
from sigweave.functions.thresholds import crossed_limit
from sigweave.functions.times import (
    MESSAGE_TIME_FORMAT,
    ms_to_text,
    now_ms,
    now_plus,
    now_minus,
    parse_time,
    text_to_ms,
)

__all__ = [
    "EARTH_RADIUS_KM",
    "MESSAGE_TIME_FORMAT",
    "clean_identity",
    "composite_key",
    "crossed_limit",
    "device_code",
    "explode_json_maps",
    "great_circle_km",
    "hex_code",
    "java_string_hash",
    "json_to_columns",
    "json_to_delimited",
    "json_to_map",
    "ms_to_text",
    "now_minus",
    "now_ms",
    "now_plus",
    "parse_time",
    "row_to_json",
    "text_concat",
    "text_to_ms",
    "whole_km",
]
