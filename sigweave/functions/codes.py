"""Codes, identities and keys (F1, F2, F7, F11, F12, and the key hash of O4)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The id that stands for "unknown", and the length of a device type code.
UNKNOWN_ID = "000000000000000"
DEVICE_CODE_LENGTH = 8
HEX_WIDTH = 4


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def hex_code(c: Column | str) -> Column:
    """Upper-case hex of a 32-bit integer given as text, zero-padded to four digits.

    Longer codes are kept whole, negative numbers show their 32-bit two's complement,
    and text that is not an integer gives null.
    """
    number = _col(c).try_cast("int").cast("long")
    digits = F.hex(number.bitwiseAND(F.lit(0xFFFFFFFF)))
    return F.when(
        F.length(digits) < HEX_WIDTH, F.lpad(digits, HEX_WIDTH, "0")
    ).otherwise(digits)


def text_concat(left: Column | str, right: Column | str) -> Column:
    return F.concat(_col(left).cast("string"), _col(right).cast("string"))


def composite_key(*cols: Column | str, sep: str = ",") -> Column:
    """Key text of several columns; a null part keeps its place as an empty text."""
    return F.concat_ws(
        sep, *[F.coalesce(_col(c).cast("string"), F.lit("")) for c in cols]
    )


def clean_identity(c: Column | str, min_length: int = 1) -> Column:
    """The id, or null if it is missing, too short or the unknown id."""
    value = _col(c)
    return F.when((F.length(value) >= min_length) & (value != UNKNOWN_ID), value)


def device_code(c: Column | str) -> Column:
    """Device type code of a valid device id, else null."""
    return F.substring(clean_identity(c, DEVICE_CODE_LENGTH), 1, DEVICE_CODE_LENGTH)


def java_string_hash(c: Column | str) -> Column:
    """The JVM's ``String.hashCode`` as a signed 32-bit number held in a long.

    ``sum(char * 31^(n-1-i))`` modulo 2^32; exact for text of the basic plane.
    """
    characters = F.filter(F.split(_col(c), ""), lambda ch: ch != "")
    unsigned = F.aggregate(
        characters,
        F.lit(0).cast("long"),
        lambda acc, ch: F.pmod(acc * 31 + F.ascii(ch).cast("long"), F.lit(1 << 32)),
    )
    return F.when(unsigned >= (1 << 31), unsigned - (1 << 32)).otherwise(unsigned)
