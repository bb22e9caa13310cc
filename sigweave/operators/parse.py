"""Delimited text to columns, typed casts, derived columns and the row filter."""

from __future__ import annotations

import json
import re
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Configuration type name (any letter case) -> Spark type.
TYPE_NAMES: dict[str, T.DataType] = {
    "byte": T.ByteType(),
    "short": T.ShortType(),
    "int": T.IntegerType(),
    "integer": T.IntegerType(),
    "long": T.LongType(),
    "float": T.FloatType(),
    "double": T.DoubleType(),
    "string": T.StringType(),
    "array[byte]": T.BinaryType(),
    "boolean": T.BooleanType(),
    "java.sql.timestamp": T.TimestampType(),
    "java.sql.date": T.DateType(),
}

Field = str | Mapping[str, str]


def field_name(field: Field) -> str:
    return field if isinstance(field, str) else field["pname"]


def data_type(name: str, unknown_as_string: bool = False) -> T.DataType:
    found = TYPE_NAMES.get(name.lower())
    if found is None:
        if unknown_as_string:
            return T.StringType()
        raise ValueError(f"unknown type name {name!r}")
    return found


def schema_of(fields: Sequence[Field], typed: bool = False) -> T.StructType:
    """Schema of a field list: all text by default, the declared types if ``typed``."""
    return T.StructType(
        [
            T.StructField(
                field_name(f),
                data_type(f.get("ptype", "string"))
                if typed and not isinstance(f, str)
                else T.StringType(),
                True,
            )
            for f in fields
        ]
    )


def fields_from_json(properties: str, member: str | None = "fields") -> list[dict[str, str]]:
    """Field list of a JSON property text, ``[{"pname": ..., "ptype": ..., "pvalue": ...}]``."""
    value = json.loads(properties)
    if member is not None:
        value = value.get(member, [])
    return [{k: str(v) for k, v in item.items()} for item in value if item]


def parse_delimited(
    df: DataFrame,
    fields: Sequence[Field],
    delim: str = ",",
    *,
    column: str = "value",
    keep: Sequence[str] = (),
    regex: bool = False,
    observe: str | Observation | None = None,
) -> DataFrame:
    """Splits text lines into one text column per field.

    Empty fields count, also at the end of the line; a line with any other number of
    fields is dropped. ``keep`` names input columns to carry along. ``observe`` names an
    observation with the counts of ``lines`` read and ``rejected``.
    """
    names = [field_name(f) for f in fields]
    parts = F.split(F.col(column), delim if regex else re.escape(delim), -1)
    if observe:
        df = df.observe(
            observe,
            F.count(F.lit(1)).alias("lines"),
            F.count_if(~F.coalesce(F.size(parts) == len(names), F.lit(False))).alias(
                "rejected"
            ),
        )
    # As a generator the split is done once, and no later filter is moved below it.
    fitting = F.filter(F.array(parts), lambda p: F.size(p) == len(names))
    return df.select(*keep, F.explode(fitting).alias("_parts")).select(
        *keep, *[F.col("_parts")[i].alias(name) for i, name in enumerate(names)]
    )


def cast_fields(
    df: DataFrame, fields: Sequence[Field], unknown_as_string: bool = False
) -> DataFrame:
    """Casts every field to its declared ``ptype``; text that does not fit becomes null."""
    typed = {
        f["pname"]: data_type(f.get("ptype", "string"), unknown_as_string)
        for f in fields
        if not isinstance(f, str)
    }

    def cast(name: str) -> Column:
        wanted = typed.get(name)
        if wanted is None or df.schema[name].dataType == wanted:
            return F.col(name)
        if isinstance(wanted, T.BinaryType):
            return F.col(name).cast(wanted).alias(name)
        return F.col(name).try_cast(wanted).alias(name)

    return df.select(*[cast(c) for c in df.columns])


def derive(df: DataFrame, derived: Sequence[tuple[str, str]]) -> DataFrame:
    """Adds ``(name, expression)`` columns; every expression sees the base columns only.

    A derived column with the name of a base column takes its place.
    """
    texts = dict(derived)
    return df.select(
        *[F.expr(texts.pop(c)).alias(c) if c in texts else F.col(c) for c in df.columns],
        *[F.expr(e).alias(name) for name, e in texts.items()],
    )


def derive_and_filter(
    df: DataFrame, derived: Sequence[tuple[str, str]], condition: str | None
) -> DataFrame:
    """``derive``, then ``filter_rows``.

    A filter on a derived column is moved below the projection, which would compute the
    column for the filter and again for the result. Such columns go through a generator
    that computes them once; the others are computed for the remaining rows only.
    """
    text = (condition or "").lower()
    words = {*re.findall(r"\w+", text), *re.findall(r"`([^`]+)`", text)}
    tested = [(name, e) for name, e in derived if name.lower() in words]
    if any(name in df.columns for name, _ in derived):
        return filter_rows(derive(df, derived), condition)
    if not tested:
        return derive(filter_rows(df, condition), derived)
    once = F.explode(F.array(F.struct(*[F.expr(e).alias(name) for name, e in tested])))
    kept = filter_rows(
        df.select("*", once.alias("_once")).select(
            *df.columns, *[F.col("_once")[name].alias(name) for name, _ in tested]
        ),
        condition,
    )
    ready = {name for name, _ in tested}
    return kept.select(
        *df.columns,
        *[F.col(n) if n in ready else F.expr(e).alias(n) for n, e in derived],
    )


def filter_rows(df: DataFrame, condition: str | Column | None) -> DataFrame:
    """Keeps rows that satisfy ``condition``; a blank one keeps all."""
    if condition is None or (isinstance(condition, str) and not condition.strip()):
        return df
    return df.filter(condition)
