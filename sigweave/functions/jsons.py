"""Rows to and from JSON text."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def row_to_json(*cols: Column | str) -> Column:
    """One JSON object of the given columns; null members are left out."""
    return F.to_json(F.struct(*cols))


def json_to_map(c: Column | str) -> Column:
    return F.from_json(_col(c), "map<string,string>")


def json_to_columns(df: DataFrame, c: str, schema: StructType | str) -> DataFrame:
    """Adds the members named by ``schema`` as columns. The schema is given, never guessed."""
    parsed = df.withColumn("_parsed", F.from_json(F.col(c), schema))
    return parsed.select(*df.columns, "_parsed.*")


def json_to_delimited(
    c: Column | str, names: Sequence[str], sep: str = ",", skip_nulls: bool = False
) -> Column:
    """The named members joined by ``sep``.

    A missing member keeps its position as an empty text; ``skip_nulls=True`` leaves it
    out, which moves the later members to the left.
    """
    parsed = F.from_json(_col(c), ", ".join(f"`{n}` string" for n in names))

    def joined(members: Column) -> Column:
        texts = [members.getField(n) for n in names]
        if not skip_nulls:
            texts = [F.coalesce(text, F.lit("")) for text in texts]
        return F.concat_ws(sep, *texts)

    # Inside a lambda the object is parsed once, not once per member.
    return F.get(F.transform(F.array(parsed), joined), F.lit(0))


def explode_json_maps(
    df: DataFrame, c: str, names: Sequence[str], member: str | None = None
) -> DataFrame:
    """One row per object of a JSON array, with ``names`` as columns.

    ``member`` names the array inside an enclosing object.
    """
    item = "struct<" + ", ".join(f"`{n}`:string" for n in names) + ">"
    if member is None:
        items = F.from_json(F.col(c), f"array<{item}>")
    else:
        items = F.from_json(F.col(c), f"struct<`{member}`:array<{item}>>").getField(member)
    rows = df.withColumn("_item", F.explode(items))
    return rows.select(*df.columns, *[F.col("_item")[n].alias(n) for n in names])
