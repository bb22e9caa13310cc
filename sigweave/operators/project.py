"""Event filter and projection."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sigweave.operators.parse import filter_rows

Selected = str | tuple[str, str]


def output_columns(
    select: Sequence[Selected],
    keys: Sequence[str] = (),
    ext: Sequence[tuple[str, str]] = (),
) -> list[tuple[str, str]]:
    """Ordered ``(expression, name)`` pairs: the selection, missing keys, then ``ext``."""
    pairs = [(item, item) if isinstance(item, str) else item for item in select]
    names = {name for _, name in pairs}
    pairs += [(k, k) for k in keys if k not in names]
    return list(dict.fromkeys([*pairs, *ext]))


def project_event(
    df: DataFrame,
    select: Sequence[Selected],
    *,
    keys: Sequence[str] = (),
    ext: Sequence[tuple[str, str]] = (),
) -> DataFrame:
    return df.select(
        *[F.expr(e).alias(name) for e, name in output_columns(select, keys, ext)]
    )


def select_event(
    df: DataFrame,
    condition: str | None,
    select: Sequence[Selected],
    *,
    keys: Sequence[str] = (),
    ext: Sequence[tuple[str, str]] = (),
) -> DataFrame:
    """Rows that satisfy the event's condition, reduced to its output columns."""
    return project_event(filter_rows(df, condition), select, keys=keys, ext=ext)
