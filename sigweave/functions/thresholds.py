"""Threshold crossing of a growing duration."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

NO_LIMIT = "0"


def crossed_limit(
    old: Column,
    new: Column,
    limits: Sequence[int],
    *,
    match_max: bool = True,
    output_threshold: bool = True,
    strict: bool = False,
) -> Column:
    """The limit passed when a duration grows from ``old`` to ``new``, as text.

    A limit counts when ``old <= limit <= new``; ``strict`` asks for ``old < limit``, so
    that a duration resting exactly on a limit is reported once. With several limits
    ``match_max`` picks the greatest, else the least. ``output_threshold=False`` reports
    the true duration instead of the limit. ``"0"`` if none is passed.
    """
    if not limits:
        raise ValueError("at least one limit is needed")
    ordered = sorted(int(limit) for limit in limits)
    # A CASE chain in the preferred order: the first limit passed is the answer. It stays
    # inside whole-stage code generation, which array lambdas do not.
    preferred = reversed(ordered) if match_max else ordered
    result = None
    for limit in preferred:
        value = F.lit(limit).cast("long")
        passed = ((old < value) if strict else (old <= value)) & (new >= value)
        shown = F.lit(str(limit)) if output_threshold else new.cast("long").cast("string")
        result = F.when(passed, shown) if result is None else result.when(passed, shown)
    return result.otherwise(NO_LIMIT)
