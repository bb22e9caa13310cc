"""Length of stay per key and area, over rows in time order (K3).

All areas share one window per key, so any number of areas costs one shuffle and one sort.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from sigweave.functions.thresholds import crossed_limit
from sigweave.operators.lookup import add_labels
from sigweave.operators.slices import SLICE, SlicePlan, join_small, resolve

# Fixed value: a stay is broken after half an hour unless configured otherwise.
DEFAULT_TIMEOUT_MS = 30 * 60 * 1000


def location_stay(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    areas: Sequence[str],
    limits: Sequence[int],
    *,
    timeout_ms: int = DEFAULT_TIMEOUT_MS,
    match_max: bool = True,
    output_threshold: bool = True,
    strict: bool = False,
    slices: SlicePlan | str | None = None,
) -> DataFrame:
    """Labels ``stay_<A>``: the limit passed by the stay in area A, else "0".

    A row is in area A if ``area_A = 'true'``. A stay starts on the first row in the area
    and again after more than ``timeout_ms`` without one. ``limits`` are in ms.
    """
    here = {a: F.col(f"area_{a}") == "true" for a in areas}
    names = {a: str(i) for i, a in enumerate(areas)}
    rows = _marked(df, keys, order, here, names, timeout_ms, slices)
    time = F.col(order[0])
    labels = []
    for a in areas:
        n = names[a]
        last, start = F.col(f"_pt{n}"), F.col(f"_st{n}")
        continued = here[a] & (start <= last) & (time > last)
        value = crossed_limit(
            last - start,
            time - start,
            limits,
            match_max=match_max,
            output_threshold=output_threshold,
            strict=strict,
        )
        labels.append((f"stay_{a}", F.when(continued, value).otherwise("0")))
    return add_labels(rows, df, labels)


def _marked(df, keys, order, here, names, timeout_ms, slices) -> DataFrame:
    """Rows with ``_pt``, the last time in an area before the row, and ``_st``, the newest start
    of a stay there up to the row, for each area of ``here`` and its number in ``names``."""
    areas = list(here)
    time = F.col(order[0])
    plan = resolve(slices, df, keys, order)
    base = plan.tag(df) if plan.hot else df
    parts = [*keys, SLICE] if plan.hot else list(keys)
    so_far = Window.partitionBy(*parts).orderBy(*order).rowsBetween(
        Window.unboundedPreceding, Window.currentRow
    )
    earlier = Window.partitionBy(*parts).orderBy(*order).rowsBetween(
        Window.unboundedPreceding, -1
    )

    # Times grow along the window, so a running maximum is the latest time in the area.
    rows = base.select(
        "*",
        *[F.max(F.when(here[a], time)).over(earlier).alias(f"_pt{names[a]}") for a in areas],
        *(
            [F.min(F.when(here[a], time)).over(so_far).alias(f"_ft{names[a]}") for a in areas]
            if plan.hot
            else []
        ),
    )

    def broken(a: str):
        return here[a] & (time - F.col(f"_pt{names[a]}") > timeout_ms)

    def opening(a: str):
        return here[a] & F.col(f"_pt{names[a]}").isNull()

    # In a slice the first row in an area need not open a stay; the carried state decides.
    rows = rows.select(
        "*",
        *[
            F.max(F.when(broken(a) if plan.hot else (broken(a) | opening(a)), time))
            .over(so_far)
            .alias(f"_st{names[a]}")
            for a in areas
        ],
    )
    if plan.hot:
        rows = _with_carry(rows, keys, areas, names, here, time, timeout_ms)
    return rows


def stay_state(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    areas: Sequence[str],
    *,
    timeout_ms: int = DEFAULT_TIMEOUT_MS,
    slices: SlicePlan | str | None = None,
) -> tuple[DataFrame, list[Column]]:
    """Rows, and aggregates by key over them that give the state after all rows of a table.

    They are ``stay_first_<A>`` and ``stay_last_<A>``: start and last time of the area's stay,
    null if it has none or if the key was in no area at all for longer than the timeout since.
    """
    here = {a: F.coalesce(F.col(f"area_{a}") == "true", F.lit(False)) for a in areas}
    anywhere = F.lit(False)
    for flag in here.values():
        anywhere = anywhere | flag
    # All areas together are one more area, whose stays tell when everything was forgotten.
    marks = {**here, None: anywhere}
    names = {a: str(i) for i, a in enumerate(marks)}
    rows = _marked(df, keys, order, marks, names, timeout_ms, slices)
    time = F.col(order[0])
    kept = F.max(f"_st{names[None]}")
    aggregates = []
    for a in areas:
        first, last = F.max(f"_st{names[a]}"), F.max(F.when(here[a], time))
        for end, value in (("first", first), ("last", last)):
            aggregates.append(F.when(last >= kept, value).alias(f"stay_{end}_{a}"))
    return rows, aggregates


def _with_carry(rows, keys, areas, names, here, time, timeout_ms) -> DataFrame:
    """Completes last time and stay start of sliced rows with the state of earlier slices."""
    summary = (
        rows.filter(F.col(SLICE).isNotNull())
        .groupBy(*keys, SLICE)
        .agg(
            *[F.min(F.when(here[a], time)).alias(f"_f{names[a]}") for a in areas],
            *[F.max(F.when(here[a], time)).alias(f"_l{names[a]}") for a in areas],
            *[F.max(f"_st{names[a]}").alias(f"_s{names[a]}") for a in areas],
        )
    )
    earlier = Window.partitionBy(*keys).orderBy(SLICE).rowsBetween(
        Window.unboundedPreceding, -1
    )
    lasts = summary.select(
        "*", *[F.max(f"_l{n}").over(earlier).alias(f"_cl{n}") for n in names.values()]
    )

    def opens(first, last):
        return last.isNull() | (first - last > timeout_ms)

    # Start of the newest stay begun in a slice; null if the slice only continues one.
    own = {
        n: F.coalesce(
            F.col(f"_s{n}"),
            F.when(opens(F.col(f"_f{n}"), F.col(f"_cl{n}")), F.col(f"_f{n}")),
        )
        for n in names.values()
    }
    carried = lasts.select(
        *keys,
        SLICE,
        *[F.col(f"_cl{n}") for n in names.values()],
        *[F.max(own[n]).over(earlier).alias(f"_cs{n}") for n in names.values()],
    )
    joined = join_small(rows, carried, [*keys, SLICE])
    completed = {}
    for n in names.values():
        first, last = F.col(f"_ft{n}"), F.col(f"_cl{n}")
        boundary = F.when(opens(first, last), first).otherwise(F.col(f"_cs{n}"))
        completed[f"_pt{n}"] = F.coalesce(F.col(f"_pt{n}"), last)
        completed[f"_st{n}"] = F.coalesce(F.col(f"_st{n}"), boundary)
    return joined.withColumns(completed)
