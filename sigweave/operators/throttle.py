"""Emission throttle per key (K4).

A row is emitted if at least ``interval`` has passed since the key's last emitted row.
Each emission depends on the one before, which no built-in expression states. Ordinary
keys are therefore decided by a vectorised pass over Arrow batches of rows that Spark has
shuffled by key and sorted by time; the pass holds one batch and one key's last emission,
never a whole group. Keys too large for one task are decided slice by slice on all
executors, see ``_throttle_hot``.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from sigweave.operators.slices import SLICE, SlicePlan, join_small, resolve, slice_of
from sigweave.session import cut_lineage

_TIME = "_throttle_time"
_INTERVAL = "_throttle_interval"
_NUMBER = "_throttle_number"
_DUE = "_throttle_due"


def emitted(
    times: np.ndarray,
    intervals: np.ndarray,
    starts: np.ndarray,
    last: int | None = None,
) -> np.ndarray:
    """Which rows of consecutive groups are emitted.

    ``times`` ascends within a group, ``starts`` marks the first row of each group except
    for a group continued from earlier rows, whose last emission is ``last``.
    """
    n = len(times)
    passed = intervals <= 0
    if n == 0 or passed.all():
        return passed
    group = np.cumsum(starts)
    base = int(times.min())
    reach = int(times.max()) - base + 1
    # Group number and time as one ascending number; a jump never leaves its group's range.
    stride = 2 * reach + 1
    place = group * stride + (times - base)
    jump = np.minimum(intervals, reach)
    following = np.searchsorted(place, place + jump, side="left")
    inside = following < n
    inside[inside] = group[following[inside]] == group[inside]

    # A group's first row is emitted, and so is every row after a gap of one interval.
    heads = starts.copy()
    heads[1:] |= ~starts[1:] & (times[1:] - times[:-1] >= intervals[1:])
    if not starts[0]:
        heads[0] = last is None or times[0] >= last + intervals[0]
        if not heads[0]:
            due = np.searchsorted(times[group == group[0]], last + intervals[0], side="left")
            if due < n and group[due] == group[0]:
                heads[due] = True
            # Gaps before the due row restart nothing: the last emission is newer.
            heads[:due][group[:due] == group[0]] = False
    mark = passed.copy()
    current = np.flatnonzero(heads & ~passed)
    while current.size:
        mark[current] = True
        current = following[current[inside[current]]]
        current = current[~mark[current]]
    return mark


def _emit_sorted(names: Sequence[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last = None
        for batch in batches:
            if batch.num_rows == 0:
                continue
            times, gaps, numbers = (
                batch.column(batch.schema.get_field_index(c)).to_numpy()
                for c in (_TIME, _INTERVAL, _NUMBER)
            )
            starts = numbers == 1
            mark = emitted(times, gaps, starts, None if starts[0] else last)
            # The last group of the batch may go on in the next batch.
            begin = int(np.flatnonzero(starts)[-1]) if starts.any() else 0
            hits = np.flatnonzero(mark[begin:])
            if hits.size:
                last = int(times[begin + hits[-1]])
            elif starts.any():
                last = None
            yield batch.filter(pa.array(mark)).select(list(names))

    return run


def _throttle_sorted(df: DataFrame, keys: Sequence[str], order: Sequence[str], out) -> DataFrame:
    # The row number brings a key's rows together and tells where a key begins. Its
    # shuffle and sort are shared with other windows of the same key upstream, and the
    # explicit sort, which states what the pass below needs, is dropped as redundant.
    window = Window.partitionBy(*keys).orderBy(*order)
    numbered = df.withColumn(_NUMBER, F.row_number().over(window))
    ordered = numbered.sortWithinPartitions(*keys, *order)
    return ordered.mapInArrow(_emit_sorted(out.names), out)


def _slice_exits(table: pa.Table) -> pa.Table:
    """For every time of one slice: when the next emission is due after the slice, if the
    row of that time is the first one emitted in it."""
    table = table.sort_by(_TIME)
    times = table.column(_TIME).to_numpy()
    gaps = table.column(_INTERVAL).to_numpy()
    ends = np.searchsorted(times, times + gaps, side="left")
    here = np.arange(len(times))
    # Following all chains at once, twice as far each time, up to their last emission.
    last = np.where(ends < len(times), ends, here)
    while True:
        further = last[last]
        if np.array_equal(further, last):
            break
        last = further
    return table.append_column(_DUE, pa.array(times[last] + gaps[last], pa.int64()))


def _throttle_hot(
    hot: DataFrame,
    plan: SlicePlan,
    keys: Sequence[str],
    order: Sequence[str],
    out,
) -> DataFrame:
    """Emitted rows of hot keys.

    Each slice is worked through for every row that may be its first emission, which tells
    when the key is due again after the slice. Most of these chains run together, so few
    distinct due times and entry rows are left. The entries really taken are found from
    the key's first row by pointer doubling: round r adds the 2^r-th successors of the
    entries known so far. A slice is entered once at most, so the entries may be broadcast
    for the last step, which emits each slice from its entry on.
    """
    keys = list(keys)
    # Only the first row of a time can be emitted.
    times = hot.groupBy(*keys, _TIME).agg(
        F.min(SLICE).alias(SLICE), F.first(_INTERVAL).alias(_INTERVAL)
    )
    schema = T.StructType([*times.schema.fields, T.StructField(_DUE, T.LongType())])
    exits = cut_lineage(times.groupBy(*keys, SLICE).applyInArrow(_slice_exits, schema))
    roots = exits.groupBy(*keys).agg(F.min(_TIME).alias("_at"))
    successors = cut_lineage(_successors(exits, plan, keys, order, hot))
    entries = (
        successors.filter(F.col("_next").isNotNull())
        .select(*keys, F.col("_next").alias("_at"))
        .unionByName(roots)
        .distinct()
    )
    homes = cut_lineage(
        _null_safe_join(
            entries,
            exits.select(*keys, SLICE, F.col(_TIME).alias("_at"), _DUE),
            [*keys, "_at"],
            "inner",
        )
    )
    pointers = cut_lineage(
        _null_safe_join(homes, successors, [*keys, _DUE], "inner")
        .filter(F.col("_next").isNotNull())
        .select(*keys, "_at", "_next")
    )
    reached = cut_lineage(roots)
    known = reached.count()
    while True:
        hops = _null_safe_join(reached, pointers, [*keys, "_at"], "inner")
        added = hops.select(*keys, F.col("_next").alias("_at"))
        reached = cut_lineage(reached.unionByName(added).distinct())
        found = reached.count()
        if found == known:
            break
        known = found
        near = pointers.select(*keys, F.col("_at").alias("_from"), F.col("_next").alias("_at"))
        pointers = cut_lineage(
            _null_safe_join(near, pointers, [*keys, "_at"], "inner").select(
                *keys, F.col("_from").alias("_at"), "_next"
            )
        )
    taken = _null_safe_join(homes, reached, [*keys, "_at"], "left_semi").select(
        *keys, SLICE, F.col("_at").alias("_entry")
    )
    entered = join_small(hot, taken, [*keys, SLICE])
    return _throttle_sorted(
        entered.filter(F.col(_TIME) >= F.col("_entry")).drop("_entry"),
        [*keys, SLICE],
        order,
        out,
    )


def _null_safe_join(left, right, cols, how) -> DataFrame:
    renamed = right.select(
        *[F.col(c).alias(f"_r_{c}") if c in cols else F.col(c) for c in right.columns]
    )
    condition = None
    for c in cols:
        equal = left[c].eqNullSafe(renamed[f"_r_{c}"])
        condition = equal if condition is None else condition & equal
    return left.join(renamed, condition, how).drop(*[f"_r_{c}" for c in cols])


def _successors(
    exits: DataFrame,
    plan: SlicePlan,
    keys: Sequence[str],
    order: Sequence[str],
    hot: DataFrame,
) -> DataFrame:
    """(key, due, _next): the key's first time at or after each due time."""
    rows = exits.select(
        *keys,
        SLICE,
        F.col(_TIME).alias("_point"),
        F.lit(0).alias("_probe"),
    )
    due_times = join_small(
        exits.select(*keys, _DUE).distinct(), plan.table, plan.keys
    )
    # A probe stands before all rows of its time.
    place = F.struct(
        *[
            (F.col(_DUE) if i == 0 else F.lit(None)).cast(hot.schema[c].dataType).alias(c)
            for i, c in enumerate(order)
        ]
    )
    probes = due_times.select(
        *keys,
        slice_of(place).alias(SLICE),
        F.col(_DUE).alias("_point"),
        F.lit(1).alias("_probe"),
    )
    # Walking back in time, the latest row seen is the first one at or after a probe.
    back = (
        Window.partitionBy(*keys, SLICE)
        .orderBy(F.col("_point").desc(), F.col("_probe"))
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    is_row = F.col("_probe") == 0
    both = rows.unionByName(probes)
    row_point = F.when(is_row, F.col("_point"))
    inside = both.withColumn("_inside", F.min(row_point).over(back)).filter(~is_row)
    later = Window.partitionBy(*keys).orderBy(F.col(SLICE).desc()).rowsBetween(
        Window.unboundedPreceding, -1
    )
    # A probe may fall into a slice without rows, so those count as well.
    firsts = both.groupBy(*keys, SLICE).agg(F.min(row_point).alias("_first"))
    carried = firsts.select(*keys, SLICE, F.min("_first").over(later).alias("_after"))
    joined = join_small(inside, carried, [*keys, SLICE])
    return joined.select(
        *keys, F.col("_point").alias(_DUE), F.coalesce("_inside", "_after").alias("_next")
    )


def throttle(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    interval_s: int | Column,
    *,
    slices: SlicePlan | str | None = None,
) -> DataFrame:
    """Rows of each key at least ``interval_s`` seconds after the key's last emitted row.

    ``order`` is the time column (epoch ms) and the columns that break ties; the first row
    of a key is always emitted. An interval of 0 emits every row. A row without a time is
    never due. A column may give the interval, if it is the same on all rows of a key.
    """
    if isinstance(interval_s, int) and interval_s == 0:
        return df
    gap = F.lit(interval_s) if isinstance(interval_s, int) else interval_s
    time = F.col(order[0])
    timed = df.withColumns(
        {
            _TIME: F.coalesce(time.cast("long"), F.lit(0)),
            _INTERVAL: gap.cast("long") * 1000,
        }
    ).filter(time.isNotNull() | (F.col(_INTERVAL) <= 0))
    plan = resolve(slices, timed, keys, order)
    if not plan.hot:
        return _throttle_sorted(timed, keys, order, df.schema)
    ordinary, hot = plan.split(timed)
    # Several steps read the hot rows, so what leads to them is computed only once; the
    # others are read once and need no copy.
    hot = cut_lineage(hot)
    always, limited = (
        hot.filter(F.col(_INTERVAL) <= 0),
        hot.filter(F.col(_INTERVAL) > 0),
    )
    return (
        _throttle_sorted(ordinary, keys, order, df.schema)
        .unionByName(always.select(*df.columns))
        .unionByName(_throttle_hot(limited, plan, keys, order, df.schema))
    )
