"""As-of look-up: the entry of a history that is valid at a row's time (2.9, D6 over history).

Rows and history are put into one sequence per key and ordered by time; the last entry seen is
carried forward to the rows. That is one exchange and one sort by key, and no pair of a row with
an entry other than its own arises. Keys that own a great part of the data are cut into slices:
inside a slice the entry is carried as usual, and the last entry of each slice is carried on
to the next ones by a summary with one row per slice.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from sigweave.operators.slices import SLICE, SlicePlan, join_small, resolve

_AT, _SIDE, _TIE = "_at", "_side", "_tie"


def as_of(
    df: DataFrame,
    history: DataFrame,
    on: Sequence[tuple[Column | str, str]],
    time: str,
    valid_from: str,
    columns: Sequence[str],
    *,
    ties: Sequence[str] = (),
    until: str | None = None,
    into: str = "_entry",
    slices: SlicePlan | str | None = None,
) -> DataFrame:
    """Adds struct ``into`` with ``columns`` of the latest entry of the key at each row's time.

    ``on`` pairs a row's expression with a column of ``history``. An entry holds from
    ``valid_from`` on, that moment included, until the key's next one, or until ``until`` (that
    moment not included) if it names a column and that is earlier. Of entries of one moment the
    greatest by ``ties`` and then by ``columns`` holds. Times are epoch milliseconds. Rows with
    a null key or time, and rows before the first entry, find nothing and are kept; entries
    with a null key or start hold for nothing. Rows of a stream meet a table of entries that
    is worked out for every micro-batch.
    """
    if df.isStreaming:
        return _as_of_stream(df, history, on, time, valid_from, columns, ties, until, into)
    keys = [f"_as_{i}" for i in range(len(on))]
    kept = F.struct(*df.columns)
    entry = F.struct(*[F.col(c) for c in columns], *([F.col(until).alias("_until")] if until else []))
    facts = df.select(
        *[(F.col(f) if isinstance(f, str) else f).alias(k) for (f, _), k in zip(on, keys)],
        F.col(time).cast("long").alias(_AT),
        kept.alias("_row"),
    )
    known = F.lit(True)
    for k in [*keys, _AT]:
        known = known & F.col(k).isNotNull()
    tie = F.struct(*[F.col(c) for c in [*ties, *columns]])
    starts = history.select(
        *[F.col(d).alias(k) for (_, d), k in zip(on, keys)],
        F.col(valid_from).cast("long").alias(_AT),
        tie.alias(_TIE),
        entry.alias("_held"),
    ).filter(known)
    # Rows that can find nothing stay out of the sequence, so nulls make no hot key.
    lost = facts.filter(~known)
    sequence = facts.filter(known).withColumn(_SIDE, F.lit(1)).unionByName(
        starts.withColumn(_SIDE, F.lit(0)), allowMissingColumns=True
    )
    order = [_AT, _SIDE]
    plan = resolve(slices, sequence, keys, order)
    found = _carried(sequence, keys, plan).filter(F.col(_SIDE) == 1)
    held = F.col("_held")
    if until:
        still = held["_until"].isNull() | (F.col(_AT) < held["_until"])
        held = F.when(still, held)
    value = F.when(held.isNotNull(), F.struct(*[held[c].alias(c) for c in columns]))
    rows = found.select("_row.*", value.alias(into))
    nothing = lost.select("_row.*", F.lit(None).cast(rows.schema[into].dataType).alias(into))
    return rows.unionByName(nothing)


def _as_of_stream(df, history, on, time, valid_from, columns, ties, until, into) -> DataFrame:
    """Each entry gets the time of its key's next one, and rows look up the span they are in."""
    keys = [f"_as_{i}" for i in range(len(on))]
    starts = history.select(
        *[F.col(d).alias(k) for (_, d), k in zip(on, keys)],
        F.col(valid_from).cast("long").alias("_from"),
        (F.col(until).cast("long") if until else F.lit(None).cast("long")).alias("_until"),
        F.struct(*[F.col(c) for c in [*ties, *columns]]).alias(_TIE),
        F.struct(*columns).alias(into),
    ).filter("_from IS NOT NULL")
    # Of entries of one moment one is left, then each ends where the next begins.
    newest = starts.groupBy(*keys, "_from").agg(
        F.max_by(F.struct("_until", into), _TIE).alias("_entry")
    )
    following = F.lead("_from").over(Window.partitionBy(*keys).orderBy("_from"))
    spans = newest.select(
        *[F.col(k).alias(f"{k}_h") for k in keys],
        "_from",
        # Without either end an entry holds for ever.
        F.least(following, F.col("_entry._until")).alias("_to"),
        F.col(f"_entry.{into}").alias(into),
    )
    rows = df.select(
        "*", *[(F.col(f) if isinstance(f, str) else f).alias(k) for (f, _), k in zip(on, keys)]
    )
    at = F.col(time).cast("long")
    same = (at >= F.col("_from")) & (F.col("_to").isNull() | (at < F.col("_to")))
    for k in keys:
        same = same & (F.col(k) == F.col(f"{k}_h"))
    return rows.join(spans, same, "left").select(*df.columns, into)


def _carried(sequence: DataFrame, keys: Sequence[str], plan: SlicePlan) -> DataFrame:
    """``_held`` of every row: its own or the last one before it in its key."""
    last = F.last("_held", ignorenulls=True)
    if not plan.hot:
        window = Window.partitionBy(*keys).orderBy(_AT, _SIDE, _TIE)
        return sequence.withColumn("_held", last.over(window.rowsBetween(Window.unboundedPreceding, 0)))
    tagged = plan.tag(sequence)
    window = Window.partitionBy(*keys, SLICE).orderBy(_AT, _SIDE, _TIE)
    inside = tagged.withColumn(
        "_held", last.over(window.rowsBetween(Window.unboundedPreceding, 0))
    )
    # One row per slice of a hot key; combined map-side.
    ends = (
        tagged.filter(F.col(SLICE).isNotNull())
        .groupBy(*keys, SLICE)
        .agg(F.max_by("_held", F.when(F.col("_held").isNotNull(), F.struct(_AT, _TIE))).alias("_last"))
    )
    before = Window.partitionBy(*keys).orderBy(SLICE).rowsBetween(Window.unboundedPreceding, -1)
    carried = ends.select(*keys, SLICE, F.last("_last", ignorenulls=True).over(before).alias("_carried"))
    joined = join_small(inside, carried, [*keys, SLICE])
    return joined.withColumn("_held", F.coalesce("_held", "_carried")).drop("_carried", SLICE)
