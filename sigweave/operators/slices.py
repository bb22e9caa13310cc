"""Slices of hot keys.

Rules with state follow one key through time. A window per key would put a key that owns a
third of the data into one task, so such keys are cut into consecutive slices of their
order that are worked on in parallel; a small summary per slice then carries the state from
slice to slice. Where a key is cut never changes a result, only the balance of the work.

A key is hot if it holds more than ``rows_per_slice`` rows. Slices keep that size however large
the data is, so there are more of them in larger data; the table of cuts is written below the
shared folder and joined like any other table, broadcast only if it is measured to be small.
Hot keys and cuts come from thin samples of the key and order columns, since counting all keys
would shuffle about as much as the rule itself. Most inputs have no hot key and keep the plain
window plan.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from sigweave.session import run_dir

ROWS_PER_SLICE = 4_000_000
# Expected sample rows of a key that just reaches the size of a slice: to find hot keys,
# and to place the cuts.
SAMPLES_PER_SLICE = 1000
POINTS_PER_SLICE = 100
_SEED = 20_240_101

SLICE = "_slice"
NO_SLICES = "none"


@dataclass(frozen=True)
class SlicePlan:
    """Cut table of the hot keys of one input; ``table`` is None if there are none."""

    keys: tuple[str, ...]
    order: tuple[str, ...]
    table: DataFrame | None = None

    @property
    def hot(self) -> bool:
        return self.table is not None

    def tag(self, df: DataFrame) -> DataFrame:
        """Adds the slice number; null for keys that are not cut."""
        if self.table is None:
            return df.withColumn(SLICE, F.lit(None).cast("int"))
        joined = join_small(df, self.table, self.keys)
        place = slice_of(F.struct(*self.order))
        return joined.select(*df.columns, place.alias(SLICE))

    def split(self, df: DataFrame) -> tuple[DataFrame, DataFrame]:
        """(rows of ordinary keys, rows of hot keys)."""
        tagged = self.tag(df)
        return (
            tagged.filter(F.col(SLICE).isNull()).drop(SLICE),
            tagged.filter(F.col(SLICE).isNotNull()),
        )


def join_small(df: DataFrame, small: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Left join on ``cols`` where nulls match; Spark broadcasts ``small`` if it is small."""
    renamed = small.select(
        *[F.col(c).alias(f"_j_{c}") if c in cols else F.col(c) for c in small.columns]
    )
    condition = None
    for c in cols:
        equal = df[c].eqNullSafe(renamed[f"_j_{c}"])
        condition = equal if condition is None else condition & equal
    return df.join(renamed, condition, "left").drop(*[f"_j_{c}" for c in cols])


def slice_of(place: Column) -> Column:
    """Number of cuts at or before a place in the order, for a row joined with its cuts.

    A binary search: ``_powers`` holds the falling powers of two up to the number of cuts.
    """
    return F.when(
        F.col("_cuts").isNotNull(),
        F.aggregate(
            "_powers",
            F.lit(0),
            lambda found, step: F.when(
                F.get("_cuts", found + step - 1) <= place, found + step
            ).otherwise(found),
        ),
    )


def plan_slices(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    *,
    rows_per_slice: int = ROWS_PER_SLICE,
    sampled: Callable[[Callable[[DataFrame], DataFrame]], DataFrame] | None = None,
) -> SlicePlan:
    """Finds hot keys and cuts them into slices of about equal row counts.

    ``order`` is the column of epoch milliseconds and those that break ties. ``sampled``
    builds a sample of ``df`` with the sampling function it is given; use it where an
    earlier sample saves work, such as parsing.
    """
    keys, order = tuple(keys), tuple(order)

    def sample(fraction: float) -> DataFrame:
        def thin(rows: DataFrame) -> DataFrame:
            return rows.sample(fraction, _SEED) if fraction < 1.0 else rows

        columns = list(dict.fromkeys([*keys, *order]))
        if sampled is not None:
            return sampled(thin).select(*columns)
        return thin(df.select(*columns))

    fraction = min(1.0, SAMPLES_PER_SLICE / rows_per_slice)
    seen = sample(fraction).groupBy(*keys).agg(F.count(F.lit(1)).alias("_seen"))
    limit = rows_per_slice * fraction
    largest = seen.agg(F.max("_seen")).first()[0]
    if largest is None or largest <= limit:
        return SlicePlan(keys, order)
    hot = _written(seen.filter(F.col("_seen") > limit), "hot-keys")

    # Every so many sample rows of a hot key there is a cut.
    fraction = min(1.0, POINTS_PER_SLICE / rows_per_slice)
    every = max(1, round(rows_per_slice * fraction))
    points = join_small(sample(fraction), hot, keys).filter(F.col("_seen").isNotNull())
    number = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    # In order of place, as an array sorts by its first field.
    cuts = (
        points.withColumn("_number", number)
        .filter(F.col("_number") % every == 0)
        .groupBy(*keys)
        .agg(F.array_sort(F.collect_list(F.struct("_number", F.struct(*order).alias("cut")))).alias("c"))
        .select(*keys, F.col("c.cut").alias("_cuts"))
    )
    # The falling powers of two up to the number of cuts.
    size = F.length(F.bin(F.size("_cuts").cast("long")))
    powers = F.transform(
        F.sequence(size - 1, F.lit(0)), lambda i: F.call_function("shiftleft", F.lit(1), i)
    )
    table = _written(cuts.withColumn("_powers", powers), "cuts")
    return SlicePlan(keys, order, table if table.take(1) else None)


def _written(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a table below the shared folder, whose size Spark knows when it plans."""
    path = run_dir(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def resolve(
    slices: SlicePlan | str | None,
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
) -> SlicePlan:
    """The plan to use: a given one, none on request, else one made for ``df``.

    A plan of some of the keys serves for all of them, as it cuts every key that is hot.
    """
    if isinstance(slices, SlicePlan):
        if not set(slices.keys) <= set(keys) or slices.order != tuple(order):
            raise ValueError("the slice plan was made for other keys or another order")
        return slices
    if slices == NO_SLICES:
        return SlicePlan(tuple(keys), tuple(order))
    return plan_slices(df, keys, order)
