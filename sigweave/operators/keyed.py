"""Rules on the previous row of a key (K1, K2)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from sigweave.functions.geo import great_circle_km, whole_km
from sigweave.operators.lookup import add_labels
from sigweave.operators.slices import SLICE, SlicePlan, join_small, resolve

PREVIOUS = "_previous"


def with_previous(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    columns: Sequence[str],
    slices: SlicePlan | str | None = None,
) -> DataFrame:
    """Adds struct ``_previous`` with ``columns`` of the previous row of the key.

    ``order`` is the time column (epoch ms) and the columns that break ties. The struct is
    null on the first row of a key.
    """
    plan = resolve(slices, df, keys, order)
    packed = F.struct(*columns)
    if not plan.hot:
        window = Window.partitionBy(*keys).orderBy(*order)
        return df.withColumn(PREVIOUS, F.lag(packed).over(window))
    tagged = plan.tag(df)
    window = Window.partitionBy(*keys, SLICE).orderBy(*order)
    inside = tagged.withColumn("_inside", F.lag(packed).over(window))
    last_rows = (
        tagged.filter(F.col(SLICE).isNotNull())
        .groupBy(*keys, SLICE)
        .agg(F.max_by(packed, F.struct(*order)).alias("_last"))
    )
    across = Window.partitionBy(*keys).orderBy(SLICE)
    carried = last_rows.select(*keys, SLICE, F.lag("_last").over(across).alias("_carried"))
    joined = join_small(inside, carried, [*keys, SLICE])
    return joined.withColumn(PREVIOUS, F.coalesce("_inside", "_carried")).drop(
        "_inside", "_carried", SLICE
    )


def previous_value(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    column: str,
    *,
    name: str = "last_imei",
    slices: SlicePlan | str | None = None,
) -> DataFrame:
    """Label ``name``: the column's value on the previous row of the key, "" at first."""
    found = with_previous(df, keys, order, [column], slices)
    value = F.coalesce(F.col(PREVIOUS)[column].cast("string"), F.lit(""))
    return add_labels(found, df, [(name, value)])


def user_track(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    *,
    latitude: str = "geo_latitude",
    longitude: str = "geo_longitude",
    site: Sequence[str] = ("lac", "ci"),
    slices: SlicePlan | str | None = None,
) -> DataFrame:
    """Movement labels against the previous row of the key.

    Distance and speed are null on a key's first row; speed is null if no time passed.
    """
    located = df.withColumn("_site_code", F.concat(*[F.col(c) for c in site]))
    columns = [latitude, longitude, order[0], "_site_code"]
    found = with_previous(located, keys, order, columns, slices)
    old = F.col(PREVIOUS)
    distance = whole_km(
        great_circle_km(F.col(latitude), F.col(longitude), old[latitude], old[longitude])
    )
    measured = found.select(
        *df.columns,
        distance.alias("_distance"),
        (F.col(order[0]) - old[order[0]]).alias("_elapsed"),
        old["_site_code"].alias("_site_before"),
    )
    labels = [
        ("distance", F.col("_distance")),
        ("speed", F.when(F.col("_elapsed") != 0, F.col("_distance") / F.col("_elapsed"))),
        ("last_lac_ci", F.coalesce("_site_before", F.lit(""))),
    ]
    return add_labels(measured, df, labels)
