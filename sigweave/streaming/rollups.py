"""Roll-ups that grow with a stream instead of being worked out anew (2.9).

Each micro-batch leaves one row of partial aggregates per finest group: counts and sums, and
sketches of distinct values and quantiles, all of which can be merged. A roll-up merges the
partial rows into every wanted set of groups. The events are read once, whatever is asked later,
and a micro-batch that is repeated replaces its own partial rows.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from sigweave.streaming.run import start_batches

# Buckets of the sketch of distinct values (a power of two): a standard error of 1.6 %.
DISTINCT_BITS = 12
# Size of the sketch of quantiles: a rank error of 1.3 %.
QUANTILE_SIZE = 200
BATCH = "batch_id"


@dataclass(frozen=True)
class RollupSpec:
    """Finest groups, and what is kept of each: sums, distinct values and quantiles.

    ``quantiles`` name whole-number columns.
    """

    groups: Sequence[str]
    sums: Sequence[str] = ()
    distinct: Sequence[str] = ()
    quantiles: Sequence[str] = ()

    @property
    def _partial(self) -> list[Column]:
        return [
            F.count("*").alias("n"),
            *[F.sum(c).alias(f"sum_{c}") for c in self.sums],
            *[F.hll_sketch_agg(c, DISTINCT_BITS).alias(f"hll_{c}") for c in self.distinct],
            *[
                F.kll_sketch_agg_bigint(F.col(c).cast("long"), QUANTILE_SIZE).alias(f"kll_{c}")
                for c in self.quantiles
            ],
        ]

    def partial(self, rows: DataFrame) -> DataFrame:
        """One row per finest group; partly summed before the shuffle."""
        return rows.groupBy(*self.groups).agg(*self._partial)

    @property
    def _merged(self) -> list[Column]:
        return [
            F.sum("n").alias("n"),
            *[F.sum(f"sum_{c}").alias(f"sum_{c}") for c in self.sums],
            *[F.hll_union_agg(f"hll_{c}").alias(f"hll_{c}") for c in self.distinct],
            *[F.kll_merge_agg_bigint(f"kll_{c}").alias(f"kll_{c}") for c in self.quantiles],
        ]

    def merged(self, partials: DataFrame, sets: Sequence[Sequence[str]]) -> DataFrame:
        """Partial rows merged into each of the grouping ``sets``; other groups are null.

        ``grouping`` tells which groups a row is not by, as SQL's ``grouping_id`` of all.
        """
        columns = [[F.col(c) for c in s] for s in sets]
        found = partials.groupingSets(columns, *[F.col(c) for c in self.groups]).agg(
            F.grouping_id().alias("grouping"), *self._merged
        )
        return found.select(*self.groups, "grouping", "n", *found.columns[len(self.groups) + 2 :])

    def read(self, merged: DataFrame, probabilities: Sequence[float] = (0.5,)) -> DataFrame:
        """Numbers instead of sketches: ``distinct_<c>``, and an array ``quantiles_<c>``."""
        kept = [c for c in merged.columns if not c.startswith(("hll_", "kll_"))]
        return merged.select(
            *kept,
            *[F.hll_sketch_estimate(f"hll_{c}").alias(f"distinct_{c}") for c in self.distinct],
            *[
                F.array(
                    *[F.kll_sketch_get_quantile_bigint(f"kll_{c}", F.lit(p)) for p in probabilities]
                ).alias(f"quantiles_{c}")
                for c in self.quantiles
            ],
        )


def start_rollup(
    rows: DataFrame, spec: RollupSpec, checkpoint: str, path: str, interval_s: float | None = None
) -> StreamingQuery:
    """Leaves the partial rows of every micro-batch of a stream below ``path``."""

    def keep(batch: DataFrame, batch_id: int) -> None:
        spec.partial(batch).write.mode("overwrite").parquet(f"{path}/{BATCH}={batch_id}")

    return start_batches(rows, checkpoint, keep, interval_s)


def partials(spark: SparkSession, path: str) -> DataFrame:
    """The partial rows of all micro-batches so far."""
    return spark.read.parquet(path).drop(BATCH)


def compacted(spec: RollupSpec, rows: DataFrame) -> DataFrame:
    """Partial rows with one row per finest group, to be kept in place of those of many batches."""
    return rows.groupBy(*spec.groups).agg(*spec._merged)
