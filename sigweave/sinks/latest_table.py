"""Latest row per key as a table that others can read while a stream runs (K6).

Keys are dealt into a fixed number of buckets. A micro-batch rewrites only the buckets that its
keys fall into, each to a new place, and then adds one file of pointers that names the places. A
reader takes the newest pointer of each bucket, so it sees a micro-batch whole or not at all, and
what it reads is never changed under it. Pointers carry the batch's number: a batch that is
repeated finds its own and changes nothing.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark import StorageLevel
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sigweave.operators.latest import latest_per_key, merge_latest

BUCKETS = 64
_BUCKET = "latest_bucket"
_POINTERS = "version long, bucket int, place string, batch_id long"


@dataclass(frozen=True)
class LatestTable:
    """The table at ``path``: one row per ``keys``, the last by ``order``.

    The number of buckets stays as it was when the table was begun. Places that no pointer
    names any more are left for readers that are still at them.
    """

    path: str
    keys: Sequence[str]
    order: Sequence[str]
    buckets: int = BUCKETS

    def _pointers(self, spark: SparkSession) -> DataFrame:
        try:
            return spark.read.schema(_POINTERS).parquet(f"{self.path}/pointers")
        except AnalysisException:  # nothing was written yet
            return spark.createDataFrame([], _POINTERS)

    def places(self, spark: SparkSession) -> dict[int, str]:
        """Where the rows of each bucket are now; a bucket without rows has no place."""
        newest = self._pointers(spark).groupBy("bucket").agg(
            F.max_by("place", "version").alias("place")
        )
        return {r["bucket"]: r["place"] for r in newest.collect()}

    def read(self, spark: SparkSession) -> DataFrame | None:
        """The rows as they are now; None if nothing was written."""
        places = sorted(self.places(spark).values())
        return spark.read.parquet(*places) if places else None

    def upsert(self, rows: DataFrame, batch_id: int | None = None) -> bool:
        """Puts ``rows`` in; False if the micro-batch ``batch_id`` was put in before."""
        spark = rows.sparkSession
        last, done = (
            self._pointers(spark)
            .agg(F.max("version"), F.max("batch_id"))
            .first()
        )
        if batch_id is not None and done is not None and batch_id <= done:
            return False
        place = F.pmod(F.xxhash64(*self.keys), F.lit(self.buckets)).cast("int")
        fresh = latest_per_key(rows, self.keys, self.order).persist(StorageLevel.MEMORY_AND_DISK)
        try:
            # At most as many as there are buckets.
            touched = [r[0] for r in fresh.select(place.alias("b")).distinct().collect()]
            if not touched:
                return True
            held = self.places(spark)
            old = [held[b] for b in touched if b in held]
            table = spark.read.schema(fresh.schema).parquet(*old) if old else None
            merged = merge_latest(table, fresh, self.keys, self.order)
            out = f"{self.path}/rows-{uuid.uuid4().hex}"
            merged.withColumn(_BUCKET, place).repartition(_BUCKET).write.partitionBy(_BUCKET).parquet(out)
        finally:
            fresh.unpersist()
        pointers = [
            ((last or 0) + 1, b, f"{out}/{_BUCKET}={b}", batch_id) for b in sorted(touched)
        ]
        # One file, so all pointers of a batch appear at once.
        frame = spark.createDataFrame(pointers, _POINTERS).coalesce(1)
        frame.write.mode("append").parquet(f"{self.path}/pointers")
        return True
