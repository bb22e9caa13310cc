"""Dimension tables that change while a stream runs.

A dimension is published in versions. A version is a snapshot, and a partition of a catalog
table named by the time from which it counts. Spark asks the catalog for the partitions of a
table whenever it plans, so a running stream sees a new version in its next micro-batch. Which
one counts is decided by the batch's own time, which Spark writes to the checkpoint together with
the batch's offsets: a micro-batch that is repeated after a failure, also by another run, joins
the same version again.
"""

from __future__ import annotations

import time
import uuid
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

VERSION = "version_ms"
# A version counts only after this time, so that it is known before any batch can use it.
LEAD_MS = 2_000
# Versions that are kept: batches that may be repeated must find theirs.
KEEP = 100


@dataclass(frozen=True)
class VersionedDimension:
    """The versions of one dimension below ``path``, and the catalog table that shows them."""

    spark: SparkSession
    path: str
    schema: StructType
    name: str
    lead_ms: int = LEAD_MS

    @classmethod
    def open(
        cls,
        spark: SparkSession,
        path: str,
        schema: StructType | str,
        *,
        name: str | None = None,
        lead_ms: int = LEAD_MS,
    ) -> VersionedDimension:
        """The dimension at ``path``, empty if nothing was published there.

        ``name`` is its name in the catalog. Sessions with one catalog share it, and what one
        publishes the others see; a session with a catalog of its own sees what was published
        when it opened the dimension, and calls ``refresh`` for more.
        """
        columns = StructType.fromDDL(schema) if isinstance(schema, str) else schema
        name = name or f"dimension_{uuid.uuid4().hex}"
        ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in columns.fields)
        spark.sql(
            f"CREATE TABLE IF NOT EXISTS {name} ({ddl}, {VERSION} BIGINT) USING parquet"
            f" PARTITIONED BY ({VERSION}) LOCATION '{path}/empty'"
        )
        found = cls(spark, path, columns, name, lead_ms)
        found.refresh()
        return found

    def _published(self) -> DataFrame:
        schema = f"{VERSION} long, place string"
        try:
            return self.spark.read.schema(schema).parquet(f"{self.path}/versions")
        except AnalysisException:  # nothing was published
            return self.spark.createDataFrame([], schema)

    def versions(self) -> list[int]:
        """Times from which the kept versions count, ascending."""
        rows = self.spark.sql(f"SHOW PARTITIONS {self.name}").collect()
        return sorted(int(r[0].split("=")[1]) for r in rows)

    def refresh(self) -> None:
        """Makes versions that other sessions published known to this session's catalog."""
        known = set(self.versions())
        newest = self._published().orderBy(F.desc(VERSION)).limit(KEEP).collect()
        for row in newest:
            if row[VERSION] not in known:
                self._add(row[VERSION], row["place"])

    def _add(self, version: int, place: str) -> None:
        self.spark.sql(
            f"ALTER TABLE {self.name} ADD IF NOT EXISTS PARTITION ({VERSION}={version})"
            f" LOCATION '{place}'"
        )

    def publish(self, table: DataFrame) -> int:
        """Publishes a snapshot; returns the time from which it counts.

        The snapshot is written first and then made known, so a failure in between leaves nothing
        that a reader could see.
        """
        place = f"{self.path}/snapshot-{uuid.uuid4().hex}"
        table.select(*self.schema.names).write.parquet(place)
        lead = self.lead_ms
        while True:
            before = max(self.versions(), default=0)
            version = max(int(time.time() * 1000) + lead, before + 1)
            self._add(version, place)
            # Known in time, so no batch can have looked for it in vain. Else once more, later.
            if time.time() * 1000 < version:
                break
            self._drop(version)
            lead = 2 * lead + 1000
        row = self.spark.createDataFrame([(version, place)], f"{VERSION} long, place string")
        row.coalesce(1).write.mode("append").parquet(f"{self.path}/versions")
        for old in self.versions()[:-KEEP]:
            self._drop(old)
        return version

    def _drop(self, version: int) -> None:
        self.spark.sql(f"ALTER TABLE {self.name} DROP IF EXISTS PARTITION ({VERSION}={version})")

    def wait(self, version: int) -> None:
        """Returns when a version counts."""
        time.sleep(max(0.0, version / 1000 - time.time() + 0.001))

    def latest(self) -> DataFrame:
        """The rows of the version that counts now; in a stream, at each micro-batch's time."""
        now = F.unix_millis(F.current_timestamp())
        known = self.spark.table(self.name).filter(F.col(VERSION) <= now)
        # One row: partition names decide, and only that partition is read then.
        newest = known.agg(F.max(VERSION).alias(VERSION))
        return known.join(F.broadcast(newest), VERSION).select(*self.schema.names)

    def at(self, version: int) -> DataFrame:
        """The rows of one version."""
        rows = self.spark.table(self.name).filter(F.col(VERSION) == version)
        return rows.select(*self.schema.names)
