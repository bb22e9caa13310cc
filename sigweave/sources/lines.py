"""Line sources (S1-S5): each yields one text column ``value``."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sigweave.specs import SourceSpec


def kafka_options(spec: SourceSpec) -> dict[str, str]:
    """Options of Spark's Kafka source for ``spec``."""
    if not spec.topics or not spec.brokers:
        raise ValueError("a kafka source needs topics and brokers")
    options = {
        "kafka.bootstrap.servers": spec.brokers,
        "subscribe": ",".join(spec.topics),
    }
    if spec.group:
        options["kafka.group.id"] = spec.group
    if spec.min_partitions:
        options["minPartitions"] = str(spec.min_partitions)
    if spec.offsets:
        # Only the named partitions are read: Spark wants a place for each one it reads.
        if set(spec.offsets) != set(spec.topics):
            raise ValueError("offsets must name partitions of every topic and of no other")
        del options["subscribe"]
        options["assign"] = json.dumps({t: sorted(parts) for t, parts in spec.offsets.items()})
        # Used on the first start only; later starts go on from the checkpoint.
        options["startingOffsets"] = json.dumps(
            {t: {str(p): o for p, o in parts.items()} for t, parts in spec.offsets.items()}
        )
    options.update(spec.options)
    return options


def read_lines(spark: SparkSession, spec: SourceSpec, *, streaming: bool = True) -> DataFrame:
    """Lines of the source as a stream, or as a table with ``streaming=False``."""
    reader = spark.readStream if streaming else spark.read
    if spec.kind == "kafka":
        if spec.payload not in ("key", "value"):
            raise ValueError(f"unknown payload {spec.payload!r}")
        raw = reader.format("kafka").options(**kafka_options(spec)).load()
        return raw.select(F.col(spec.payload).cast("string").alias("value"))
    if spec.kind == "text":
        if not spec.path:
            raise ValueError("a text source needs a path")
        return reader.options(**spec.options).text(spec.path).select("value")
    raise ValueError(f"source kind {spec.kind!r} is not supported")
