"""Writing batches of messages or rows to sinks (O1-O3)."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import replace

from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sigweave.operators.project import output_columns, project_event
from sigweave.sinks.messages import key_partition, keyed_message
from sigweave.specs import EventSpec, SinkSpec

Writer = Callable[[DataFrame, SinkSpec], None]


def jdbc_options(spec: SinkSpec) -> dict[str, str]:
    if not spec.url or not spec.table:
        raise ValueError("a jdbc sink needs a url and a table")
    return {"url": spec.url, "dbtable": spec.table, **spec.options}


def kafka_sink_options(spec: SinkSpec) -> dict[str, str]:
    if not spec.brokers or not spec.topic:
        raise ValueError("a kafka sink needs brokers and a topic")
    return {"kafka.bootstrap.servers": spec.brokers, **spec.options}


def write_sink(df: DataFrame, spec: SinkSpec) -> None:
    """Writes a batch to a sink, by default after what is there."""
    if spec.kind == "kafka":
        df.write.format("kafka").options(**kafka_sink_options(spec)).save()
    elif spec.kind == "jdbc":
        df.write.format("jdbc").options(**jdbc_options(spec)).mode(spec.mode).save()
    elif spec.kind == "parquet":
        df.write.options(**spec.options).mode(spec.mode).parquet(spec.path)
    else:
        raise ValueError(f"sink kind {spec.kind!r} is not supported")


def of_batch(
    df: DataFrame, spec: SinkSpec, batch_id: int, output: int
) -> tuple[DataFrame, SinkSpec]:
    """Rows and sink of a micro-batch's ``output``-th write, see ``SinkSpec.by_batch``."""
    if not spec.by_batch:
        return df, spec
    if spec.kind == "parquet":
        # Outputs that share a path must not replace each other.
        path = f"{spec.path}/batch_id={batch_id}/output={output}"
        return df, replace(spec, path=path, mode="overwrite")
    if spec.kind == "jdbc":
        return df.withColumn("batch_id", F.lit(batch_id).cast("long")), spec
    return df, spec


def event_frame(
    rows: DataFrame,
    event: EventSpec,
    sink: SinkSpec,
    keys: Sequence[str],
    now: int | None = None,
) -> DataFrame:
    """What a sink gets: the projected rows for JDBC, messages otherwise."""
    projected = project_event(rows, event.select, keys=keys, ext=event.ext)
    if sink.kind == "jdbc":
        return projected
    # A message shows the selected and extra columns; the key is beside it.
    names = [name for _, name in output_columns(event.select, (), event.ext)]
    message = keyed_message(
        projected, keys, names, delim=sink.delim, topic=sink.topic, now=now
    )
    return key_partition(message, sink.partitions) if sink.partitions else message


def fan_out(
    rows: DataFrame,
    events: Sequence[EventSpec],
    keys: Sequence[str],
    *,
    event_column: str = "_event",
    now: int | None = None,
    write: Writer = write_sink,
    batch_id: int | None = None,
) -> None:
    """Writes detected rows of many events to all sinks of each event.

    The rows are computed once and kept until the last sink is done.
    """
    sinks = [(event, sink) for event in events for sink in event.sinks]
    if not sinks:
        # A stateful stream fails if nobody reads its batch.
        rows.write.format("noop").mode("overwrite").save()
        return
    if len(sinks) > 1:
        rows.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        for output, (event, sink) in enumerate(sinks):
            chosen = rows.filter(rows[event_column] == event.id)
            frame = event_frame(chosen, event, sink, keys, now)
            if batch_id is not None:
                frame, sink = of_batch(frame, sink, batch_id, output)
            write(frame, sink)
    finally:
        if len(sinks) > 1:
            rows.unpersist()
