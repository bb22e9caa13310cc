"""A whole pipeline: parse, enrich, detect events, throttle, send."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from sigweave.functions.sql import register_functions
from sigweave.operators.latest import latest_per_key
from sigweave.operators.parse import (
    cast_fields,
    derive_and_filter,
    filter_rows,
    parse_delimited,
)
from sigweave.operators.project import output_columns
from sigweave.operators.slices import NO_SLICES, SlicePlan, plan_slices
from sigweave.operators.throttle import throttle
from sigweave.plans.rules import Rule, RuleContext, attach_rules
from sigweave.sinks.latest_table import LatestTable
from sigweave.sinks.writers import Writer, fan_out, write_sink
from sigweave.specs import EventSpec, InterfaceSpec
from sigweave.streaming.keyed import STATE_LATEST, read_state, throttle_stream
from sigweave.streaming.run import start_batches

EVENT = "_event"
_DUE = "_due"


@dataclass(frozen=True)
class Pipeline:
    """Input layout, rules, events and dimension tables of one pipeline.

    ``observe`` names the counts of the stages: ``<name>`` has the lines read and
    rejected, ``<name>_rows`` the rows left after the filter, ``<name>_events`` the event
    rows after the throttle.
    """

    interface: InterfaceSpec
    rules: Sequence[Rule] = ()
    events: Sequence[EventSpec] = ()
    dims: Mapping[str, DataFrame] = field(default_factory=dict)
    clock: str = "event"
    ttl_ms: int | None = None
    observe: str | None = None

    @property
    def order(self) -> list[str]:
        return [self.interface.time, *self.interface.order]

    def parse(self, lines: DataFrame) -> DataFrame:
        return self._parse(lines, self.observe)

    def _parse(self, lines: DataFrame, observe: str | None = None) -> DataFrame:
        spec = self.interface
        rows = parse_delimited(
            lines, spec.fields, spec.delim, regex=spec.regex, observe=observe
        )
        if spec.typed:
            rows = cast_fields(rows, spec.fields)
        return derive_and_filter(rows, spec.derived, spec.condition)

    def enrich(self, rows: DataFrame, slices: SlicePlan | str | None = None) -> DataFrame:
        return attach_rules(
            rows,
            self.rules,
            self.dims,
            self.interface.keys,
            self.order,
            slices=slices,
            ttl_ms=self.ttl_ms,
        )

    def detect(
        self,
        enriched: DataFrame,
        slices: SlicePlan | str | None = None,
        newest: str | None = None,
    ) -> DataFrame:
        """Rows of all events, marked by ``_event``, after each event's throttle.

        All events are decided in one pass over the enriched rows and share one throttle. In a
        stream, ``newest`` names a column that tells these rows from the newest rows of events
        with ``keep_latest``, which are given as well.
        """
        hits = F.array_compact(
            F.array(
                *[F.when(F.expr(e.condition or "true"), F.lit(e.id)) for e in self.events]
            )
        )
        matched = enriched.withColumn(EVENT, F.explode(hits))
        keys = [EVENT, *self.interface.keys]
        kept = [e.id for e in self.events if e.keep_latest]
        throttled = any(e.interval_s for e in self.events)
        if not throttled and not (kept and enriched.isStreaming):
            return matched
        if enriched.isStreaming:
            return throttle_stream(
                matched,
                keys,
                self.order,
                self._interval(),
                clock=self.clock,
                keep_latest=F.col(EVENT).isin(kept) if kept else None,
                ttl_ms=self.ttl_ms,
                newest=newest,
            )
        if self.clock == "processing":
            # All rows of a table are handled at one time: the first of a key passes.
            timed = matched.withColumn("_clock", F.unix_millis(F.current_timestamp()))
            return throttle(timed, keys, ["_clock", *self.order], self._interval()).drop("_clock")
        return throttle(matched, keys, self.order, self._interval(), slices=slices)

    def _interval(self) -> Column:
        value = F.lit(0)
        for event in self.events:
            value = F.when(F.col(EVENT) == event.id, event.interval_s).otherwise(value)
        return value.cast("long")

    def run(self, lines: DataFrame) -> DataFrame:
        """Detected event rows of a table or stream of lines.

        On a table, hot keys are found once on the parsed rows for all rules and the
        throttle.
        """
        register_functions(lines.sparkSession)
        rows = self._counted(self.parse(lines), "rows")
        if rows.isStreaming:
            return self._counted(self.detect(self.enrich(rows)), "events")
        slices = self._slices(lines)
        return self._counted(self.detect(self.enrich(rows, slices), slices), "events")

    def process(
        self, lines: DataFrame, *, now: int | None = None, write: Writer = write_sink
    ) -> None:
        """What ``start`` does for a stream, for a table: latest-row tables and sinks."""
        register_functions(lines.sparkSession)
        slices = self._slices(lines)
        enriched = self.enrich(self._counted(self.parse(lines), "rows"), slices)
        for event in self._with_table():
            self._table(event).upsert(self._latest_rows(filter_rows(enriched, event.condition), event))
        detected = self._counted(self.detect(enriched, slices), "events")
        self.send(detected, now=now, write=write)

    def _with_table(self) -> list[EventSpec]:
        return [e for e in self.events if e.keep_latest and e.latest_path]

    def _table(self, event: EventSpec) -> LatestTable:
        return LatestTable(event.latest_path, self.interface.keys, self.order)

    def _latest_rows(self, rows: DataFrame, event: EventSpec) -> DataFrame:
        """What the latest-row table of an event holds: its output columns, keys and order."""
        columns = output_columns(event.select, self.interface.keys, event.ext)
        names = {name for _, name in columns}
        columns += [(c, c) for c in self.order if c not in names]
        return rows.select(*[F.expr(e).alias(name) for e, name in columns])

    def _slices(self, lines: DataFrame) -> SlicePlan | str:
        slices = NO_SLICES
        if self._stateful():
            slices = plan_slices(
                self._parse(lines),
                self.interface.keys,
                self.order,
                sampled=lambda thin: self._parse(thin(lines)),
            )
        return slices

    def _counted(self, df: DataFrame, stage: str) -> DataFrame:
        if not self.observe:
            return df
        return df.observe(f"{self.observe}_{stage}", F.count(F.lit(1)).alias(stage))

    def _stateful(self) -> bool:
        context = RuleContext(self.dims, self.interface.keys, self.order)
        return any(e.interval_s for e in self.events) or any(
            rule.step(context) is not None for rule in self.rules
        )

    def send(
        self,
        detected: DataFrame,
        *,
        now: int | None = None,
        write: Writer = write_sink,
        batch_id: int | None = None,
    ) -> None:
        keys = self.interface.keys
        fan_out(detected, self.events, keys, now=now, write=write, batch_id=batch_id)

    def latest(self, enriched: DataFrame, event: EventSpec) -> DataFrame:
        """Latest row per key of a table's rows that satisfy an event's condition.

        A stream keeps these rows in its state, see ``latest_of_stream``.
        """
        rows = filter_rows(enriched, event.condition)
        return latest_per_key(rows, self.interface.keys, self.order)

    def latest_of_stream(
        self, spark: SparkSession, checkpoint: str, event: EventSpec
    ) -> DataFrame:
        """Latest row per key of an event with ``keep_latest`` of a stream."""
        rows = read_state(spark, checkpoint, STATE_LATEST)
        return rows.filter(F.col(EVENT) == event.id).drop(EVENT)

    def start(
        self,
        lines: DataFrame,
        checkpoint: str,
        *,
        interval_s: float | None = None,
        now: int | None = None,
        write: Writer = write_sink,
    ) -> StreamingQuery:
        """Runs the pipeline on a stream of lines, one fan-out per micro-batch.

        Without ``interval_s`` it ends when all present lines are done; state that expires
        needs a stream that keeps running.
        """
        if self.ttl_ms and interval_s is None:
            raise ValueError("ttl_ms needs interval_s")

        def handle(batch: DataFrame, batch_id: int) -> None:
            self.send(batch, now=now, write=write, batch_id=batch_id)

        def handle_all(batch: DataFrame, batch_id: int) -> None:
            # A second pass would run the stateful operators again.
            batch.persist(StorageLevel.MEMORY_AND_DISK)
            try:
                for event in self._with_table():
                    rows = batch.filter(F.col(EVENT) == event.id)
                    self._table(event).upsert(self._latest_rows(rows, event), batch_id)
                handle(batch.filter(_DUE).drop(_DUE), batch_id)
            finally:
                batch.unpersist()

        if not self._with_table():
            return start_batches(self.run(lines), checkpoint, handle, interval_s)
        register_functions(lines.sparkSession)
        rows = self.enrich(self._counted(self.parse(lines), "rows"))
        detected = self.detect(rows, newest=_DUE)
        return start_batches(detected, checkpoint, handle_all, interval_s)
