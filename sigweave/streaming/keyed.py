"""Keyed rules and the throttle as stateful stream operators (K1-K4, K7).

All keyed rules of a chain share one state entry per key, so a chain needs one shuffle and
one state read and write per key and micro-batch. The rate limit of the source bounds a
micro-batch; the rows of a key are sorted in memory, or on disk if there are many.

Spark hands over the rows of a group, with calls and an Arrow batch for each. As most keys have
few rows, a group is a bucket of keys, and its state a map from key to entry. Only entries of
keys that have rows are read and written.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Sequence
from itertools import chain, groupby, islice

from pyspark.serializers import CPickleSerializer
from pyspark.shuffle import ExternalSorter
from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from sigweave.streaming.steps import Step

# Groups that Spark sees. A checkpoint keeps the number that it began with.
BUCKETS = 1 << 12
_BUCKET = "_bucket"
# Rows of one bucket and micro-batch that are sorted without the disk, and the memory allowed
# to the sort beyond that.
SORT_IN_MEMORY = 50_000
SORT_MEMORY_MB = 256

STATE_RULES = "rules"
STATE_LAST_EMIT = "last_emit"
STATE_LATEST = "latest"


def _in_order(rows: Iterable[Row], order: Sequence[str]) -> Iterator[Row]:
    """Rows in ascending order, nulls first, holding a limited number in memory."""
    rows = iter(rows)
    head = list(islice(rows, SORT_IN_MEMORY))
    if not head:
        return iter(head)
    at = [head[0].__fields__.index(c) for c in order]

    def place(row: Row) -> tuple:
        plain = tuple(row)
        return tuple([(plain[i] is not None, plain[i]) for i in at])

    if len(head) < SORT_IN_MEMORY:
        return iter(sorted(head, key=place))
    sorter = ExternalSorter(SORT_MEMORY_MB, CPickleSerializer())
    return sorter.sorted(chain(head, rows), key=place)


def _by_key(
    rows: Iterable[Row], keys: Sequence[str], order: Sequence[str]
) -> Iterator[tuple[tuple, Iterator[Row]]]:
    """The keys of a bucket, each with its rows in ascending order."""
    return groupby(_in_order(rows, [*keys, *order]), key=lambda row: tuple([row[k] for k in keys]))


def _bucketed(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``df`` with the bucket of each row's key as its last column."""
    return df.withColumn(_BUCKET, F.pmod(F.xxhash64(*keys), F.lit(BUCKETS)).cast("int"))


def _fields(schema: T.StructType, names: Sequence[str]) -> T.StructType:
    return T.StructType([schema[n] for n in names])


class KeyedRules(StatefulProcessor):
    """Runs the steps of a rule chain over the rows of the keys of a bucket."""

    def __init__(
        self,
        keys: T.StructType,
        steps: Sequence[Step],
        order: Sequence[str],
        shown: Sequence[Sequence[bool]],
        given: Sequence[str],
        columns: Sequence[str],
        ttl_ms: int | None,
    ):
        self.keys, self.steps, self.order, self.shown, self.ttl_ms = keys, steps, order, shown, ttl_ms
        self.given, self.columns = given, columns

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.fields = [f for step in self.steps for f, _ in step.state]
        schema = ", ".join(f"`{f}` {t}" for step in self.steps for f, t in step.state)
        self.state = handle.getMapState(STATE_RULES, self.keys, schema, self.ttl_ms)

    def handleInitialState(self, key, initialState, timerValues) -> None:
        place = tuple(initialState[k] for k in self.keys.names)
        self.state.updateValue(place, tuple(initialState[f] for f in self.fields))

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        known = self.state.exists()
        for place, own in _by_key(rows, self.keys.names, self.order):
            stored = self.state.getValue(place) if known else None
            state = dict(zip(self.fields, stored or [None] * len(self.fields)))
            yield from self._labelled(own, state)
            self.state.updateValue(place, tuple(state[f] for f in self.fields))

    def _labelled(self, rows: Iterator[Row], state: dict) -> Iterator[Row]:
        labelled, width = Row(*self.columns), len(self.given)
        for row in rows:
            values = row[:width]
            seen = dict(zip(self.given, values))
            labels: list = []
            for step, shown in zip(self.steps, self.shown):
                found = step.apply(seen, state)
                # A name the row already has keeps the row's value.
                for (name, _), value, show in zip(step.labels, found, shown):
                    if show:
                        seen[name] = value
                        labels.append(value)
            yield labelled(*values, *labels)


def keyed_rules(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    steps: Sequence[Step],
    *,
    ttl_ms: int | None = None,
    initial: DataFrame | None = None,
) -> DataFrame:
    """Adds the labels of ``steps`` to a stream keyed by ``keys``.

    ``ttl_ms`` forgets a key that has had no row for that long. ``initial`` is the state that a
    new checkpoint starts from: one row per key with the fields of the steps' states, as
    ``rules_state`` or ``read_state`` give it. A checkpoint that has state keeps its own.
    """
    present = set(df.columns)
    schema = T.StructType(list(df.schema.fields))
    shown = []
    for step in steps:
        flags = []
        for name, kind in step.labels:
            flags.append(name not in present)
            if name not in present:
                present.add(name)
                schema = schema.add(name, kind)
        shown.append(flags)
    kinds = _fields(df.schema, keys)
    return _bucketed(df, keys).groupBy(_BUCKET).transformWithState(
        KeyedRules(kinds, steps, order, shown, df.columns, schema.names, ttl_ms),
        schema,
        "append",
        "ProcessingTime" if ttl_ms else "None",
        _grouped(initial, kinds, [f for step in steps for f, _ in step.state]),
    )


def _grouped(initial: DataFrame | None, keys: T.StructType, fields: Sequence[str]):
    if initial is None:
        return None
    # A key's bucket goes by its type as well.
    typed = initial.select(*[F.col(k.name).cast(k.dataType).alias(k.name) for k in keys], *fields)
    return _bucketed(typed, keys.names).groupBy(_BUCKET)


class Throttle(StatefulProcessor):
    """Keeps a key's last emission time and lets due rows through.

    Where the ``keep`` column is true it also keeps the key's latest row, due or not. With
    ``newest`` the newest such row of a key and micro-batch is given too if it is not due,
    with false in that column.
    """

    def __init__(
        self,
        keys: T.StructType,
        order: Sequence[str],
        clock: str,
        gap: str,
        keep: str | None,
        schema: T.StructType,
        given: Sequence[str],
        ttl_ms: int | None,
        newest: str | None = None,
    ):
        self.keys, self.order, self.clock, self.gap, self.keep = keys, order, clock, gap, keep
        self.schema, self.given, self.ttl_ms, self.shown = schema, given, ttl_ms, newest

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.sent = handle.getMapState(STATE_LAST_EMIT, self.keys, "last long", self.ttl_ms)
        if self.keep:
            self.newest = handle.getMapState(STATE_LATEST, self.keys, self.schema, self.ttl_ms)

    def handleInitialState(self, key, initialState, timerValues) -> None:
        place = tuple(initialState[k] for k in self.keys.names)
        self.sent.updateValue(place, (initialState["last"],))

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        sent = self.sent.exists()
        kept = bool(self.keep) and self.newest.exists()
        for place, own in _by_key(rows, self.keys.names, self.order):
            yield from self._due(place, own, sent, kept)

    def _due(self, place: tuple, rows: Iterator[Row], sent: bool, kept: bool) -> Iterator[Row]:
        given, width = Row(*self.given), len(self.given)
        stored = self.sent.getValue(place) if sent else None
        last = stored[0] if stored else None
        before = last
        row, due = None, False
        for row in rows:
            t, gap = row[self.clock], row[self.gap]
            due = gap <= 0 or t is not None and (last is None or t >= last + gap)
            if due:
                last = last if gap <= 0 else t
                yield given(*row[:width])
        keep = self.keep and row[self.keep]
        if self.shown and keep and not due:
            yield Row(**{**given(*row[:width]).asDict(), self.shown: False})
        if last != before:
            self.sent.updateValue(place, (last,))
        if keep:
            self._keep_newest(place, row, kept)

    def _keep_newest(self, place: tuple, row: Row, kept: bool) -> None:
        held = self.newest.getValue(place) if kept else None
        if held:
            stored = Row(*self.schema.names)(*held)
            shown = Row(*self.schema.names)(*[row[c] for c in self.schema.names])
            if list(_in_order([stored, shown], self.order))[-1] is stored:
                return
        self.newest.updateValue(place, tuple(row[c] for c in self.schema.names))


def throttle_stream(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    interval_s: int | Column,
    *,
    clock: str = "event",
    keep_latest: Column | None = None,
    ttl_ms: int | None = None,
    initial: DataFrame | None = None,
    newest: str | None = None,
) -> DataFrame:
    """Stream form of the throttle.

    ``clock="event"`` measures the interval on the rows' own time, which gives the batch
    result for rows arriving in time order; ``"processing"`` measures it on the time of
    the micro-batch. Where ``keep_latest`` is true, the state keeps the latest row of the
    key; ``read_state`` shows it as ``STATE_LATEST``. ``initial`` has the keys and the last
    emission (``last``, epoch ms) that a new checkpoint starts from. ``newest`` names a column
    to add: true for the rows let through, false for a key's newest kept row that is not.
    """
    if isinstance(interval_s, int) and interval_s == 0 and keep_latest is None:
        return df
    if clock not in ("event", "processing"):
        raise ValueError(f"unknown clock {clock!r}")
    gap = F.lit(interval_s) if isinstance(interval_s, int) else interval_s
    timed = df.withColumn("_gap", gap.cast("long") * 1000)
    measured, keep = order[0], None
    if clock == "processing":
        measured = "_clock"
        timed = timed.withColumn(measured, F.unix_millis(F.current_timestamp()))
    if keep_latest is not None:
        keep = "_keep"
        timed = timed.withColumn(keep, keep_latest)
    if newest is not None:
        timed = timed.withColumn(newest, F.lit(True))
    kinds = _fields(df.schema, keys)
    emitted = _bucketed(timed, keys).groupBy(_BUCKET).transformWithState(
        Throttle(
            kinds, list(order), measured, "_gap", keep, df.schema, timed.columns, ttl_ms, newest
        ),
        timed.schema,
        "append",
        "ProcessingTime" if ttl_ms else "None",
        _grouped(initial, kinds, ["last"]),
    )
    return emitted.select(*df.columns, *([newest] if newest else []))


def read_state(
    spark: SparkSession, checkpoint: str, variable: str, operator_id: int = 0
) -> DataFrame:
    """State of a stream as a table: the key columns and the state fields.

    In a chain of stateful operators the last one has number 0.
    """
    raw = (
        spark.read.format("statestore")
        .option("operatorId", operator_id)
        .option("stateVarName", variable)
        .load(checkpoint)
    )
    value = raw.schema["user_map_value"].dataType.names
    keys = [k for k in raw.schema["user_map_key"].dataType.names if k not in value]
    return raw.select(*[f"user_map_key.{k}" for k in keys], "user_map_value.*")
