"""Descriptions of a pipeline's parts; plain lists instead of comma-separated text."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field


@dataclass(frozen=True)
class SourceSpec:
    """Where lines come from.

    ``kind`` is ``kafka`` (``topics``, ``brokers``, optional ``group``, ``offsets``,
    ``payload``) or ``text`` (``path``).
    """

    kind: str
    path: str | None = None
    topics: Sequence[str] = ()
    brokers: str | None = None
    group: str | None = None
    min_partitions: int | None = None
    # topic -> partition -> first offset
    offsets: Mapping[str, Mapping[int, int]] | None = None
    payload: str = "value"
    options: Mapping[str, str] = field(default_factory=dict)


@dataclass(frozen=True)
class SinkSpec:
    """Where an event's messages go.

    ``kind`` is ``kafka`` (``topic``, ``brokers``), ``jdbc`` (``url``, ``table``) or
    ``parquet`` (``path``). A stream that repeats a micro-batch after a failure sends it
    again. With ``by_batch`` the rows carry ``batch_id``: in a parquet sink the repeated batch
    replaces its first try, in a table the column tells them apart. Kafka gets them twice.
    """

    kind: str
    topic: str | None = None
    brokers: str | None = None
    url: str | None = None
    table: str | None = None
    path: str | None = None
    delim: str = ","
    partitions: int | None = None
    options: Mapping[str, str] = field(default_factory=dict)
    by_batch: bool = False
    mode: str = "append"


@dataclass(frozen=True)
class EventSpec:
    """A filter, a projection and a throttle over enriched rows.

    With ``keep_latest`` the latest row of each key is kept, sent or not: in a stream's state,
    and in a table below ``latest_path`` if that is given.
    """

    id: str
    condition: str
    select: Sequence[str | tuple[str, str]]
    ext: Sequence[tuple[str, str]] = ()
    interval_s: int = 0
    keep_latest: bool = False
    latest_path: str | None = None
    sinks: Sequence[SinkSpec] = ()


@dataclass(frozen=True)
class InterfaceSpec:
    """Input record: fields, key, time, derived columns and row filter.

    ``time`` and ``order`` name columns; the time is in epoch ms after ``derived``, and
    ``order`` breaks ties between rows of the same time. ``regex`` says that ``delim`` is a
    regular expression.
    """

    fields: Sequence[str | Mapping[str, str]]
    keys: Sequence[str]
    time: str
    order: Sequence[str] = ()
    delim: str = ","
    regex: bool = False
    derived: Sequence[tuple[str, str]] = ()
    condition: str | None = None
    typed: bool = False
