"""Event-time windows per key with late rows set aside (2.9).

Spark's own windowed aggregation drops a row whose window is closed without a trace. Here one
stateful operator keeps the open windows of each key, gives a window's row when the watermark
passes its end, and gives late rows as rows of their own, so a second sink can take them.

The rows of a key come in Arrow batches and are summed per window before the state is touched,
so the state is read and written once per open window and batch, not once per row.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

WINDOW, LATE = "window", "late"
_AT = "_at_ms"


@dataclass(frozen=True)
class WindowSpec:
    """Windows of ``size_ms`` that start every ``slide_ms``; or sessions that end by ``gap_ms``.

    A row belongs to each window that holds its time. A session is a run of rows of a key of
    which none is ``gap_ms`` or more after the one before it; it ends ``gap_ms`` after its last.
    """

    size_ms: int = 0
    slide_ms: int = 0
    gap_ms: int = 0

    def __post_init__(self):
        if (self.size_ms > 0) == (self.gap_ms > 0) or self.slide_ms > self.size_ms:
            raise ValueError("name a size, with a slide not above it, or a gap")

    def places(self, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Row number and window start of every pair of a row and a window of it."""
        slide = self.slide_ms or self.size_ms
        last = at // slide * slide
        rows, starts = [], []
        for back in range(-(-self.size_ms // slide)):
            start = last - back * slide
            holds = np.flatnonzero(start + self.size_ms > at)
            rows.append(holds)
            starts.append(start[holds])
        return np.concatenate(rows), np.concatenate(starts)


class _Windows(StatefulProcessor):
    """Open windows: start -> last time or end, number of rows, sums of the values."""

    def __init__(self, spec: WindowSpec, keys: Sequence[str], values: Sequence[str]):
        self.spec, self.keys, self.values = spec, list(keys), list(values)

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        sums = "".join(f", s{i} double" for i in range(len(self.values)))
        self.open = handle.getMapState("open", "start long", f"last long, n long{sums}")

    def _rows(self, key, kind: str, rows: list[tuple]) -> pd.DataFrame:
        """Output rows from (start, end, time, n, sums)."""
        out = pd.DataFrame(rows, columns=["start_ms", "end_ms", "time_ms", "n", *self.values])
        for name, part in reversed(list(zip(self.keys, key, strict=True))):
            out.insert(0, name, part)
        out.insert(0, "kind", kind)
        return out.astype({"time_ms": "Int64"})

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        passed = timerValues.getCurrentWatermarkInMs()
        if self.spec.gap_ms:
            # Sessions that the watermark has passed are closed to the rows of this batch.
            yield from self._closed(key, passed)
        sums: dict[int, tuple[int, np.ndarray]] = {}
        for part in rows:
            # By place: Spark renames columns whose names are no names in Python.
            at = part.iloc[:, len(self.keys)].to_numpy(dtype=np.int64)
            values = part.iloc[:, len(self.keys) + 1 :].to_numpy(dtype=float)
            if self.spec.gap_ms:
                late = self._sessions(at, values, passed)
            else:
                late = self._windows(at, values, passed, sums)
            if late:
                yield self._rows(key, LATE, late)
        for start, (n, total) in sums.items():
            self._add(start, start + self.spec.size_ms, n, total)

    def _windows(
        self, at: np.ndarray, values: np.ndarray, passed: int, sums: dict
    ) -> list[tuple]:
        """Late rows; adds the others to ``sums``, so that the state is touched once per window."""
        row, start = self.spec.places(at)
        closed = start + self.spec.size_ms <= passed
        for first in np.unique(start[~closed]).tolist():
            mine = row[~closed & (start == first)]
            n, total = sums.get(first, (0, 0.0))
            sums[first] = n + len(mine), total + values[mine].sum(axis=0)
        return [
            (s, s + self.spec.size_ms, int(at[r]), 1, *values[r])
            for r, s in zip(row[closed].tolist(), start[closed].tolist(), strict=True)
        ]

    def _add(self, start: int, last: int, n: int, sums: np.ndarray) -> None:
        if self.open.containsKey((start,)):
            held = self.open.getValue((start,))
            n, sums = n + held[1], sums + np.array(held[2:], dtype=float)
        else:
            self.handle.registerTimer(last)
        self.open.updateValue((start,), (last, n, *sums.tolist()))

    def _sessions(self, at: np.ndarray, values: np.ndarray, passed: int) -> list[tuple]:
        gap = self.spec.gap_ms
        held = {k[0]: tuple(v) for k, v in self.open.iterator()}
        # Runs of the batch's rows that join an open session or may still open one.
        order = np.argsort(at, kind="stable")
        cuts = np.flatnonzero(np.diff(at[order]) >= gap) + 1
        late = []
        for run in np.split(order, cuts):
            if not len(run):
                continue
            low, high = int(at[run[0]]), int(at[run[-1]])
            near = [s for s, v in held.items() if s < high + gap and low < v[0] + gap]
            if not near and high + gap <= passed:
                late += [(int(at[r]), int(at[r]) + gap, int(at[r]), 1, *values[r]) for r in run]
                continue
            start, last = min([low, *near]), max([high, *(held[s][0] for s in near)])
            n = len(run) + sum(held[s][1] for s in near)
            sums = values[run].sum(axis=0)
            for s in near:
                sums = sums + np.array(held[s][2:], dtype=float)
                del held[s]
                self.open.removeKey((s,))
            held[start] = (last, n, *sums.tolist())
            self.open.updateValue((start,), held[start])
            self.handle.registerTimer(last + gap)
        return late

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        # A timer of a session that went on finds nothing that ends at its time.
        yield from self._closed(key, expiredTimerInfo.getExpiryTimeInMs())

    def _closed(self, key, now: int) -> Iterator[pd.DataFrame]:
        gap = self.spec.gap_ms
        done = [(k[0], tuple(v)) for k, v in self.open.iterator() if v[0] + gap <= now]
        for start, _ in done:
            self.open.removeKey((start,))
        if done:
            yield self._rows(key, WINDOW, [(s, v[0] + gap, None, *v[1:]) for s, v in sorted(done)])


def windowed(
    df: DataFrame,
    keys: Sequence[str],
    time: str,
    spec: WindowSpec,
    sums: Sequence[str] = (),
    *,
    delay_ms: int,
) -> DataFrame:
    """Closed windows and late rows of a stream with epoch milliseconds in ``time``.

    Columns: kind (``window`` or ``late``), the keys, start_ms, end_ms, time_ms, n and the
    ``sums`` as doubles. The watermark is the greatest time of earlier batches less ``delay_ms``;
    a window closes when it reaches the window's end. A ``late`` row names a window that was
    closed when the row came, with the row's time, n = 1 and its values. Rows without a time are
    left out, null values count as 0.
    """
    timed = (
        df.filter(F.col(time).isNotNull())
        .withColumn("_event_time", F.timestamp_millis(F.col(time)))
        .withWatermark("_event_time", f"{delay_ms} milliseconds")
        # Without the marked column the operator sees late rows instead of Spark dropping them.
        .select(
            *keys,
            F.col(time).cast("long").alias(_AT),
            *[F.coalesce(F.col(c).cast("double"), F.lit(0.0)).alias(c) for c in sums],
        )
    )
    kinds = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    schema = ", ".join(
        [
            "kind string",
            *[f"`{k}` {kinds[k]}" for k in keys],
            "start_ms long, end_ms long, time_ms long, n long",
            *[f"`{c}` double" for c in sums],
        ]
    )
    return timed.groupBy(*keys).transformWithStateInPandas(
        _Windows(spec, keys, sums), schema, "append", "EventTime"
    )


def table_windows(
    df: DataFrame, keys: Sequence[str], time: str, spec: WindowSpec, sums: Sequence[str] = ()
) -> DataFrame:
    """The windows of a table's rows, all closed and none late, with the columns of ``windowed``."""
    at = F.col(time).cast("long")
    rows = df.filter(F.col(time).isNotNull()).select(
        *keys, at.alias(_AT), *[F.coalesce(F.col(c).cast("double"), F.lit(0.0)).alias(c) for c in sums]
    )
    total = [F.count("*").alias("n"), *[F.sum(c).alias(c) for c in sums]]
    if spec.gap_ms:
        from pyspark.sql.window import Window

        order = Window.partitionBy(*keys).orderBy(_AT)
        opens = F.col(_AT) - F.lag(_AT).over(order) >= spec.gap_ms
        numbered = rows.withColumn("_opens", F.coalesce(opens, F.lit(True)).cast("int")).withColumn(
            "_session", F.sum("_opens").over(order.rowsBetween(Window.unboundedPreceding, 0))
        )
        found = numbered.groupBy(*keys, "_session").agg(
            F.min(_AT).alias("start_ms"), (F.max(_AT) + spec.gap_ms).alias("end_ms"), *total
        )
    else:
        slide = spec.slide_ms or spec.size_ms
        last = F.col(_AT) - F.pmod(F.col(_AT), F.lit(slide))
        starts = F.array(*[last - back * slide for back in range(-(-spec.size_ms // slide))])
        found = (
            rows.withColumn("start_ms", F.explode(starts))
            .filter(F.col("start_ms") + spec.size_ms > F.col(_AT))
            .groupBy(*keys, "start_ms")
            .agg(*total)
            .withColumn("end_ms", F.col("start_ms") + spec.size_ms)
        )
    return found.select(
        F.lit(WINDOW).alias("kind"), *keys, "start_ms", "end_ms",
        F.lit(None).cast("long").alias("time_ms"), "n", *sums,
    )
