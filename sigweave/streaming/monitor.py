"""Counts and durations of the stages of a stream."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql.streaming import StreamingQueryListener


class StageMonitor(StreamingQueryListener):
    """Hands observed counts and stage durations of every micro-batch to ``handle``.

    Without one the records gather in ``batches``; a stream that never ends should give one.
    """

    def __init__(self, handle: Callable[[dict], None] | None = None):
        self.batches: list[dict] = []
        self.handle = handle or self.batches.append
        self.failures: list[str] = []

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        progress = event.progress
        self.handle(
            {
                "batch": progress.batchId,
                "rows": progress.numInputRows,
                "durations_ms": dict(progress.durationMs),
                "observed": {
                    name: row.asDict() for name, row in progress.observedMetrics.items()
                },
            }
        )

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        if event.exception:
            self.failures.append(event.exception)
