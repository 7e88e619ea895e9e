"""What a running stream tells: totals over all its batches, kept by a listener beyond the few last ones a query remembers."""

from __future__ import annotations

import threading
from collections.abc import Iterator
from contextlib import contextmanager
from dataclasses import dataclass, field

from pyspark.sql import SparkSession
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener


@dataclass
class Totals:
    """Sums over the batches of one run of a query."""

    batches: int = 0
    rows: int = 0
    late_rows: int = 0
    ended: threading.Event = field(default_factory=threading.Event)


class Audit(StreamingQueryListener):
    """Adds up, per run, the batches that read something, their rows, and the rows that state operators dropped as late.

    A late row reaches an aggregate already combined with the rows of its key in its task, so ``late_rows`` counts such combinations.
    """

    def __init__(self):
        self.runs: dict[str, Totals] = {}

    def of(self, run: object) -> Totals:
        return self.runs.setdefault(str(run), Totals())

    def onQueryStarted(self, event) -> None:
        self.of(event.runId)

    def onQueryProgress(self, event) -> None:
        seen, progress = self.of(event.progress.runId), event.progress
        seen.batches += progress.numInputRows > 0
        seen.rows += progress.numInputRows
        seen.late_rows += sum(s.numRowsDroppedByWatermark for s in progress.stateOperators)

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        self.of(event.runId).ended.set()

    def final(self, query: StreamingQuery, timeout: float = 60) -> Totals:
        """The totals of a run that has ended; events arrive one after the other, its end last."""
        found = self.of(query.runId)
        if not found.ended.wait(timeout):
            raise TimeoutError("the stream's last event has not arrived")
        return found


@contextmanager
def audited(spark: SparkSession) -> Iterator[Audit]:
    """Listens to the session's streams inside the block."""
    audit = Audit()
    spark.streams.addListener(audit)
    try:
        yield audit
    finally:
        spark.streams.removeListener(audit)
