"""What a run did: rows read, accepted and rejected by batch, without a pass of their own.

The counts are observed while a batch is written, and come with the progress that Spark reports of it.
"""

from __future__ import annotations

import threading
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.listener import StreamingQueryListener

from feedloom.operators.parse import REJECT_REASON

_COUNTS = "feedloom_rows"


@dataclass(frozen=True)
class BatchCounts:
    """Of one batch: rows that came out of the parse, and how many of them were rejected."""

    batch: int
    read: int
    rejected: int

    @property
    def accepted(self) -> int:
        return self.read - self.rejected


def counted(rows: DataFrame) -> DataFrame:
    """The same rows; Spark counts them as they pass."""
    reason = F.col(REJECT_REASON) if REJECT_REASON in rows.columns else F.lit(None)
    return rows.observe(_COUNTS, F.count(F.lit(1)).alias("read"), F.count(reason).alias("rejected"))


def _counts(progress) -> BatchCounts | None:
    found = (progress.observedMetrics or {}).get(_COUNTS)
    if not found:
        return None
    return BatchCounts(progress.batchId, found["read"], found["rejected"])


class Report(StreamingQueryListener):
    """Collects the counts of the batches of one query, the last ``keep`` of them."""

    def __init__(self, name: str, keep: int = 10_000):
        self._name, self._keep = name, keep
        self._batches: dict[int, BatchCounts] = {}
        self._lock = threading.Lock()

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        if event.progress.name == self._name:
            self._take(event.progress)

    def _take(self, progress) -> None:
        found = _counts(progress)
        if found is None:
            return
        with self._lock:
            # A batch without rows may be reported again when the query idles.
            if found.read or found.batch not in self._batches:
                self._batches[found.batch] = found
            while len(self._batches) > self._keep:
                del self._batches[min(self._batches)]

    def add(self, query: StreamingQuery) -> None:
        """Take what a query that has ended tells itself; events may come later than its end."""
        for progress in query.recentProgress:
            self._take(progress)

    @property
    def batches(self) -> list[BatchCounts]:
        with self._lock:
            return [self._batches[n] for n in sorted(self._batches)]
