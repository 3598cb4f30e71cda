"""Streams on a clock: progress kept as rows, and an end once nothing more comes."""

from __future__ import annotations

import threading
import time
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.listener import StreamingQueryListener

SCHEMA = (
    "query STRING, run_id STRING, batch_id BIGINT, started STRING, input_rows BIGINT, "
    "batch_ms BIGINT, state_rows BIGINT, watermark STRING"
)


class ProgressLog(StreamingQueryListener):
    """Keeps the progress of the named queries and appends it to a folder.

    Progress arrives on Spark's listener thread; rows are held until ``flush``
    writes them, so that no job is started from there.
    """

    def __init__(self, spark: SparkSession, path: str, names: Sequence[str] | None = None):
        self.spark = spark
        self.path = path
        self.names = None if names is None else set(names)
        self._lock = threading.Lock()
        self._rows: list[tuple] = []
        self._last_rows: dict[str, float] = {}
        self._ended: dict[str, str | None] = {}

    def onQueryStarted(self, event) -> None:
        with self._lock:
            self._last_rows[str(event.runId)] = time.monotonic()

    def onQueryProgress(self, event) -> None:
        p = event.progress
        if self.names is not None and p.name not in self.names:
            return
        row = (
            p.name,
            str(p.runId),
            p.batchId,
            p.timestamp,
            p.numInputRows,
            p.batchDuration,
            sum(s.numRowsTotal for s in p.stateOperators),
            dict(p.eventTime).get("watermark"),
        )
        with self._lock:
            if p.numInputRows:
                self._last_rows[str(p.runId)] = time.monotonic()
            self._rows.append(row)

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        with self._lock:
            self._ended[str(event.runId)] = event.exception

    def idle_for(self, query: StreamingQuery) -> float:
        """Seconds since the query last took in rows, or was first seen."""
        with self._lock:
            return time.monotonic() - self._last_rows.setdefault(str(query.runId), time.monotonic())

    def ended(self, query: StreamingQuery) -> bool:
        with self._lock:
            return str(query.runId) in self._ended

    def flush(self) -> int:
        """Append what has come since the last time; returns the number of rows."""
        with self._lock:
            rows, self._rows = self._rows, []
        if rows:
            self.spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").json(self.path)
        return len(rows)

    def entries(self) -> DataFrame:
        return self.spark.read.schema(SCHEMA).json(self.path)


def run_until_idle(
    query: StreamingQuery, log: ProgressLog, idle_seconds: float, most_seconds: float | None = None
) -> None:
    """Let a timed query run until it has had no input for ``idle_seconds``, then stop it.

    A batch under way is finished first: the query is stopped only between
    batches.  A query that fails raises here.  After ``most_seconds`` it is
    stopped in any case.
    """
    start = time.monotonic()
    while query.isActive:
        late = most_seconds is not None and time.monotonic() - start > most_seconds
        status = query.status
        if late or (log.idle_for(query) >= idle_seconds and not status["isTriggerActive"] and not status["isDataAvailable"]):
            query.stop()
            break
        # Wakes up at once if the query fails.
        query.awaitTermination(min(0.2, idle_seconds))
    failed = query.exception()
    if failed is not None:
        raise failed
    # The last progress may still be on its way through the listener.
    for _ in range(100):
        if log.ended(query):
            break
        time.sleep(0.05)
    log.flush()
