"""Progress of a streaming query as log rows."""

from __future__ import annotations

import threading
from collections import Counter, defaultdict

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

from reviewflow.schema import SILVER_LOG_SCHEMA

DURATIONS = ["addBatch", "getBatch", "queryPlanning", "triggerExecution"]


class ProgressLog(StreamingQueryListener):
    """Writes one record per progress event: rates, input rows, durations.

    ``query`` limits the log to the streaming query of that name.
    """

    def __init__(self, spark: SparkSession, path: str, query: str | None = None):
        super().__init__()
        self._spark, self._path, self._query = spark, path, query
        self._written = threading.Semaphore(0)

    def wait(self, records: int, seconds: float = 120.0) -> bool:
        """Block until ``records`` progress records are on disk."""
        return all(self._written.acquire(timeout=seconds) for _ in range(records))

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        progress = event.progress
        if self._query is not None and progress.name != self._query:
            return
        durations = {name: int(ms) for name, ms in (progress.durationMs or {}).items()}
        entry = (
            progress.timestamp,
            progress.batchId,
            (progress.inputRowsPerSecond, progress.processedRowsPerSecond, progress.numInputRows, durations),
            tuple(durations.get(name, 0) for name in DURATIONS),
        )
        record = self._spark.createDataFrame([entry], SILVER_LOG_SCHEMA).coalesce(1)
        stamp = progress.timestamp.replace(":", "-")
        record.write.mode("overwrite").json(f"{self._path}/run={progress.runId}/at={stamp}-{progress.batchId}")
        self._written.release()

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        pass


class DroppedRows(StreamingQueryListener):
    """Adds up the rows that watermarks dropped, over all batches of each run; a query itself remembers its last 100."""

    def __init__(self):
        super().__init__()
        self._dropped: Counter[str] = Counter()
        self._ended: defaultdict[str, threading.Event] = defaultdict(threading.Event)

    def of(self, query: StreamingQuery, seconds: float = 60.0) -> int:
        """Rows dropped by a run that has ended; its events come in order, so all its batches were counted by then."""
        run = str(query.runId)
        if not self._ended[run].wait(seconds):
            raise TimeoutError(f"no end of run {run} within {seconds} seconds")
        return self._dropped[run]

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        states = event.progress.stateOperators
        self._dropped[str(event.progress.runId)] += sum(state.numRowsDroppedByWatermark for state in states)

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        self._ended[str(event.runId)].set()


def read_progress(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(SILVER_LOG_SCHEMA).option("recursiveFileLookup", True).json(path)
