"""Batch progress of streaming queries as rows."""

from __future__ import annotations

import json
import queue
import threading
import time
from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQueryListener

from wayfare.operators.metrics import batch_progress
from wayfare.schemas import PROGRESS


def progress_rows(spark: SparkSession, reports: Iterable[str]) -> DataFrame:
    """Progress reports given as JSON text."""
    lines = spark.createDataFrame([(r,) for r in reports], "value string")
    return batch_progress(lines.select(F.inline(F.array(F.from_json("value", PROGRESS)))))


def recent_progress(spark: SparkSession, query) -> DataFrame:
    """The reports a query still holds, a bounded number of them."""
    return progress_rows(spark, [r if isinstance(r, str) else json.dumps(r, default=str)
                                 if isinstance(r, dict) else r.json for r in query.recentProgress])


class ProgressLog(StreamingQueryListener):
    """Appends the reports of all queries of a session to a table, from ``with ProgressLog(spark, path):``.

    Callbacks only put reports into a queue; a thread of its own writes them, ``flush_every`` at a time or after
    ``flush_seconds``. Leaving waits for the last reports of the queries that have ended and writes what is left, so that none is
    lost; a write that failed is raised then. Queries that still run are no longer followed.
    """

    def __init__(self, spark: SparkSession, path: str, flush_every: int = 60, flush_seconds: float = 60.0):
        self.spark, self.path, self.flush_every, self.flush_seconds = spark, path, flush_every, flush_seconds
        self._reports: queue.Queue[str | None] = queue.Queue()
        self._open: set[str] = set()
        self._ended = threading.Condition()
        self._failure: BaseException | None = None
        self._writer = threading.Thread(target=self._write_all, name="progress-log", daemon=True)

    def onQueryStarted(self, event) -> None:  # noqa: N802
        with self._ended:
            self._open.add(str(event.runId))

    def onQueryProgress(self, event) -> None:  # noqa: N802
        self._reports.put(event.progress.json)

    def onQueryIdle(self, event) -> None:  # noqa: N802
        pass

    def onQueryTerminated(self, event) -> None:  # noqa: N802
        # Events of a query come in order: its reports are in the queue by now.
        with self._ended:
            self._open.discard(str(event.runId))
            self._ended.notify_all()

    def _write_all(self) -> None:
        pending: list[str] = []
        due = time.monotonic() + self.flush_seconds
        while True:
            try:
                report = self._reports.get(timeout=max(0.0, due - time.monotonic()))
                if report is not None:
                    pending.append(report)
            except queue.Empty:
                report = ""
            if pending and (report is None or len(pending) >= self.flush_every or time.monotonic() >= due):
                try:
                    progress_rows(self.spark, pending).coalesce(1).write.mode("append").parquet(self.path)
                    pending = []
                except Exception as error:  # noqa: BLE001 - raised when the log is left; the reports are tried again
                    self._failure = error
            if time.monotonic() >= due:
                due = time.monotonic() + self.flush_seconds
            if report is None:
                if not pending:
                    self._failure = None
                return

    def __enter__(self) -> ProgressLog:
        self._writer.start()
        self.spark.streams.addListener(self)
        return self

    def close(self, timeout: float = 60.0) -> None:
        running = {str(q.runId) for q in self.spark.streams.active}
        with self._ended:
            ended = self._ended.wait_for(lambda: self._open <= running, timeout)
        self.spark.streams.removeListener(self)
        self._reports.put(None)
        self._writer.join()
        if self._failure:
            raise self._failure
        if not ended:
            raise TimeoutError("the end of a query was not reported in time")

    def __exit__(self, *error) -> None:
        self.close()
