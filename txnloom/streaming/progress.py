"""What running queries report of each micro-batch, and what their sources still hold."""

from __future__ import annotations

import json
import threading
import time
from collections import deque
from dataclasses import dataclass

from pyspark import SparkContext
from pyspark.sql import SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener
from pyspark.sql.streaming.listener import (
    JStreamingQueryListener,
    QueryIdleEvent,
    QueryProgressEvent,
    QueryStartedEvent,
    QueryTerminatedEvent,
)

from ..session import input_files


def files_behind(spark: SparkSession, folder: str, checkpoint: str) -> int:
    """How many files of ``folder`` the stream with this checkpoint has not yet taken.

    The file source lists in its checkpoint what each micro-batch took.
    """
    log = spark.read.text(f"{checkpoint}/sources/0")
    path = F.get_json_object("value", "$.path")
    taken = log.select(path.alias("path")).where("path is not null").distinct().count()
    return len(input_files(spark, folder)) - taken


@dataclass(frozen=True)
class BatchReport:
    """One micro-batch: its rows, its seconds, and what a topic still held after it, if known."""

    run_id: str
    batch_id: int
    rows: int
    seconds: float
    backlog: dict[str, float]


class _AsText(JStreamingQueryListener):
    """Takes a report from the JVM as one text.

    Field by field it is some hundred calls, slower than short micro-batches of many streams
    come in, and Spark drops the events that wait too long.
    """

    def onQueryProgress(self, jevent) -> None:
        self.pylistener.keep(jevent.progress().json())


class Backlog(StreamingQueryListener):
    """Keeps the last ``most`` reports, or all with None; add it with ``spark.streams.addListener``.

    Topics report how many records they are ahead; for folders ask ``files_behind``. A
    backlog that grows from report to report means that the pace is too low.
    """

    def __init__(self, most: int | None = 10_000):
        self.reports: deque[BatchReport] = deque(maxlen=most)
        self._ended: dict[str, threading.Event] = {}
        self._heard: dict[str, float] = {}
        self._newest: dict[str, int] = {}
        self._lost: set[str] = set()

    @property
    def _jlistener(self):
        if not hasattr(self, "_jlistenerobj"):
            wrapper = SparkContext._jvm.PythonStreamingQueryListenerWrapper
            self._jlistenerobj = wrapper(_AsText(self))
        return self._jlistenerobj

    def _end(self, run_id: str) -> threading.Event:
        return self._ended.setdefault(run_id, threading.Event())

    def onQueryStarted(self, event: QueryStartedEvent) -> None:
        self._end(str(event.runId))

    def onQueryProgress(self, event: QueryProgressEvent) -> None:
        self.keep(event.progress.json)

    def keep(self, text: str) -> None:
        """Keep a report, given as JSON."""
        progress = json.loads(text)
        left: dict[str, float] = {}
        for source in progress["sources"]:
            for name, value in (source.get("metrics") or {}).items():
                if "OffsetsBehindLatest" in name:
                    left[name] = left.get(name, 0.0) + float(value)
        run_id, batch_id = progress["runId"], progress["batchId"]
        if batch_id > self._newest.get(run_id, batch_id) + 1:
            self._lost.add(run_id)
        self._newest[run_id] = batch_id
        self._heard[run_id] = time.monotonic()
        self.reports.append(
            BatchReport(
                run_id, batch_id, progress["numInputRows"], progress["batchDuration"] / 1000, left
            )
        )

    def onQueryIdle(self, event: QueryIdleEvent) -> None:
        pass

    def onQueryTerminated(self, event: QueryTerminatedEvent) -> None:
        self._end(str(event.runId)).set()

    def of(self, query: StreamingQuery, timeout: float = 60.0) -> list[BatchReport]:
        """The reports of a query that has ended, all of them: events come a little later.

        It waits up to ``timeout`` seconds for each next one.
        """
        run_id = str(query.runId)
        while not self._end(run_id).wait(timeout):
            silent = time.monotonic() - self._heard.get(run_id, float("-inf"))
            if query.isActive or silent > timeout:
                raise TimeoutError("the query has not ended")
        last = query.lastProgress
        if last is not None and run_id in self._newest:
            # an idle trigger shows the number of the batch that would come next
            if self._newest[run_id] < last.batchId - (last.numInputRows == 0):
                self._lost.add(run_id)
        if run_id in self._lost:
            raise RuntimeError("reports of the query were lost on their way from Spark")
        reports = list(self.reports)  # those of other queries may still come in
        return [report for report in reports if report.run_id == run_id]
