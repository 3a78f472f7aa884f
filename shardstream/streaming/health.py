"""Watching a running query: is it alive, how did it end, how fast is it."""

from __future__ import annotations

import threading

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

CHECK_PERIOD_S = 1.0


class UnexpectedStop(RuntimeError):
    """A query that was still wanted has stopped."""


def check_running(query: StreamingQuery) -> None:
    """Fail with the query's own error, or with UnexpectedStop, if it no longer runs."""
    if query.isActive:
        return
    error = query.exception()
    raise error if error is not None else UnexpectedStop(f"query {query.name or query.id} is no longer running")


def watch(query: StreamingQuery, wanted: threading.Event, period_s: float = CHECK_PERIOD_S) -> None:
    """Check the query each period while ``wanted`` is set; stop it when that is cleared."""
    while wanted.is_set():
        if query.awaitTermination(period_s):
            check_running(query)
    query.stop()


class Endings(StreamingQueryListener):
    """Collects how queries ended: query id to error text, None for a clean stop."""

    def __init__(self):
        self.by_query: dict[str, str | None] = {}

    def onQueryStarted(self, event):
        pass

    def onQueryProgress(self, event):
        pass

    def onQueryIdle(self, event):
        pass

    def onQueryTerminated(self, event):
        self.by_query[str(event.id)] = event.exception


def throughput(spark: SparkSession, query: StreamingQuery) -> DataFrame:
    """The recent micro-batches of a query that read rows: count and rates."""
    rows = [
        (p["batchId"], p["numInputRows"], float(p["processedRowsPerSecond"]))
        for p in query.recentProgress
        if p["numInputRows"]
    ]
    return spark.createDataFrame(rows, "batch_id bigint, input_rows bigint, rows_per_second double")
