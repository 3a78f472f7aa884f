"""Consuming a change log: records with the columns of their new image."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

from shardstream.functions.payload import Attribute
from shardstream.sources.changes import decode_new_image, metrics_listener
from shardstream.sources.options import SourceOptions
from shardstream.streaming.consumer import Process, read_records, start_consumer


def start_changes(
    spark: SparkSession,
    log: str,
    job: str,
    attributes: Mapping[str, tuple[Attribute, str, str]],
    process: Process,
    listener: StreamingQueryListener | None = None,
    on_progress: Callable[[object], None] | None = None,
    options: SourceOptions | None = None,
    status: Callable[[], DataFrame] | None = None,
    with_envelope: bool = False,
    once: bool = False,
    in_order: bool = True,
) -> StreamingQuery:
    """Run ``process`` on the decoded changes of a log and commit what it handled.

    Reports go either to a ``listener``, which stays with the session, or to ``on_progress``, which hears this query
    alone, until it ends; exactly one of them must be given. Other arguments are those of ``start_consumer``.
    """
    reports = metrics_listener(listener, on_progress, one_query=True)
    changes = decode_new_image(read_records(spark, log, job, options), attributes)
    streams = changes.sparkSession.streams
    streams.addListener(reports)
    try:
        query = start_consumer(changes, process, job, options, status, with_envelope, once, in_order, log)
    except BaseException:
        streams.removeListener(reports)
        raise
    if on_progress is not None:
        reports.follow(query.id, lambda: streams.removeListener(reports))
    return query
