"""Change logs: records whose payload is a table change with its new image."""

from __future__ import annotations

import threading
from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQueryListener

from shardstream.functions.payload import (
    Attribute,
    change_record,
    change_variant,
    image_columns,
    image_value,
    is_plain,
)
from shardstream.sources.log import read_log, stream_log


def decode_new_image(records: DataFrame, attributes: Mapping[str, tuple[Attribute, str, str]]) -> DataFrame:
    """Add columns taken from the new image: ``{column: (attribute, kind, type)}``.

    A payload that is no change record, or an image without the attribute, gives null. Numbers and strings of the
    image itself are read by themselves; any other kind, or a way into maps and lists, is read as ``decode_image`` does.
    """
    if not all(is_plain(attribute, kind) for attribute, kind, _ in attributes.values()):
        return decode_image(records, attributes)
    decoded = records.withColumn("_change", change_record(F.col("data")))
    return decoded.select(*records.columns, *image_columns(F.col("_change"), attributes))


def decode_image(
    records: DataFrame, attributes: Mapping[str, tuple[Attribute, str, str]], image: str = "NewImage"
) -> DataFrame:
    """Add columns of any kind taken from an image, ``NewImage``, ``OldImage`` or ``Keys``: ``{column: (attribute, kind, type)}``.

    Every payload is parsed once, whatever its nesting; see ``image_value`` for kinds and attributes.
    """
    decoded = records.withColumn("_change", change_variant(F.col("data")))
    values = [image_value(F.col("_change"), *given, image=image).alias(c) for c, given in attributes.items()]
    return decoded.select(*records.columns, *values)


def metrics_listener(
    listener: StreamingQueryListener | None, on_progress: Callable[[object], None] | None, one_query: bool = False
) -> StreamingQueryListener:
    """The listener to report through. Exactly one of the two ways must be chosen.

    ``on_progress`` hears all queries of the session, or with ``one_query`` the one that ``follow`` names later.
    """
    if (listener is None) == (on_progress is None):
        raise ValueError("choose either a listener or an on_progress function")
    return listener if listener is not None else _ProgressCalls(on_progress, one_query)


def read_changes(
    spark: SparkSession, log: str, attributes: Mapping[str, tuple[Attribute, str, str]], stream: bool = False
) -> DataFrame:
    """A change log with its image columns, as a table or as a stream."""
    return decode_new_image(stream_log(spark, log) if stream else read_log(spark, log), attributes)


class _ProgressCalls(StreamingQueryListener):
    """Passes on the progress of all queries, or of one. What comes before that is known is kept until it is."""

    def __init__(self, on_progress, one_query):
        self._on_progress, self._one_query = on_progress, one_query
        self._query, self._done, self._early, self._ended = None, None, [], set()
        self._lock = threading.Lock()

    def follow(self, query_id, done):
        with self._lock:
            self._query, self._done = str(query_id), done
            early, self._early = self._early, []
        for progress in early:
            self._pass_on(progress)
        if self._query in self._ended:
            done()

    def _pass_on(self, progress):
        if not self._one_query or str(progress.id) == self._query:
            self._on_progress(progress)

    def onQueryStarted(self, event):
        pass

    def onQueryProgress(self, event):
        with self._lock:
            if self._one_query and self._query is None:
                self._early.append(event.progress)
                return
        self._pass_on(event.progress)

    def onQueryIdle(self, event):
        pass

    def onQueryTerminated(self, event):
        with self._lock:
            self._ended.add(str(event.id))
            mine = str(event.id) == self._query
        if mine:
            threading.Thread(target=self._done, daemon=True).start()  # not from within a call of the listener
