"""Data sources made from a user's functions: a reader per shard, and a put function as a sink.

The functions run on the workers. They must not refer to a session or a DataFrame.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator, Mapping
from dataclasses import dataclass

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import (
    DataSource,
    DataSourceStreamArrowWriter,
    DataSourceStreamReader,
    InputPartition,
    WriterCommitMessage,
)

from shardstream.model import RECORD, RECORD_COLUMNS

Positions = Mapping[str, int]


class ShardRange(InputPartition):
    """Records of one shard after position ``start`` up to and with ``end``."""

    def __init__(self, shard_id: str, start: int, end: int):
        self.shard_id = shard_id
        self.start = start
        self.end = end


class _ShardReader(DataSourceStreamReader):
    def __init__(self, tips, fetch, commit, range_size, options):
        self._tips, self._fetch, self._commit = tips, fetch, commit
        self._range_size, self._options = range_size, options

    def initialOffset(self) -> dict:
        return {}

    def latestOffset(self) -> dict:
        return dict(self._tips(self._options))

    def partitions(self, start: dict, end: dict) -> list[ShardRange]:
        ranges = []
        for shard_id, last in sorted(end.items()):
            first = start.get(shard_id, 0)
            while first < last:
                upto = min(first + self._range_size, last)
                ranges.append(ShardRange(shard_id, first, upto))
                first = upto
        return ranges

    def read(self, partition: ShardRange) -> Iterator[tuple | pa.RecordBatch]:
        yield from self._fetch(self._options, partition.shard_id, partition.start, partition.end)

    def commit(self, end: dict) -> None:
        if self._commit is not None:
            self._commit(self._options, end)


def reader_source(
    name: str,
    tips: Callable[[dict], Positions],
    fetch: Callable[[dict, str, int, int], Iterable[tuple | pa.RecordBatch]],
    commit: Callable[[dict, Positions], None] | None = None,
    schema: str = RECORD,
    range_size: int = 100_000,
) -> type[DataSource]:
    """A streaming source from a user's reader.

    ``tips(options)`` gives the record count of every shard, ``fetch(options, shard, start, end)`` the
    rows after the first ``start`` up to ``end``, as tuples or, better, as Arrow record batches. A long shard is read by several tasks of
    ``range_size`` records. A limit on how much one micro-batch takes belongs into ``tips``.
    ``commit`` is told of a finished batch one batch later and is not a progress table.
    """

    class FunctionReader(DataSource):
        @classmethod
        def name(cls) -> str:
            return name

        def schema(self) -> str:
            return schema

        def streamReader(self, schema):
            return _ShardReader(tips, fetch, commit, range_size, dict(self.options))

    return FunctionReader


def read_custom(
    spark: SparkSession, source: type[DataSource] | str, columns: Iterable[str] = RECORD_COLUMNS, **options: str
) -> DataFrame:
    """Stream from a data source class, or from one registered under a name."""
    if isinstance(source, str):
        name = source
    else:
        spark.dataSource.register(source)
        name = source.name()
    reader = spark.readStream.format(name)
    for key, value in options.items():
        reader = reader.option(key, value)
    return reader.load().select(*columns)


@dataclass
class PutMessage(WriterCommitMessage):
    partition: int
    records: int


class _PutWriter(DataSourceStreamArrowWriter):
    def __init__(self, put, on_commit, on_abort, batch_size, options):
        self._put, self._on_commit, self._on_abort = put, on_commit, on_abort
        self._batch_size, self._options = batch_size, options

    def write(self, iterator) -> PutMessage:
        written = 0
        for batch in iterator:
            for start in range(0, batch.num_rows, self._batch_size):
                part = batch.slice(start, self._batch_size)
                self._put(self._options, pa.table(part))
                written += part.num_rows
        return PutMessage(TaskContext.get().partitionId(), written)

    def commit(self, messages, batchId: int) -> None:
        if self._on_commit is not None:
            self._on_commit(self._options, batchId, sum(m.records for m in messages if m is not None))

    def abort(self, messages, batchId: int) -> None:
        if self._on_abort is not None:
            self._on_abort(self._options, batchId)


def put_sink(
    name: str,
    put: Callable[[dict, pa.Table], None],
    on_commit: Callable[[dict, int, int], None] | None = None,
    on_abort: Callable[[dict, int], None] | None = None,
    batch_size: int = 500,
) -> type[DataSource]:
    """A streaming sink that hands Arrow tables of at most ``batch_size`` rows to ``put(options, rows)``.

    A failed task is run again, so ``put`` may see a row twice. ``on_commit(options, batch_id, rows)``
    is called once all tasks of a micro-batch are done.
    """

    class FunctionSink(DataSource):
        @classmethod
        def name(cls) -> str:
            return name

        def streamWriter(self, schema, overwrite):
            return _PutWriter(put, on_commit, on_abort, batch_size, dict(self.options))

    return FunctionSink
