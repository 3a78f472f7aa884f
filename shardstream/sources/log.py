"""The record log as parquet: one folder per appended slice, read as a table or as a stream."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession

from shardstream.model import RECORD, RECORD_COLUMNS, TRIM_HORIZON
from shardstream.sources.folders import batch_folder, is_complete, publish
from shardstream.sources.index import index_slice, read_from, with_payload_bytes

# Where slices are written before they are part of the log; readers pass over names with an underscore.
STAGING = "_staging"


def append_slice(records: DataFrame, log: str, batch_id: int, in_order: bool = False) -> bool:
    """Append records as slice ``batch_id``; False when that slice is already complete.

    A slice that is complete is left alone, so that a replayed batch gives readers nothing twice. A
    slice is written aside and then moved into the log, so that readers see all of it or nothing on
    file systems that rename in one step. Append slices in the order their records arrived.

    With ``in_order`` the files of a slice follow each other by shard and sequence. A large shard is cut into ranges, so
    that it is written by many tasks. What the index says of the slice is there before the slice is.
    """
    spark, target = records.sparkSession, batch_folder(log, batch_id)
    if is_complete(spark, target):
        return False
    if in_order:
        records = in_shard_order(records)
    staged = batch_folder(f"{log.rstrip('/')}/{STAGING}", batch_id)
    with_payload_bytes(records).write.mode("overwrite").parquet(staged)
    index_slice(spark, log, staged, batch_id)
    publish(spark, staged, target)
    return True


def in_shard_order(records: DataFrame) -> DataFrame:
    """Records by shard and sequence, over partitions that follow each other; a hot shard is several partitions."""
    return records.repartitionByRange("shard_id", "sequence_number").sortWithinPartitions("shard_id", "sequence_number")


def read_log(spark: SparkSession, log: str) -> DataFrame:
    """All records of a log."""
    return spark.read.schema(RECORD).parquet(log).select(*RECORD_COLUMNS)


def read_after(spark: SparkSession, log: str, progress: DataFrame) -> DataFrame:
    """Records after each shard's progress; a shard without any starts at its first record.

    Slices that every shard is done with are not opened, as the log's index shows them.
    """
    return read_from(spark, log, TRIM_HORIZON, progress=progress.select("shard_id", "sequence_number"))


def stream_log(spark: SparkSession, log: str, only: Column | None = None, **options: str) -> DataFrame:
    """A log as a stream. ``maxFilesPerTrigger`` or ``maxBytesPerTrigger`` bound a micro-batch.

    ``only`` is a condition on ``batch_id``: files of other slices are listed, but not opened.
    """
    # The folder of a slice is a column too; a stream that starts before there is any must know it.
    reader = spark.readStream.schema(f"{RECORD}, batch_id bigint")
    for name, value in options.items():
        reader = reader.option(name, value)
    records = reader.parquet(log)
    return (records if only is None else records.where(only)).select(*RECORD_COLUMNS)


def stream_folder(records: DataFrame) -> str | None:
    """The folder that a stream of files reads, as its plan names it; None for other streams."""
    leaves = records._jdf.queryExecution().analyzed().collectLeaves()
    for k in range(leaves.size()):
        leaf = leaves.apply(k)
        if leaf.getClass().getSimpleName() == "StreamingRelation":
            path = leaf.dataSource().options().get("path")
            return path.get() if path.isDefined() else None
    return None
