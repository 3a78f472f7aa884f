"""An index of a log's slices: per slice and shard the rows, bytes, first and last sequence and arrival.

Every slice gets its rows when it is appended. Tips, lag and start positions are read from them instead of the log, and reading
from a position opens the slices alone that hold something after it.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shardstream.model import RECORD, RECORD_COLUMNS
from shardstream.operators.positions import start_reading
from shardstream.session import settle
from shardstream.sources.folders import batch_folder, children, is_complete, publish

#: Where the index is, beside the slices; the log's readers pass over names with an underscore.
INDEX = "_index/slices"
ZONE = (
    "shard_id string, rows bigint, bytes bigint, first_sequence_number string, last_sequence_number string, "
    "first_arrival_ts timestamp, last_arrival_ts timestamp"
)
#: A column of a slice's files beside those of records, so that the index does not read payloads.
PAYLOAD_BYTES = "data_bytes"

# Ranges of slice numbers that a filter spells out; more than these become a list of numbers.
MOST_RANGES = 50


def with_payload_bytes(records: DataFrame) -> DataFrame:
    return records.withColumn(PAYLOAD_BYTES, F.coalesce(F.octet_length("data"), F.lit(0)).cast("bigint"))


def zones(records: DataFrame, *by: str) -> DataFrame:
    """One row per shard: what the index says about these records."""
    return records.groupBy(*by, "shard_id").agg(
        F.count(F.lit(1)).alias("rows"),
        F.sum(PAYLOAD_BYTES).alias("bytes"),
        F.min("sequence_number").alias("first_sequence_number"),
        F.max("sequence_number").alias("last_sequence_number"),
        F.min("arrival_ts").alias("first_arrival_ts"),
        F.max("arrival_ts").alias("last_arrival_ts"),
    )


def index_slice(spark: SparkSession, log: str, written: str, batch_id: int) -> None:
    """Index the complete files in ``written``, which become slice ``batch_id``; the slice itself need not be there yet."""
    records = spark.read.schema(f"{RECORD}, {PAYLOAD_BYTES} bigint").parquet(written)
    staged = batch_folder(f"{log.rstrip('/')}/_staging_index", batch_id)
    zones(records).coalesce(1).write.mode("overwrite").parquet(staged)  # a row for each shard
    publish(spark, staged, batch_folder(f"{log.rstrip('/')}/{INDEX}", batch_id))


def slices(spark: SparkSession, folder: str) -> set[int]:
    """Numbers of the slices in a folder, by their names."""
    names = (n.removeprefix("batch_id=") for n in children(spark, folder) if n.startswith("batch_id="))
    return {int(n) for n in names if n.isdigit()}


def read_index(spark: SparkSession, log: str) -> DataFrame:
    """The index of all slices that are in the log: one row per slice (``batch_id``) and shard.

    A slice without an index, appended by other means, is read for it; ``index_missing`` does so once for all. A log
    that is no folder of slices is one slice without a number.
    """
    there = slices(spark, log)
    if not there:
        if not children(spark, log):
            return spark.createDataFrame([], f"{ZONE}, batch_id bigint")
        whole = with_payload_bytes(spark.read.schema(RECORD).parquet(log))
        return zones(whole).withColumn("batch_id", F.lit(None).cast("bigint"))
    root = f"{log.rstrip('/')}/{INDEX}"
    indexed = {n for n in slices(spark, root) if is_complete(spark, batch_folder(root, n))} if children(spark, root) else set()
    known = spark.createDataFrame([], f"{ZONE}, batch_id bigint")
    if indexed:
        known = spark.read.schema(f"{ZONE}, batch_id bigint").parquet(root)
        known = known.where(in_slices(there & indexed)) if indexed - there else known
    if missing := there - indexed:
        bare = spark.read.schema(f"{RECORD}, batch_id bigint").parquet(log).where(in_slices(missing))
        known = known.unionByName(zones(with_payload_bytes(bare), "batch_id"))
    return known


def index_missing(spark: SparkSession, log: str) -> int:
    """Index the slices that have no index yet; the number of these."""
    missing = slices(spark, log) - slices(spark, f"{log.rstrip('/')}/{INDEX}")
    for batch_id in sorted(missing):
        records = with_payload_bytes(spark.read.schema(RECORD).parquet(batch_folder(log, batch_id)))
        staged = batch_folder(f"{log.rstrip('/')}/_staging_index", batch_id)
        zones(records).coalesce(1).write.mode("overwrite").parquet(staged)
        publish(spark, staged, batch_folder(f"{log.rstrip('/')}/{INDEX}", batch_id))
    return len(missing)


def tips(index: DataFrame) -> DataFrame:
    """The end of every shard, as ``shard_tips`` has it from records: last sequence number and last arrival."""
    return index.groupBy("shard_id").agg(
        F.max("last_sequence_number").alias("sequence_number"), F.max("last_arrival_ts").alias("tip_ts")
    )


def log_tips(spark: SparkSession, log: str) -> DataFrame:
    """The end of every shard of a log as it is now."""
    return tips(read_index(spark, log))


def in_slices(numbers: Sequence[int] | set[int]) -> Column:
    """A filter on the folders of slices, by ranges of their numbers; files of others are not opened."""
    ranges: list[list[int]] = []
    for n in sorted(numbers):
        if ranges and n == ranges[-1][1] + 1:
            ranges[-1][1] = n
        else:
            ranges.append([n, n])
    number = F.col("batch_id")
    if len(ranges) > MOST_RANGES:
        return number.isin(sorted(numbers))
    wanted = F.lit(False)
    for low, high in ranges:
        wanted = wanted | number.between(low, high)
    return wanted


def last_records(index: DataFrame) -> DataFrame:
    """For every slice and shard a record that stands for its last: where that is not read, none of them is."""
    return index.select(
        "shard_id", "batch_id", F.col("last_sequence_number").alias("sequence_number"), F.col("last_arrival_ts").alias("arrival_ts")
    )


def read_from(
    spark: SparkSession,
    log: str,
    position: str,
    since: datetime | str | None = None,
    tips: DataFrame | None = None,
    progress: DataFrame | None = None,
    index: DataFrame | None = None,
) -> DataFrame:
    """Records of a log from a start position or stored progress on, as ``start_reading`` gives them.

    Slices of which the index shows that every shard is done with them are not opened. Their numbers are all
    that comes to the driver, which lists the folders anyway.
    """
    progress = settle(progress) if progress is not None else None
    tips = settle(tips) if tips is not None else None
    index = read_index(spark, log) if index is None else index
    wanted = start_reading(last_records(index), position, since, tips, progress).select("batch_id").distinct()
    numbers = {r["batch_id"] for r in wanted.collect()}
    if None in numbers:
        records = spark.read.schema(RECORD).parquet(log)
    else:
        records = spark.read.schema(f"{RECORD}, batch_id bigint").parquet(log).where(in_slices(numbers))
    return start_reading(records.select(*RECORD_COLUMNS), position, since, tips, progress)
