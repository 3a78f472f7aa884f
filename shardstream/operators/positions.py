"""Where reading of each shard starts."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shardstream.model import AT_TIMESTAMP, LATEST, SHARD_END, TRIM_HORIZON
from shardstream.operators.shards import join_shards
from shardstream.session import settle


def shard_tips(records: DataFrame) -> DataFrame:
    """The end of every shard: its last sequence number and last arrival."""
    return records.groupBy("shard_id").agg(
        F.max("sequence_number").alias("sequence_number"), F.max("arrival_ts").alias("tip_ts")
    )


def from_trim_horizon(records: DataFrame) -> DataFrame:
    """All retained records."""
    return records


def from_timestamp(records: DataFrame, since: datetime | str) -> DataFrame:
    """Records that arrived at ``since`` or later; reaches the scan as a filter."""
    return records.where(_arrived_since(since))


def from_latest(records: DataFrame, tips: DataFrame) -> DataFrame:
    """Records after the tips noted at first start; all of a shard that had none then."""
    return resume(records, tips.select("shard_id", "sequence_number"))


def lowest_progress(progress: DataFrame) -> str | None:
    """The sequence before which no listed shard reads on; None if there is no such bound."""
    stored = F.col("sequence_number")
    found = progress.agg(
        F.min(F.when(~stored.isin(TRIM_HORIZON, SHARD_END), stored)).alias("low"),
        F.bool_or(stored.isNull() | (stored == TRIM_HORIZON)).alias("from_start"),
    ).first()
    return None if found["from_start"] else found["low"]


def resume(
    records: DataFrame,
    progress: DataFrame,
    otherwise: Column | None = None,
    every_shard_listed: bool = False,
) -> DataFrame:
    """Records after each shard's stored progress.

    A shard without progress starts where ``otherwise`` is true (default: at its first record). When
    ``every_shard_listed`` says that no such shard exists, the smallest stored sequence becomes a
    filter on the scan, which skips the files every shard is done with.
    """
    progress = settle(progress.select("shard_id", "sequence_number"))
    if every_shard_listed and (low := lowest_progress(progress)) is not None:
        records = records.where(F.col("sequence_number") > low)
    progress = progress.withColumnRenamed("sequence_number", "_done")
    done = F.col("_done")
    start = F.lit(True) if otherwise is None else otherwise
    wanted = (
        F.when(done.isNull(), start)
        .when(done == TRIM_HORIZON, True)
        .when(done == SHARD_END, False)
        .otherwise(F.col("sequence_number") > done)
    )
    return join_shards(records, progress, settled=True).where(wanted).drop("_done")


def start_reading(
    records: DataFrame,
    position: str,
    since: datetime | str | None = None,
    tips: DataFrame | None = None,
    progress: DataFrame | None = None,
) -> DataFrame:
    """Apply a start position, and stored progress where there is any."""
    if position == AT_TIMESTAMP and since is None:
        raise ValueError("AT_TIMESTAMP needs a timestamp")
    if position == LATEST and tips is None:
        raise ValueError("LATEST needs the tips at first start")
    if position not in (TRIM_HORIZON, LATEST, AT_TIMESTAMP):
        raise ValueError(f"unknown start position {position!r}")
    if position == LATEST:
        tips = tips.select("shard_id", "sequence_number")
        if progress is None:
            return from_latest(records, tips)
        stored = progress.select("shard_id", F.col("sequence_number").alias("_stored"))
        merged = tips.join(stored, "shard_id", "full").select(
            "shard_id", F.coalesce("_stored", "sequence_number").alias("sequence_number")
        )
        return resume(records, merged)
    if progress is None:
        return from_timestamp(records, since) if position == AT_TIMESTAMP else from_trim_horizon(records)
    return resume(records, progress, _arrived_since(since) if position == AT_TIMESTAMP else None)


def with_starting_sequence(records: DataFrame, progress: DataFrame | None, settled: bool = False) -> DataFrame:
    """The sequence each shard's reader started after: constant per shard, fixed at the start."""
    if progress is None:
        return records.withColumn("starting_sequence_number", F.lit(TRIM_HORIZON))
    starts = progress.select("shard_id", F.col("sequence_number").alias("starting_sequence_number"))
    joined = join_shards(records, starts, settled=settled)
    return joined.withColumn(
        "starting_sequence_number", F.coalesce("starting_sequence_number", F.lit(TRIM_HORIZON))
    )


def _arrived_since(since: datetime | str) -> Column:
    return F.col("arrival_ts") >= F.lit(since).cast("timestamp")
