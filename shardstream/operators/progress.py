"""Committing progress: which records count, and what is stored per shard.

A status table (shard, shutdown reason and, of a terminated shard, the sequence it ends with) is one
that is kept somewhere, so that reading it twice is cheap and gives the same.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shardstream.model import LATEST, SHARD_END, TERMINATE, TRIM_HORIZON
from shardstream.operators.shards import fits_broadcast, join_shards
from shardstream.session import settle

COMMITTED = "committed"
SKIPPED = "skipped"
FAILED = "failed"


def with_can_checkpoint(records: DataFrame, status: DataFrame) -> DataFrame:
    """Mark records of shards that are not shut down. No row is removed: all are still delivered."""
    joined = join_shards(records, status.select("shard_id", "shutdown_reason"), settled=True)
    return joined.withColumn("can_checkpoint", F.col("shutdown_reason").isNull()).drop("shutdown_reason")


def checkpoint_records(records: DataFrame, status: DataFrame | None = None) -> DataFrame:
    """Progress after committing every eligible record in order: the last sequence of each shard.

    Whether a shard may commit is the same for all its records, so the log is reduced to one row per
    shard before the status is looked at. Works on a stream in update mode.
    """
    last = records.groupBy("shard_id").agg(F.max("sequence_number").alias("sequence_number"))
    if status is None:
        return last
    closed = status.where(F.col("shutdown_reason").isNotNull()).select("shard_id")
    return last.join(closed, "shard_id", "left_anti")


def delivered_progress(records: DataFrame, status: DataFrame | None = None) -> DataFrame:
    """The last delivered sequence of each shard that this reader still owns.

    A terminated shard gets no new records, but those that are delivered are done with: it goes on
    being read until its end. Any other shutdown takes the shard away.
    """
    last = records.groupBy("shard_id").agg(F.max("sequence_number").alias("sequence_number"))
    if status is None:
        return last
    lost = status.where(F.col("shutdown_reason").isNotNull() & (F.col("shutdown_reason") != TERMINATE))
    return last.join(lost.select("shard_id"), "shard_id", "left_anti")


def checkpoint_record_sets(sets: DataFrame, status: DataFrame | None = None) -> DataFrame:
    """Per set: the sequence of its last record and what committing it comes to.

    A set of a shut-down shard is skipped, an empty set fails.
    """
    if status is None:
        sets = sets.withColumn("shutdown_reason", F.lit(None).cast("string"))
    else:
        status = status.select("shard_id", "shutdown_reason")
        sets = join_shards(sets, status, salt_by="fetch_no", settled=True)
    last = F.try_element_at("records", F.lit(-1))["sequence_number"]
    closed = F.col("shutdown_reason").isNotNull()
    return sets.select(
        "shard_id",
        "fetch_no",
        F.when(~closed, last).alias("sequence_number"),
        F.when(closed, SKIPPED).when(F.size("records") > 0, COMMITTED).otherwise(FAILED).alias("outcome"),
    )


def merge_progress(committed: DataFrame, status: DataFrame | None, prior: DataFrame | None) -> DataFrame:
    """The progress table after a commit: one row per shard that any of the tables knows.

    Progress moves to the committed sequence, and never back behind the prior one. A terminated shard
    is stored as finished once its progress has reached ``ending_sequence_number``; as long as it has
    not, or the status does not say where the shard ends, reading goes on after what is stored. All inputs
    hold one row per shard.
    """
    merged = committed.select("shard_id", F.col("sequence_number").alias("_committed"))
    if prior is None:
        merged = merged.withColumn("_prior", F.lit(None).cast("string"))
    else:
        merged = merged.join(
            prior.select("shard_id", F.col("sequence_number").alias("_prior")), "shard_id", "full"
        )
    if status is None:
        merged = merged.withColumn("shutdown_reason", F.lit(None).cast("string"))
        merged = merged.withColumn("_ending", F.lit(None).cast("string"))
    else:
        known = "ending_sequence_number" in status.columns
        ending = F.col("ending_sequence_number") if known else F.lit(None).cast("string")
        ends = status.select("shard_id", "shutdown_reason", ending.alias("_ending"))
        merged = merged.join(ends, "shard_id", "full")
    # Positions are not sequence numbers: the start position is before all of them, the end after.
    prior_sequence = F.when(F.col("_prior") != TRIM_HORIZON, F.col("_prior"))
    moved = F.when(F.col("_prior") == SHARD_END, F.lit(SHARD_END)).otherwise(
        F.coalesce(F.greatest("_committed", prior_sequence), F.col("_prior"))
    )
    reached = ~moved.isin(TRIM_HORIZON, SHARD_END) & (moved >= F.col("_ending"))
    read_to_end = (F.col("shutdown_reason") == TERMINATE) & reached
    return merged.select(
        "shard_id",
        F.when(read_to_end, SHARD_END).otherwise(moved).alias("sequence_number"),
        "shutdown_reason",
    )


def invalid_progress(progress: DataFrame, records: DataFrame, settled: bool = False) -> DataFrame:
    """Progress rows whose sequence number is not in the log.

    The log is only filtered by the few wanted keys and never shuffled, unless the progress table is
    too large to broadcast.
    """
    positions = F.col("sequence_number").isin(TRIM_HORIZON, LATEST, SHARD_END)
    wanted = progress.where(F.col("sequence_number").isNotNull() & ~positions)
    wanted = wanted if settled else settle(wanted)
    keys = ["shard_id", "sequence_number"]
    probe = wanted.select(*keys).distinct()
    probe = F.broadcast(probe) if fits_broadcast(wanted) else probe
    found = records.select(*keys).join(probe, keys, "left_semi").distinct()
    return wanted.join(found, keys, "left_anti")


def backward_progress(progress: DataFrame, former: DataFrame) -> DataFrame:
    """Progress rows that go back behind the former value of their shard."""
    before = former.select("shard_id", F.col("sequence_number").alias("former_sequence_number"))
    new, old = F.col("sequence_number"), F.col("former_sequence_number")
    reopened = (old == SHARD_END) & (new != SHARD_END)
    comparable = ~new.isin(SHARD_END) & ~old.isin(TRIM_HORIZON, SHARD_END)
    reset = (new == TRIM_HORIZON) & (old != TRIM_HORIZON)
    return progress.join(before, "shard_id").where(reopened | reset | (comparable & (new < old)))
