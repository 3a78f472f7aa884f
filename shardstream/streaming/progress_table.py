"""The stored progress of a job: one complete table per micro-batch."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from shardstream.model import PROGRESS
from shardstream.operators.progress import merge_progress
from shardstream.sources.folders import batch_folder, drop_batch, is_complete, latest_batch

# Batches whose progress stays readable; the table of the batch before these is removed.
KEPT_BATCHES = 100


def progress_at(spark: SparkSession, folder: str, batch_id: int | None) -> DataFrame | None:
    """Progress as stored after a batch."""
    if batch_id is None or batch_id < 0:
        return None
    return spark.read.schema(PROGRESS).parquet(batch_folder(folder, batch_id))


def current_progress(spark: SparkSession, folder: str) -> DataFrame | None:
    """Progress after the last batch that stored any, or None."""
    return progress_at(spark, folder, latest_batch(spark, folder))


def store_progress(
    committed: DataFrame, folder: str, batch_id: int, status: DataFrame | None = None, kept: int | None = None
) -> DataFrame:
    """Merge a batch's commits into the table of the batch before, and store the whole table.

    Storing the same batch again writes the same rows to the same place. A job can be put back by fewer than ``kept``
    batches; older tables are removed.
    """
    spark = committed.sparkSession
    before = batch_folder(folder, batch_id - 1)
    prior = progress_at(spark, folder, batch_id - 1) if is_complete(spark, before) else None
    if prior is None and batch_id > 0:
        raise ValueError(f"no progress stored for batch {batch_id - 1} in {folder}")
    merge_progress(committed, status, prior).write.mode("overwrite").parquet(batch_folder(folder, batch_id))
    kept = KEPT_BATCHES if kept is None else kept
    if batch_id >= kept:
        drop_batch(spark, folder, batch_id - kept)
    return progress_at(spark, folder, batch_id)
