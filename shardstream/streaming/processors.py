"""A running job that keeps a processor's life per shard over micro-batches and restarts."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from shardstream.operators.processors import STATE, ShardProcessor, life_schema, process_shards, shard_outputs
from shardstream.session import settle
from shardstream.sources.folders import batch_folder, drop_folder, is_complete
from shardstream.sources.options import SourceOptions
from shardstream.streaming.consumer import start_consumer
from shardstream.streaming.progress_table import KEPT_BATCHES


def start_processors(
    records: DataFrame,
    processor: ShardProcessor,
    job: str,
    options: SourceOptions | None = None,
    status: Callable[[], DataFrame] | None = None,
    once: bool = False,
) -> StreamingQuery:
    """Run ``process_shards`` on every micro-batch, from the states that the batch before left, and commit the batch.

    Outputs and states of a batch are one write, which a batch that is run again replaces: every record counts once in
    the states, and ``processed_outputs`` has every output once. A shutdown reason is looked at once per micro-batch.
    """
    options = options or SourceOptions()
    spark = records.sparkSession
    folder = _folder(job)
    reasons: list[DataFrame] = []

    def noted() -> DataFrame:
        reasons[:] = [settle(status())]
        return reasons[0]

    def process(batch: DataFrame, batch_id: int) -> None:
        states = None
        if batch_id > 0:
            if not is_complete(spark, batch_folder(folder, batch_id - 1)):
                raise ValueError(f"no states stored for batch {batch_id - 1} in {folder}")
            states = _lives(spark, processor, batch_folder(folder, batch_id - 1))
        lives = process_shards(
            batch, processor, states, reasons[0] if reasons else None, options.fetch_records, options.max_cache_byte_size
        )
        lives.write.partitionBy("kind").mode("overwrite").parquet(batch_folder(folder, batch_id))
        if batch_id >= KEPT_BATCHES:
            drop_folder(spark, f"{batch_folder(folder, batch_id - KEPT_BATCHES)}/kind={STATE}")

    return start_consumer(
        records, process, job, options, status=noted if status else None, once=once, in_order=False
    )


def processed_outputs(spark: SparkSession, processor: ShardProcessor, job: str) -> DataFrame:
    """All outputs of a job so far."""
    return shard_outputs(_lives(spark, processor, _folder(job)))


def _folder(job: str) -> str:
    return f"{job.rstrip('/')}/lives"


def _lives(spark: SparkSession, processor: ShardProcessor, folder: str) -> DataFrame:
    return spark.read.schema(life_schema(processor)).parquet(folder)
