"""Reading a log as a running job that stores its progress per shard.

Spark commits a micro-batch after ``process`` has finished, and the progress table is stored before
that. A batch that fails is run again with the same id: deliveries are at least once, and the output
holds every record once when ``process`` writes per batch id, as ``write_batches`` does.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from shardstream.model import LATEST, TRIM_HORIZON
from shardstream.operators.fetch import with_fetch
from shardstream.operators.lag import committable
from shardstream.operators.positions import from_timestamp, shard_tips
from shardstream.operators.progress import backward_progress, delivered_progress, invalid_progress
from shardstream.operators.shards import join_shards
from shardstream.session import settle
from shardstream.sources.folders import batch_folder, drop_batch, drop_folder, exists, is_complete, make_folder
from shardstream.sources.index import in_slices, log_tips, read_index, slices, tips
from shardstream.sources.log import in_shard_order, stream_folder, stream_log
from shardstream.sources.options import Overrides, SourceOptions, resolve_options
from shardstream.streaming.progress_table import current_progress, progress_at, store_progress

Process = Callable[[DataFrame, int], "DataFrame | None"]


class InvalidProgress(ValueError):
    """A commit names a sequence that was not delivered, or goes back behind an earlier one."""


def read_records(spark: SparkSession, log: str, job: str, options: SourceOptions | None = None) -> DataFrame:
    """A log as a stream of records from the configured start position on.

    For LATEST the tips are noted in the job's folder at its first start and kept for later starts, with the slices
    that were there: files of these are not opened, nor those of slices that ended before a start timestamp. A log that is
    not there yet is an empty one. Settings that Spark has for sessions only are made in a session of the stream's own.
    """
    options = options or SourceOptions()
    if conf := options.session_conf():
        spark = spark.newSession()
        for name, value in conf.items():
            spark.conf.set(name, value)
    make_folder(spark, log)
    position = options.start_position
    if position == TRIM_HORIZON:
        return stream_log(spark, log, **options.reader_options())
    if position == LATEST:
        noted, over = _state_at_first_start(spark, log, job)
        records = stream_log(spark, log, ~in_slices(over) if over else None, **options.reader_options())
        joined = join_shards(records, noted.withColumnRenamed("sequence_number", "_tip"))
        return joined.where(F.col("_tip").isNull() | (F.col("sequence_number") > F.col("_tip"))).drop("_tip")
    ends = read_index(spark, log).groupBy("batch_id").agg(F.max("last_arrival_ts").alias("end"))
    over = ends.where(F.col("batch_id").isNotNull() & (F.col("end") < F.lit(options.timestamp).cast("timestamp")))
    over = {r["batch_id"] for r in over.select("batch_id").collect()}
    records = stream_log(spark, log, ~in_slices(over) if over else None, **options.reader_options())
    return from_timestamp(records, options.timestamp)


def _state_at_first_start(spark: SparkSession, log: str, job: str) -> tuple[DataFrame, set[int]]:
    """Tips of the shards, and the slices that were there, when the job started first."""
    folder, listed = f"{job.rstrip('/')}/start", f"{job.rstrip('/')}/start_slices"
    if not is_complete(spark, folder):
        index = settle(read_index(spark, log))
        index.where("batch_id is not null").select("batch_id").distinct().write.mode("overwrite").parquet(listed)
        tips(index).select("shard_id", "sequence_number").write.mode("overwrite").parquet(folder)
    over = spark.read.schema("batch_id bigint").parquet(listed).collect() if is_complete(spark, listed) else []
    noted = spark.read.schema("shard_id string, sequence_number string").parquet(folder)
    return noted, {r["batch_id"] for r in over}


def write_batches(folder: str) -> Process:
    """A step that writes each micro-batch to its own folder, replacing what a failed run left."""

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(batch_folder(folder, batch_id))

    return write


def start_consumer(
    records: DataFrame,
    process: Process,
    job: str,
    options: SourceOptions | None = None,
    status: Callable[[], DataFrame] | None = None,
    with_envelope: bool = False,
    once: bool = False,
    in_order: bool = True,
    log: str | None = None,
    repeatable: bool = True,
) -> StreamingQuery:
    """Run ``process`` on every micro-batch and commit what it handled.

    Batches are handed over by shard and sequence, partition after partition; a large shard is several partitions that
    follow each other. That shuffles them; ``in_order=False`` hands over the files as they are.

    ``process`` may return the records (or rows of shard and sequence) to commit; None commits the
    whole batch. ``status`` gives the shutdown reasons at the start of each batch. ``with_envelope``
    hands over committable records, cut into fetches; their lag is that behind the ends of the shards in ``log`` when the
    batch starts, which its index has (default: the folder that ``records`` are read from). For a stream that reads no
    log it is the lag inside the batch. ``once`` stops after the available data.

    ``repeatable=False`` is for readers that may give something else when they are asked again, or are dear to ask: each
    range is read once, into the job's folder, and handed over, committed and, after a failure, handed over again from there.
    """
    spark = records.sparkSession
    options = options or SourceOptions()
    progress, delivered = f"{job.rstrip('/')}/progress", f"{job.rstrip('/')}/delivered"
    if not exists(spark, f"{job.rstrip('/')}/checkpoint"):
        drop_folder(spark, delivered)  # of a job that has been reset
    started_at = current_progress(spark, progress)
    started_at = settle(started_at) if started_at is not None else None
    if with_envelope and log is None:
        log = stream_folder(records)

    def run(batch: DataFrame, batch_id: int) -> None:
        # Committing reads two narrow columns again, which is cheaper than keeping the payloads; only
        # envelopes read the batch often enough. The tables made here live until the batch ends.
        if not repeatable:
            batch = _read_once(batch, delivered, batch_id)
        if with_envelope:
            batch = batch.persist()
        reasons = status().persist() if status else None
        try:
            handed = batch
            if with_envelope:
                fetches = with_fetch(batch, options.fetch_records, options.max_cache_byte_size)
                ends = settle(log_tips(spark, log)) if log and slices(spark, log) else shard_tips(batch)
                handed = committable(fetches, ends, started_at, settled=True)
            handled = process(in_shard_order(handed) if in_order else handed, batch_id)
            commit_batch(
                batch if handled is None else handled,
                progress,
                batch_id,
                status=reasons,
                delivered=batch if handled is not None and options.validate_sequence_number else None,
            )
        finally:
            if with_envelope:
                batch.unpersist()
            if reasons is not None:
                reasons.unpersist()

    writer = records.writeStream.foreachBatch(run).option("checkpointLocation", f"{job.rstrip('/')}/checkpoint")
    return writer.trigger(**({"availableNow": True} if once else options.trigger())).start()


def _read_once(batch: DataFrame, folder: str, batch_id: int) -> DataFrame:
    """The batch as it was read first, whatever has failed since; the one before it, which is committed, is removed."""
    spark, here = batch.sparkSession, batch_folder(folder, batch_id)
    if not is_complete(spark, here):
        batch.write.mode("overwrite").parquet(here)
    drop_batch(spark, folder, batch_id - 1)
    return spark.read.schema(batch.schema).parquet(here)


def start_from_config(
    spark: SparkSession,
    log: str,
    job: str,
    process: Process,
    config: Mapping[str, object] | None = None,
    overrides: Overrides | None = None,
    **more,
) -> StreamingQuery:
    """Read a log and run ``process`` on it with settings from a configuration."""
    options = resolve_options(config, overrides)
    return start_consumer(read_records(spark, log, job, options), process, job, options, log=log, **more)


def commit_batch(
    handled: DataFrame,
    progress: str,
    batch_id: int,
    status: DataFrame | None = None,
    delivered: DataFrame | None = None,
) -> DataFrame:
    """Store the progress that committing ``handled`` in order leads to.

    A terminated shard is committed as others are, until the ``ending_sequence_number`` of its status
    is reached; then it is finished.

    With ``delivered`` every committed sequence must be one of the delivered records.
    """
    committed = delivered_progress(handled, status).persist()
    try:
        if delivered is not None:
            _refuse(invalid_progress(committed, delivered, settled=True), "not delivered")
            before = progress_at(handled.sparkSession, progress, batch_id - 1)
            if before is not None:
                _refuse(backward_progress(committed, before), "goes back")
        return store_progress(committed, progress, batch_id, status)
    finally:
        committed.unpersist()


def _refuse(wrong: DataFrame, why: str) -> None:
    first = wrong.head(1)
    if first:
        raise InvalidProgress(f"{why}: {first[0].asDict()}")
