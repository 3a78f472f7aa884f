"""The registered queries: each takes a session and a folder of tables and returns a DataFrame."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.errors.exceptions.captured import StreamingQueryException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shardstream.functions.attempts import all_attempts_ok, last_error_code, last_error_message
from shardstream.functions.payload import to_bytes, to_text
from shardstream.functions.retry import (
    EXPONENTIAL,
    LINEAR,
    RECORD_FAILED,
    RetryPolicy,
    classify,
    retries_used,
    total_backoff_ms,
)
from shardstream.functions.routing import shard_of
from shardstream.model import LATEST, RECORD, TRIM_HORIZON
from shardstream.operators import fetch, lag, positions, progress, puts, quota
from shardstream.operators.different import count_different
from shardstream.operators.full_fetches import with_full_fetch
from shardstream.operators.ordering import rank_by_sequence
from shardstream.operators.processors import ShardProcessor, process_shards, shard_outputs, shard_states
from shardstream.operators.sets import process_record_sets
from shardstream.operators.shards import join_shards
from shardstream.plans import tables as t
from shardstream.session import new_folder, settle
from shardstream.sources.changes import decode_new_image
from shardstream.sources.index import read_from, read_index
from shardstream.sources.log import stream_log
from shardstream.sources.options import SourceOptions
from shardstream.streaming.consumer import start_consumer, write_batches
from shardstream.streaming.producer import DEAD_LETTER, put_records, put_through, start_producer
from shardstream.streaming.progress_table import current_progress
from shardstream.streaming.put_queue import PutQueue, SystemClock

Query = Callable[[SparkSession, str], DataFrame]

# Rows that one task numbers in the queries that show shards cut into buckets.
SMALL_WINDOW = 700

QUERIES: dict[str, Query] = {}


def query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


def query_named(name: str) -> Callable[[Query], Query]:
    """For a query whose name is taken by the operator it shows."""

    def register(function: Query) -> Query:
        QUERIES[name] = function
        return function

    return register


def _plain(records: DataFrame, *more: str) -> DataFrame:
    """Records with text for bytes and microseconds for times, as both engines print them."""
    return records.select(
        "stream_name",
        "shard_id",
        "sequence_number",
        "partition_key",
        to_text("data").alias("data"),
        F.unix_micros("arrival_ts").alias("arrival_us"),
        *more,
    )


def _fetches(spark: SparkSession, folder: str) -> DataFrame:
    return fetch.with_fetch(t.log(spark, folder), t.FETCH_RECORDS)


def _sets(spark: SparkSession, folder: str) -> DataFrame:
    return fetch.record_sets(_fetches(spark, folder))


def _envelopes(spark: SparkSession, folder: str) -> DataFrame:
    """Record sets with what their records carry: starting sequence and lag."""
    log = t.log(spark, folder)
    sets = lag.with_millis_behind(_sets(spark, folder), positions.shard_tips(log), "cache_entry_time")
    starts = t.prior_progress(log).withColumnRenamed("sequence_number", "starting_sequence_number")
    joined = join_shards(sets, starts, salt_by="fetch_no")
    return joined.withColumn(
        "starting_sequence_number", F.coalesce("starting_sequence_number", F.lit(TRIM_HORIZON))
    )


# Shard progress with lag


@query
def shard_progress_with_lag(spark: SparkSession, folder: str) -> DataFrame:
    """Per shard: what a consumer that committed everything has stored, and how far it was behind."""
    log = t.log(spark, folder)
    fetches = fetch.fetch_summary(_fetches(spark, folder))
    behind = lag.with_millis_behind(fetches, positions.shard_tips(log), "last_arrival_ts")
    per_shard = behind.groupBy("shard_id").agg(
        F.count(F.lit(1)).alias("fetches"),
        F.sum("records").alias("records"),
        F.max("last_sequence_number").alias("sequence_number"),
        F.max("millis_behind_latest").alias("max_millis_behind"),
    )
    marked = progress.with_can_checkpoint(per_shard, t.shard_status(spark))
    return marked.withColumn("committed", F.when(F.col("can_checkpoint"), F.col("sequence_number"))).drop("can_checkpoint")


# Sources


@query
def read_records(spark: SparkSession, folder: str) -> DataFrame:
    """Consume the log as a stream into one folder per micro-batch, committing per batch."""
    out, job = new_folder(spark, "read_records"), new_folder(spark, "job")
    _consume(spark, folder, t.as_log, write_batches(out), job)
    return _plain(spark.read.parquet(out))


@query
def read_records_progress(spark: SparkSession, folder: str) -> DataFrame:
    """The progress a running consumer leaves behind, with a shard read to its end, one that is terminated with
    records still to come, and one taken away."""
    job = new_folder(spark, "job")
    status = t.shard_endings(spark, t.log(spark, folder))

    def deliver(batch: DataFrame, batch_id: int) -> None:
        batch.write.format("noop").mode("overwrite").save()

    _consume(spark, folder, t.as_log, deliver, job, status=lambda: status)
    return current_progress(spark, f"{job}/progress").select("shard_id", "sequence_number", "shutdown_reason")


@query
def commit_what_was_read(spark: SparkSession, folder: str) -> DataFrame:
    """Records per shard of a consumer that reads each batch once, into its own folder, fails after handing it over and
    starts again, with the progress it leaves behind."""
    out, job = new_folder(spark, "commit_what_was_read"), new_folder(spark, "job")
    write, failed = write_batches(out), []

    def deliver(batch: DataFrame, batch_id: int) -> None:
        write(batch, batch_id)
        if not failed:
            failed.append(batch_id)
            raise InterruptedError("a job that ends before it commits")

    for _ in range(2):
        try:
            _consume(spark, folder, t.as_log, deliver, job, repeatable=False)
        except StreamingQueryException:
            if len(failed) != 1:
                raise
    read = spark.read.parquet(out).groupBy("shard_id").agg(F.count("*").alias("records"))
    return read.join(current_progress(spark, f"{job}/progress").select("shard_id", "sequence_number"), "shard_id")


@query
def read_committable(spark: SparkSession, folder: str) -> DataFrame:
    """Records with starting sequence and lag, constant over each fetch."""
    log = t.log(spark, folder)
    rows = lag.committable(_fetches(spark, folder), positions.shard_tips(log), t.prior_progress(log))
    return _plain(rows, "starting_sequence_number", "millis_behind_latest")


@query
def read_changes(spark: SparkSession, folder: str) -> DataFrame:
    """Consume a change log as a stream and decode the new image of each change."""
    out, job = new_folder(spark, "read_changes"), new_folder(spark, "job")
    _consume(spark, folder, lambda rows: decode_new_image(t.change_log(rows), t.IMAGE), write_batches(out), job)
    return spark.read.parquet(out).select("shard_id", "sequence_number", "id", "value")


@query
def read_changes_committable(spark: SparkSession, folder: str) -> DataFrame:
    """Change records with their envelope."""
    changes = t.change_log(t.events(spark, folder))
    fetches = fetch.with_fetch(changes, t.FETCH_RECORDS)
    rows = lag.committable(fetches, positions.shard_tips(changes), t.prior_progress(changes))
    columns = ("shard_id", "sequence_number", "id", "value", "starting_sequence_number", "millis_behind_latest")
    return decode_new_image(rows, t.IMAGE).select(*columns)


def _consume(spark: SparkSession, folder: str, as_records, process, job: str, status=None, **more) -> None:
    rows = t.events_stream(spark, folder)
    options = SourceOptions(initial_position=TRIM_HORIZON)
    start_consumer(as_records(rows), process, job, options, status, once=True, **more).awaitTermination()


# Start positions


@query
def start_trim_horizon(spark: SparkSession, folder: str) -> DataFrame:
    records = positions.start_reading(t.log(spark, folder), TRIM_HORIZON)
    return records.select("shard_id", "sequence_number")


@query
def start_latest(spark: SparkSession, folder: str) -> DataFrame:
    log = t.log(spark, folder)
    records = positions.start_reading(log, LATEST, tips=t.tips_until(log, t.LATEST_FROM))
    return records.select("shard_id", "sequence_number")


@query
def start_at_timestamp(spark: SparkSession, folder: str) -> DataFrame:
    return positions.from_timestamp(t.log(spark, folder), t.SINCE).select("shard_id", "sequence_number")


@query
def resume_from_progress(spark: SparkSession, folder: str) -> DataFrame:
    """Go on after stored progress; one shard has none and starts at its first record."""
    log = t.log(spark, folder)
    stored = t.prior_progress(log).where("shard_id <> 'shard-3'")
    return positions.resume(log, stored).select("shard_id", "sequence_number")


@query
def resume_all_shards(spark: SparkSession, folder: str) -> DataFrame:
    """As above where every shard has progress, so that the scan can skip what all are done with."""
    log = t.log(spark, folder)
    stored = t.prior_progress(log)
    return positions.resume(log, stored, every_shard_listed=True).select("shard_id", "sequence_number")


@query
def slice_index(spark: SparkSession, folder: str) -> DataFrame:
    """What the index of a log says of its slices, which were appended one after another."""
    log = t.append_slices(t.log(spark, folder), new_folder(spark, "log"))
    return read_index(spark, log).select(
        F.col("batch_id").alias("slice"), "shard_id", "rows", "bytes", "first_sequence_number", "last_sequence_number",
        F.unix_micros("last_arrival_ts").alias("last_arrival_us"),
    )


@query
def start_latest_by_index(spark: SparkSession, folder: str) -> DataFrame:
    """As ``start_latest``, from a log whose index says which slices hold anything after the tips."""
    log = t.append_slices(t.log(spark, folder), new_folder(spark, "log"))
    tips = t.tips_until(t.log(spark, folder), t.LATEST_FROM)
    return read_from(spark, log, LATEST, tips=tips).select("shard_id", "sequence_number")


@query
def resume_by_index(spark: SparkSession, folder: str) -> DataFrame:
    """As ``resume_from_progress``, from a log with an index."""
    log = t.append_slices(t.log(spark, folder), new_folder(spark, "log"))
    stored = t.prior_progress(t.log(spark, folder)).where("shard_id <> 'shard-3'")
    return read_from(spark, log, TRIM_HORIZON, progress=stored).select("shard_id", "sequence_number")


@query
def stream_lag(spark: SparkSession, folder: str) -> DataFrame:
    """The lag of every record that a running consumer reads in several micro-batches, one record a fetch: behind the end
    of its shard in the log, whatever the batch holds."""
    log = t.append_slices(t.log(spark, folder), new_folder(spark, "log"))
    out, job = new_folder(spark, "stream_lag"), new_folder(spark, "job")
    options = SourceOptions(initial_position=TRIM_HORIZON, max_records=1)
    records = stream_log(spark, log, maxFilesPerTrigger=max(1, len(spark.read.parquet(log).inputFiles()) // 3))
    start_consumer(records, write_batches(out), job, options, with_envelope=True, once=True, log=log).awaitTermination()
    return spark.read.parquet(out).select("shard_id", "sequence_number", "millis_behind_latest")


# Fetches and record sets


@query
def fetch_batches(spark: SparkSession, folder: str) -> DataFrame:
    summary = fetch.fetch_summary(_fetches(spark, folder))
    return summary.select("shard_id", "fetch_no", "records", "last_sequence_number")


@query
def fetch_batches_cut(spark: SparkSession, folder: str) -> DataFrame:
    """As ``fetch_batches``, with shards cut into buckets as large logs are."""
    fetches = fetch.with_fetch(t.log(spark, folder), t.FETCH_RECORDS, window_rows=SMALL_WINDOW)
    return fetch.fetch_summary(fetches).select("shard_id", "fetch_no", "records", "last_sequence_number")


@query
def fetch_batches_by_bytes(spark: SparkSession, folder: str) -> DataFrame:
    """Fetches bounded by records and by the bytes of their payloads."""
    fetches = fetch.with_fetch(t.log(spark, folder), t.FETCH_RECORDS, max_bytes=4000)
    return fetch.fetch_summary(fetches).select("shard_id", "fetch_no", "records", "last_sequence_number")


@query
def fetch_batches_full(spark: SparkSession, folder: str) -> DataFrame:
    """Fetches filled one after another up to both bounds, over blocks of rows."""
    fetches = with_full_fetch(t.log(spark, folder), 120, max_bytes=4000, block_rows=SMALL_WINDOW)
    return fetch.fetch_summary(fetches).select("shard_id", "fetch_no", "records", "last_sequence_number")


@query
def record_sets(spark: SparkSession, folder: str) -> DataFrame:
    """Sets as rows; the array is shown by its size, ends and a digest over its records in order."""
    lines = F.transform("records", lambda r: F.concat_ws(":", r["sequence_number"], to_text(r["data"])))
    return _sets(spark, folder).select(
        "shard_id",
        "fetch_no",
        F.size("records").alias("records"),
        F.element_at("records", 1)["sequence_number"].alias("first_sequence_number"),
        F.element_at("records", -1)["sequence_number"].alias("last_sequence_number"),
        F.md5(F.array_join(lines, ",").cast("binary")).alias("digest"),
    )


@query
def flatten_record_sets(spark: SparkSession, folder: str) -> DataFrame:
    sets = fetch.record_sets(_fetches(spark, folder), ["sequence_number"])
    return fetch.flatten_record_sets(sets).select("shard_id", "fetch_no", "pos", "sequence_number")


@query
def attach_envelope(spark: SparkSession, folder: str) -> DataFrame:
    rows = fetch.attach_envelope(_envelopes(spark, folder))
    return _plain(rows, "starting_sequence_number", "millis_behind_latest")


@query
def strip_envelope(spark: SparkSession, folder: str) -> DataFrame:
    log = t.log(spark, folder)
    rows = lag.committable(_fetches(spark, folder), positions.shard_tips(log), t.prior_progress(log))
    return _plain(fetch.strip_envelope(rows))


@query
def order_by_sequence(spark: SparkSession, folder: str) -> DataFrame:
    """The place of every record in string order, on sequence numbers without padding."""
    log = t.events(spark, folder).select(F.col("event_id").cast("string").alias("sequence_number"))
    return rank_by_sequence(log)


@query
def order_by_sequence_cut(spark: SparkSession, folder: str) -> DataFrame:
    """As ``order_by_sequence``, with the numbers cut into buckets as large logs are."""
    log = t.events(spark, folder).select(F.col("event_id").cast("string").alias("sequence_number"))
    return rank_by_sequence(log, window_rows=SMALL_WINDOW)


@query
def time_in_cache(spark: SparkSession, folder: str) -> DataFrame:
    """A fetch enters the cache with its last arrival and leaves it when the next fetch of its shard is there; the last
    one of a shard leaves at once."""
    summary = fetch.fetch_summary(_fetches(spark, folder)).withColumnRenamed("last_arrival_ts", "cache_entry_time")
    after = summary.select(
        "shard_id", (F.col("fetch_no") - 1).alias("fetch_no"), F.col("cache_entry_time").alias("cache_exit_time")
    )
    left = F.coalesce("cache_exit_time", "cache_entry_time")
    timed = fetch.with_time_in_cache(summary.join(after, ["shard_id", "fetch_no"], "left"), left)
    return timed.select("shard_id", "fetch_no", "time_spent_in_cache_ms")


@query
def millis_behind_latest(spark: SparkSession, folder: str) -> DataFrame:
    tips = positions.shard_tips(t.log(spark, folder))
    behind = lag.with_millis_behind(fetch.fetch_summary(_fetches(spark, folder)), tips, "last_arrival_ts")
    return behind.select("shard_id", "fetch_no", "millis_behind_latest")


# Progress


@query
def can_checkpoint(spark: SparkSession, folder: str) -> DataFrame:
    marked = progress.with_can_checkpoint(t.log(spark, folder), t.shard_status(spark))
    return marked.select("shard_id", "sequence_number", "can_checkpoint")


@query
def checkpoint_records(spark: SparkSession, folder: str) -> DataFrame:
    return progress.checkpoint_records(t.log(spark, folder), t.shard_status(spark))


@query
def checkpoint_record_sets(spark: SparkSession, folder: str) -> DataFrame:
    sets = fetch.record_sets(_fetches(spark, folder), ["sequence_number"])
    return progress.checkpoint_record_sets(sets, t.shard_status(spark))


@query
def shard_end_progress(spark: SparkSession, folder: str) -> DataFrame:
    log = t.log(spark, folder)
    status = settle(t.shard_endings(spark, log))
    committed = progress.delivered_progress(log, status)
    merged = progress.merge_progress(committed, status, t.prior_progress(log))
    return merged.select("shard_id", "sequence_number")


@query
def invalid_progress(spark: SparkSession, folder: str) -> DataFrame:
    """One shard's progress has a digit too many, another's belongs to a different shard."""
    log = t.log(spark, folder)
    tips = positions.shard_tips(log).select("shard_id", "sequence_number")
    other = tips.where("shard_id = 'shard-0'").select(F.lit("shard-2").alias("shard_id"), "sequence_number")
    stored = (
        tips.where("shard_id <> 'shard-2'")
        .withColumn(
            "sequence_number",
            F.when(F.col("shard_id") == "shard-1", F.concat("sequence_number", F.lit("9"))).otherwise(
                F.col("sequence_number")
            ),
        )
        .unionByName(other)
    )
    return progress.invalid_progress(stored, log)


@query
def backward_progress(spark: SparkSession, folder: str) -> DataFrame:
    """Shards whose new progress lies behind the stored one."""
    log = t.log(spark, folder)
    earlier, later = t.prior_progress(log), t.tips_until(log, t.LATEST_FROM)
    mixed = later.where("shard_id <> 'shard-1'").unionByName(earlier.where("shard_id = 'shard-1'"))
    return progress.backward_progress(mixed, t.tips_until(log, t.SINCE))


# Puts


@query
def route_to_shard(spark: SparkSession, folder: str) -> DataFrame:
    key = F.col("user_id").cast("string")
    return t.events(spark, folder).select("event_id", shard_of(key, t.SHARDS).alias("shard_id"))


@query_named("put_records")
def put_records_to_log(spark: SparkSession, folder: str) -> DataFrame:
    """Append all events to a log and show the results read back from it."""
    requests = t.put_requests(t.events(spark, folder))
    results = put_records(requests, new_folder(spark, "log"), t.SHARDS)
    return results.select(
        "request_id",
        "shard_id",
        "sequence_number",
        "successful",
        F.size("attempts").alias("attempts"),
        all_attempts_ok("attempts").alias("all_attempts_ok"),
    )


@query
def put_records_cut(spark: SparkSession, folder: str) -> DataFrame:
    """As ``put_records``, with shards cut into buckets as large batches are."""
    requests = t.put_requests(t.events(spark, folder))
    results = put_records(requests, new_folder(spark, "log"), t.SHARDS, window_rows=SMALL_WINDOW)
    return results.select("request_id", "shard_id", "sequence_number")


@query
def put_stream(spark: SparkSession, folder: str) -> DataFrame:
    """Requests without ids put as a stream of several batches: results, different ids and sequence numbers per shard."""
    source, log, job = (new_folder(spark, x) for x in ("requests", "log", "job"))
    requests = t.put_requests(t.events(spark, folder)).drop("request_id")
    requests.repartition(3).write.parquet(source)
    stream = spark.readStream.schema(requests.schema).option("maxFilesPerTrigger", 1).parquet(source)
    start_producer(stream, log, job, t.SHARDS, once=True).awaitTermination()
    put = spark.read.schema(f"{RECORD}, request_id string").parquet(log)
    counted = put.groupBy("shard_id").agg(F.count(F.lit(1)).alias("results"), F.countDistinct("batch_id").alias("batches"))
    for column, name in (("request_id", "request_ids"), ("sequence_number", "sequence_numbers")):
        counted = counted.join(count_different(put, "shard_id", column, name), "shard_id")
    return counted.select("shard_id", "results", "request_ids", "sequence_numbers", "batches")


def _failing_put(batch: pa.Table) -> pa.Table:
    """A fixture that stands for a service and answers by the number of the request: it fails the first attempts of most."""
    number = np.array(batch["request_id"].to_numpy(), dtype=np.int64)
    said = {"error_kind": RECORD_FAILED, "error_code": "Throttled", "error_message": "slow down"}
    return pa.table(
        {
            "shard_id": batch["routed"],
            "sequence_number": batch["request_id"],
            "successful": batch["attempt"].to_numpy() > number % 8,
            **{name: pa.repeat(value, batch.num_rows) for name, value in said.items()},
        }
    )


def _routed_requests(spark: SparkSession, folder: str) -> DataFrame:
    return t.put_requests(t.events(spark, folder)).withColumn("routed", shard_of("partition_key", t.SHARDS))


@query
def put_with_retries(spark: SparkSession, folder: str) -> DataFrame:
    """Put through a function that fails the first attempts of most records."""
    requests = _routed_requests(spark, folder)
    settings = quota.PutSettings.by_number_of_shards(t.SHARDS)
    policy = RetryPolicy(strategy=LINEAR, base_ms=0)
    settings = replace(settings, retry=policy)
    results = put_through(requests, _failing_put, settings, on_exhausted=DEAD_LETTER, limit_writers=False)
    return results.select(
        "request_id",
        "shard_id",
        "sequence_number",
        "successful",
        F.size("attempts").alias("attempts"),
        last_error_code("attempts").alias("error_code"),
    )


class _Steps(SystemClock):
    """A clock that goes on by a quarter of a second whenever it is read, and skips what it is to wait for."""

    def __init__(self):
        self.ms = 0

    def now_ms(self) -> int:
        self.ms += 250
        return self.ms

    def wait_until(self, due_ms: int) -> None:
        self.ms = max(self.ms, due_ms)


@query
def put_stream_with_retries(spark: SparkSession, folder: str) -> DataFrame:
    """A stream of requests, stopped between batches and started again, whose failed records wait until they are due.

    ``waits_kept``: between the first and the last attempt of a record lies the time that the policy asks for.
    """
    source, job = new_folder(spark, "requests"), new_folder(spark, "puts")
    requests = _routed_requests(spark, folder)
    policy = RetryPolicy(strategy=LINEAR)
    settings = replace(quota.PutSettings.by_number_of_shards(t.SHARDS), retry=policy)
    queue = PutQueue(spark, job, _failing_put, settings, DEAD_LETTER, limit_writers=False, clock=_Steps())
    for part in (0, 1):
        requests.where(F.col("request_id").cast("long") % 2 == part).repartition(2).write.mode("append").parquet(source)
        stream = spark.readStream.schema(requests.schema).option("maxFilesPerTrigger", 1).parquet(source)
        queue.start(stream, once=True).awaitTermination()
    queue.drain()
    backoff = total_backoff_ms(F.size("attempts") - 1, policy)
    return queue.results().select(
        "request_id",
        "shard_id",
        "successful",
        F.size("attempts").alias("attempts"),
        last_error_code("attempts").alias("error_code"),
        (F.col("last_ms") - F.col("first_ms") >= backoff).alias("waits_kept"),
    )


@query
def unacknowledged(spark: SparkSession, folder: str) -> DataFrame:
    """Requests that are past their retries and so have no result."""
    rows = t.events(spark, folder)
    requests = rows.select(t.padded("event_id").alias("request_id"))
    results = rows.where(t.failures() <= t.RETRIES).select(t.padded("event_id").alias("request_id"))
    return puts.unacknowledged(requests, results)


# Payloads


@query
def payload_roundtrip(spark: SparkSession, folder: str) -> DataFrame:
    data = to_bytes("props")
    return t.events(spark, folder).select(
        "event_id", to_text(data).alias("data"), F.octet_length(data).cast("bigint").alias("bytes")
    )


@query_named("decode_new_image")
def decode_image(spark: SparkSession, folder: str) -> DataFrame:
    changes = t.change_log(t.events(spark, folder))
    return decode_new_image(changes, t.IMAGE).select("sequence_number", "id", "value")


@query
def decode_nested_image(spark: SparkSession, folder: str) -> DataFrame:
    """Image values of every kind, and ways into maps and lists."""
    decoded = decode_new_image(t.nested_changes(t.events(spark, folder)), t.NESTED_IMAGE)
    return decoded.select(
        "sequence_number", "id", "even", "none", to_text("props").alias("props"), F.array_join("words", ",").alias("words"),
        F.aggregate("numbers", F.lit(0.0), lambda a, x: a + x * 2).cast("bigint").alias("twice_the_numbers"),
        to_text(F.element_at("bytes", 1)).alias("bytes"), "user", "second",
        F.array_join(F.transform("list", lambda v: v["S"]), ",").alias("list"),
        F.variant_get("map", "$.user.N", "bigint").alias("map_user"), "absent",
    )


# Attempts, retries and quotas


def _with_attempts(spark: SparkSession, folder: str) -> DataFrame:
    return t.events(spark, folder).select("event_id", t.attempts(t.failures()).alias("attempts"))


@query_named("all_attempts_ok")
def attempts_ok(spark: SparkSession, folder: str) -> DataFrame:
    return _with_attempts(spark, folder).select("event_id", all_attempts_ok("attempts").alias("all_attempts_ok"))


@query
def last_attempt_error(spark: SparkSession, folder: str) -> DataFrame:
    return _with_attempts(spark, folder).select(
        "event_id",
        last_error_code("attempts").alias("error_code"),
        last_error_message("attempts").alias("error_message"),
    )


@query
def classify_attempts(spark: SparkSession, folder: str) -> DataFrame:
    """Every attempt with what follows it. Events of type error fail in a way that is not retried."""
    kind = F.when(F.col("event_type") == "error", "connection_lost").otherwise(RECORD_FAILED)
    rows = t.events(spark, folder).select(
        "event_id", kind.alias("kind"), F.explode(t.attempts(t.failures())).alias("put")
    )
    status = classify(F.col("put.successful"), F.col("kind"), F.col("put.attempt"), RetryPolicy())
    return rows.select("event_id", F.col("put.attempt").alias("attempt"), status.alias("status"))


@query
def retry_outcome(spark: SparkSession, folder: str) -> DataFrame:
    """What the attempts that results keep come to."""
    made = _with_attempts(spark, folder).withColumn("failures", F.col("event_id") % 8)
    outcome = puts.retry_outcome(made, RetryPolicy())
    return outcome.select("event_id", "failures", "retries", "attempts_made", "status")


def _backoff(spark: SparkSession, folder: str, strategy: str) -> DataFrame:
    policy = RetryPolicy(strategy=strategy)
    rows = t.events(spark, folder).select("event_id", retries_used(t.failures(), policy).alias("retries"))
    return rows.select("event_id", "retries", total_backoff_ms("retries", policy).alias("backoff_ms"))


@query
def backoff_exponential(spark: SparkSession, folder: str) -> DataFrame:
    return _backoff(spark, folder, EXPONENTIAL)


@query
def backoff_linear(spark: SparkSession, folder: str) -> DataFrame:
    return _backoff(spark, folder, LINEAR)


@query
def attempt_schedule(spark: SparkSession, folder: str) -> DataFrame:
    """Every attempt that results keep, with the earliest time it could start."""
    linear = puts.attempt_schedule(_with_attempts(spark, folder), RetryPolicy(strategy=LINEAR))
    return linear.select(
        "event_id",
        "attempt",
        "status",
        F.col("due_ms").alias("due_linear_ms"),
        puts.due_ms("attempt", RetryPolicy(strategy=EXPONENTIAL)).alias("due_exponential_ms"),
    )


@query
def quota_by_shards(spark: SparkSession, folder: str) -> DataFrame:
    return quota.quota_by_shards(t.log(spark, folder))


@query
def pack_batches(spark: SparkSession, folder: str) -> DataFrame:
    return quota.with_batch(t.log(spark, folder)).select("shard_id", "sequence_number", "batch_no")


@query
def throttle_slots(spark: SparkSession, folder: str) -> DataFrame:
    slots = quota.with_throttle_slot(t.log(spark, folder))
    return slots.select("shard_id", "sequence_number", "batch_no", "slot_s")


@query
def throttle_slots_by_bytes(spark: SparkSession, folder: str) -> DataFrame:
    """With a byte limit low enough to hold most records back."""
    slots = quota.with_throttle_slot(t.log(spark, folder), bytes_per_second=5000)
    return slots.select("shard_id", "sequence_number", "batch_no", "slot_s")


@query
def throttle_slots_by_bytes_cut(spark: SparkSession, folder: str) -> DataFrame:
    """As ``throttle_slots_by_bytes``, with shards cut into buckets as large logs are."""
    slots = quota.with_throttle_slot(t.log(spark, folder), bytes_per_second=5000, window_rows=SMALL_WINDOW)
    return slots.select("shard_id", "sequence_number", "batch_no", "slot_s")


@query
def departures(spark: SparkSession, folder: str) -> DataFrame:
    """When records go out under limits that hold in every second, low enough to hold many records back."""
    timed = quota.with_departure(t.log(spark, folder), records_per_second=1, bytes_per_second=20)
    return timed.select("shard_id", "sequence_number", F.unix_micros("departure_ts").alias("departure_us"))


@query
def departures_cut(spark: SparkSession, folder: str) -> DataFrame:
    """As ``departures``, with shards cut into buckets as large logs are."""
    timed = quota.with_departure(t.log(spark, folder), 1, 20, window_rows=SMALL_WINDOW)
    return timed.select("shard_id", "sequence_number", F.unix_micros("departure_ts").alias("departure_us"))


@query
def order_by_uneven_sequence(spark: SparkSession, folder: str) -> DataFrame:
    """The place of every record where the sequence numbers have no prefixes to cut at: hashes, and a few long runs."""
    number = F.when(F.col("event_id") % 3 == 0, F.concat(F.lit("7" * 30), t.padded("event_id")))
    log = t.events(spark, folder).select(F.coalesce(number, F.md5(F.col("event_id").cast("string"))).alias("sequence_number"))
    return rank_by_sequence(log, window_rows=16)


# User functions


@query
def apply_per_shard(spark: SparkSession, folder: str) -> DataFrame:
    """A user function on every record set, put together per shard."""

    def measure(records: pa.Table) -> pa.Table:
        last = records.slice(records.num_rows - 1)
        return pa.table(
            {
                "shard_id": last["shard_id"],
                "records": [records.num_rows],
                "bytes": [pc.sum(pc.binary_length(records["data"])).as_py()],
                "last": last["sequence_number"],
            }
        ).cast(result)

    result = pa.schema(
        [("shard_id", pa.string()), ("records", pa.int64()), ("bytes", pa.int64()), ("last", pa.string())]
    )
    fetches = _fetches(spark, folder).select("shard_id", "fetch_no", "sequence_number", "data")
    measured = process_record_sets(
        fetches, measure, "shard_id string, records bigint, bytes bigint, last string"
    )
    return measured.groupBy("shard_id").agg(
        F.sum("records").alias("records"), F.sum("bytes").alias("bytes"), F.max("last").alias("last_sequence_number")
    )


@query
def shard_processor(spark: SparkSession, folder: str) -> DataFrame:
    """Running totals per shard over two runs with shards ending in both, the second from the states of the first."""

    def advance(state: dict, part: dict) -> tuple[dict, list[dict]]:
        state = {**state, "records": state["records"] + part["records"], "bytes": state["bytes"] + part["bytes"]}
        return state, [{**state, "last": part["last"], "reason": None}]

    fields = "shard_id string, records bigint, bytes bigint"
    processor = ShardProcessor(
        initialise=lambda shard: {"shard_id": shard, "records": 0, "bytes": 0},
        process=lambda records: {
            "records": records.num_rows,
            "bytes": pc.sum(pc.binary_length(records["data"])).as_py() or 0,
            "last": records["sequence_number"][-1].as_py(),
        },
        advance=advance,
        end=lambda state, reason: [{**state, "last": None, "reason": reason}],
        state=fields,
        part="records bigint, bytes bigint, last string",
        output=f"{fields}, last string, reason string",
    )
    log = t.log(spark, folder)
    early = F.col("arrival_ts") < F.lit(t.PROGRESS_UNTIL).cast("timestamp")
    first = settle(process_shards(log.where(early), processor, max_records=500))
    status = settle(t.shard_endings(spark, log))
    second = process_shards(log.where(~early), processor, shard_states(first), status, max_records=500)
    return shard_outputs(first.unionByName(second))


# A shard that was read to its end is not read again; one that ended with records unread goes on after them.


@query
def resume_after_shard_end(spark: SparkSession, folder: str) -> DataFrame:
    """Of two terminated shards ``shard-1`` was read to its end, ``shard-3`` up to a date."""
    log = t.log(spark, folder)
    status = settle(t.shard_endings(spark, log))
    stopped = t.prior_progress(log).where("shard_id <> 'shard-1'")
    delivered = stopped.unionByName(positions.shard_tips(log).where("shard_id = 'shard-1'").select("shard_id", "sequence_number"))
    merged = progress.merge_progress(delivered, status, None)
    return positions.resume(log, merged).select("shard_id", "sequence_number")
