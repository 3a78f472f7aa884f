"""Writing records: to the parquet log, or through a user's put function with retries."""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from shardstream.functions.retry import RECORD_FAILED, RetryPolicy, delay_ms
from shardstream.functions.routing import shard_of
from shardstream.model import PUT_RESULT, RECORD_COLUMNS, SEQUENCE_PART
from shardstream.operators.ordering import with_position
from shardstream.operators.quota import PutSettings
from shardstream.sources.folders import batch_folder, is_complete
from shardstream.sources.log import append_slice

# Longest pause inside a task. A record whose delay is longer is given back to be put later (see puts.due_later).
LONGEST_PAUSE_MS = 60_000

RAISE = "raise"
DEAD_LETTER = "dead_letter"

# A put function gets the requests with the number of the attempt, and answers with one row per request
# in the same order.
PutFunction = Callable[[pa.Table], pa.Table]
ANSWER_COLUMNS = ["shard_id", "sequence_number", "successful", "error_kind", "error_code", "error_message"]


class PutFailed(RuntimeError):
    """A record could not be put, or the put function failed as a whole."""


def identify_requests(requests: DataFrame, batch_id: int = 0) -> DataFrame:
    """Give requests without one a ``request_id``: the batch, and a place that no other request of the batch has.

    The places are those of one evaluation. Whoever needs the same ids twice, as ``unacknowledged`` does, writes the
    requests first; ``put_records`` stores the ids with the records.
    """
    if "request_id" in requests.columns:
        return requests
    place = F.lpad(F.monotonically_increasing_id().cast("string"), SEQUENCE_PART, "0")
    return requests.withColumn("request_id", F.concat(F.lit(f"{batch_id:0{SEQUENCE_PART}d}"), place))


def route_requests(requests: DataFrame, shards: int) -> DataFrame:
    """Add the shard of each request. A request without partition key stops the job."""
    key = F.when(
        F.col("partition_key").isNull(), F.raise_error(F.lit("a put request needs a partition key"))
    ).otherwise(F.col("partition_key"))
    return requests.withColumn("shard_id", shard_of(key, shards))


def assign_sequence(requests: DataFrame, batch_id: int, window_rows: int | None = None) -> DataFrame:
    """Number routed requests per shard in the order of their ids.

    The numbers depend on the requests alone, so running a batch again assigns the same ones. A number without room
    stops the job.
    """
    placed = with_position(requests, order="request_id", into="_position", window_rows=window_rows)
    place = F.col("_position").cast("string")
    full = F.raise_error(F.lit(f"a shard has more records than {SEQUENCE_PART} digits can number"))
    place = F.when(F.length(place) > SEQUENCE_PART, full).otherwise(F.lpad(place, SEQUENCE_PART, "0"))
    if len(str(batch_id)) > SEQUENCE_PART:
        raise ValueError(f"batch {batch_id} has more than {SEQUENCE_PART} digits")
    batch = f"{batch_id:0{SEQUENCE_PART}d}"
    return placed.withColumn("sequence_number", F.concat(F.lit(batch), place)).drop("_position")


def put_records(
    requests: DataFrame,
    log: str,
    shards: int,
    batch_id: int = 0,
    arrival: Column | None = None,
    in_order: bool = False,
    window_rows: int | None = None,
) -> DataFrame:
    """Append requests to a log and return one result per record, read from what was written.

    Requests may have their own ``arrival_ts``; otherwise it is ``arrival``, or now. Requests with ids are numbered in
    their order; those without get an id as they are read, which is their sequence number too, and are read
    once. A batch whose slice is complete is not put again.
    """
    spark, target = requests.sparkSession, batch_folder(log, batch_id)
    if not is_complete(spark, target):
        given = "request_id" in requests.columns
        requests = identify_requests(requests, batch_id)
        if arrival is not None or "arrival_ts" not in requests.columns:
            requests = requests.withColumn("arrival_ts", F.current_timestamp() if arrival is None else arrival)
        routed = route_requests(requests, shards)
        if given:
            numbered = assign_sequence(routed, batch_id, window_rows)
        else:
            numbered = routed.withColumn("sequence_number", F.col("request_id"))
        append_slice(numbered.select(*RECORD_COLUMNS, "request_id"), log, batch_id, in_order)
    return put_results(spark.read.parquet(target))


def put_results(written: DataFrame) -> DataFrame:
    """Results of records that are stored: one successful attempt each."""
    attempt = F.struct(
        F.lit(1).alias("attempt"),
        F.lit(True).alias("successful"),
        F.lit(None).cast("string").alias("error_code"),
        F.lit(None).cast("string").alias("error_message"),
    )
    return written.select(
        "request_id", "shard_id", "sequence_number", F.lit(True).alias("successful"), F.array(attempt).alias("attempts")
    )


def start_producer(
    requests: DataFrame,
    log: str,
    job: str,
    shards: int,
    on_results: Callable[[DataFrame, int], None] | None = None,
    once: bool = False,
    **trigger: str,
) -> StreamingQuery:
    """Append a stream of requests to a log, batch by batch; ``on_results`` gets each batch's results."""

    def run(batch: DataFrame, batch_id: int) -> None:
        results = put_records(batch, log, shards, batch_id)
        if on_results is not None:
            on_results(results, batch_id)

    writer = requests.writeStream.foreachBatch(run).option("checkpointLocation", f"{job.rstrip('/')}/checkpoint")
    if once:
        trigger = {"availableNow": True}
    return (writer.trigger(**trigger) if trigger else writer).start()


def finish(query: StreamingQuery) -> None:
    """Wait until everything that has arrived is written, then stop."""
    try:
        query.processAllAvailable()
    finally:
        query.stop()


def spread_writers(requests: DataFrame, settings: PutSettings) -> DataFrame:
    """Spread requests over the configured number of parallel writers, hot shards included."""
    return requests.repartition(settings.parallelism, F.xxhash64("request_id"))


def spread_unlimited(requests: DataFrame) -> DataFrame:
    """Deal requests out evenly to all cores: a file of new ones beside small ones of retries is all but one task."""
    tasks = max(requests.sparkSession.sparkContext.defaultParallelism, requests.rdd.getNumPartitions())
    return requests.repartition(tasks, F.xxhash64("request_id"))


class _Pace:
    """Holds calls back, so that records and bytes of one writer stay within its part of the limits per second."""

    def __init__(self, records_per_second: float, bytes_per_second: float):
        self.limits, self.used, self.begun = (records_per_second, bytes_per_second), [0, 0], time.monotonic()

    def wait(self, records: int, size: int) -> None:
        spent = max(used / limit for used, limit in zip(self.used, self.limits, strict=True))
        time.sleep(max(0.0, spent - (time.monotonic() - self.begun)))
        self.used = [self.used[0] + records, self.used[1] + size]


def put_through(
    requests: DataFrame,
    put: PutFunction,
    settings: PutSettings,
    on_exhausted: str = RAISE,
    longest_pause_ms: int = LONGEST_PAUSE_MS,
    limit_writers: bool = True,
    with_requests: bool = False,
) -> DataFrame:
    """Put requests with a user's function and return one result per request.

    Requests go to ``parallelism`` writers, each of which keeps to its part of the records and bytes per second.
    Without ``limit_writers`` requests are put where they are read, as fast as they are answered.

    Each call gets at most ``max_batch_size`` requests. Records that fail are put again, not before the retry policy
    allows, together with the others that failed. A record whose delay is longer than ``longest_pause_ms`` is given
    back: its result is unsuccessful and has fewer attempts than the policy allows. ``puts.due_later`` finds these;
    put through again with their ``attempts``, they go on where they were. A record past its retries stops the
    job, or becomes an unsuccessful result with ``on_exhausted="dead_letter"``. Any other error stops the job.
    A task that is run again puts its records again. ``with_requests`` adds the columns of the requests to their results.
    """
    if on_exhausted not in (RAISE, DEAD_LETTER):
        raise ValueError(f"on_exhausted must be {RAISE!r} or {DEAD_LETTER!r}, not {on_exhausted!r}")
    policy, size = settings.retry, settings.max_batch_size
    share = (settings.max_records_per_second, settings.max_bytes_per_second)
    share = tuple(x / settings.parallelism for x in share) if limit_writers else (float("inf"), float("inf"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pace = _Pace(*share)
        for batch in batches:
            for start in range(0, batch.num_rows, size):
                part = batch.slice(start, size)
                results = _put_until_done(part, put, policy, on_exhausted, longest_pause_ms, pace)
                for name in kept:
                    results = results.append_column(name, part[name])
                yield results

    requests = identify_requests(requests)
    if limit_writers:
        requests = spread_writers(requests, settings)
    schema = StructType.fromDDL(PUT_RESULT)
    kept = [f.name for f in requests.schema if with_requests and f.name not in (*schema.names, "wait_ms")]
    return requests.mapInArrow(run, StructType([*schema, *(requests.schema[name] for name in kept)]))


def _put_until_done(
    requests: pa.RecordBatch,
    put: PutFunction,
    policy: RetryPolicy,
    on_exhausted: str,
    longest_pause_ms: int,
    pace: _Pace,
) -> pa.RecordBatch:
    """Put one request batch until every record is done or due later; one result per request, in their order."""
    rounds: list[tuple[np.ndarray, pa.Table]] = []
    waiting = np.arange(requests.num_rows)
    known = "attempts" in requests.schema.names
    earlier = requests["attempts"] if known else pa.nulls(requests.num_rows, pa.list_(pa.null()))
    made = pc.fill_null(pc.list_value_length(earlier), 0).to_numpy(zero_copy_only=False).astype(np.int32)
    asked = requests.drop_columns([c for c in ("attempts", "wait_ms") if c in requests.schema.names])
    sizes = pc.fill_null(pc.binary_length(requests["data"]), 0).to_numpy(zero_copy_only=False)
    while len(waiting):
        pace.wait(len(waiting), int(sizes[waiting].sum()))
        number = pa.array(made[waiting] + 1, pa.int32())
        answers = put(pa.table(asked.take(pa.array(waiting))).append_column("attempt", number))
        if answers.num_rows != len(waiting):
            raise PutFailed(f"the put function answered {answers.num_rows} of {len(waiting)} requests")
        rounds.append((waiting, answers.select(ANSWER_COLUMNS).append_column("attempt", number)))
        made[waiting] += 1
        failed = pc.invert(answers["successful"]).to_numpy()
        record_level = pc.fill_null(pc.equal(answers["error_kind"], RECORD_FAILED), False).to_numpy()
        spent = made[waiting] > policy.max_retries
        fatal = failed & (~record_level | (spent & (on_exhausted == RAISE)))
        if fatal.any():
            at = int(fatal.argmax())
            said = answers.slice(at, 1).to_pylist()[0]
            request = requests["request_id"][int(waiting[at])].as_py()
            raise PutFailed(
                f"request {request} is given up after attempt {made[waiting[at]]}:"
                f" {said['error_code']} ({said['error_message']})"
            )
        waiting = waiting[failed & ~spent]
        tries, of_try = np.unique(made[waiting], return_inverse=True)
        pauses = np.array([delay_ms(policy.strategy, policy.base_ms, int(a)) for a in tries], dtype=np.float64)[of_try]
        soon = pauses <= longest_pause_ms
        waiting = waiting[soon]
        if len(waiting):
            time.sleep(pauses[soon].max() / 1000)
    return _results(requests["request_id"], rounds, earlier if known else None)


def _results(
    request_ids: pa.Array, rounds: list[tuple[np.ndarray, pa.Table]], earlier: pa.ListArray | None
) -> pa.RecordBatch:
    """Results from the answers of each round, given with the requests they belong to, after earlier attempts."""
    row = np.concatenate([rows for rows, _ in rounds])
    made = pa.concat_tables([answers for _, answers in rounds]).take(pa.array(np.argsort(row, kind="stable")))
    made = made.combine_chunks()
    ends = np.cumsum(np.bincount(row, minlength=len(request_ids)))
    ok = made["successful"]
    nothing = pa.scalar(None, pa.string())

    def text(name: str, when: pa.ChunkedArray) -> pa.Array:
        return pc.if_else(when, made[name].cast(pa.string()), nothing).combine_chunks()

    failed = pc.invert(ok)
    attempts = pa.StructArray.from_arrays(
        [made["attempt"].combine_chunks(), ok.combine_chunks(), text("error_code", failed), text("error_message", failed)],
        ["attempt", "successful", "error_code", "error_message"],
    )
    last = pa.array(ends - 1)
    all_ends = ends
    if earlier is not None:
        before = pc.fill_null(pc.list_value_length(earlier), 0).to_numpy(zero_copy_only=False)
        rows = np.concatenate([np.repeat(np.arange(len(request_ids)), before), np.sort(row, kind="stable")])
        both = pa.concat_arrays([earlier.flatten().cast(attempts.type), attempts])
        attempts = both.take(pa.array(np.argsort(rows, kind="stable")))
        all_ends = np.cumsum(np.bincount(rows, minlength=len(request_ids)))
    return pa.RecordBatch.from_arrays(
        [
            request_ids,
            text("shard_id", ok).take(last),
            text("sequence_number", ok).take(last),
            ok.combine_chunks().take(last),
            pa.ListArray.from_arrays(pa.array(np.concatenate([[0], all_ends]), pa.int32()), attempts),
        ],
        ["request_id", "shard_id", "sequence_number", "successful", "attempts"],
    )
