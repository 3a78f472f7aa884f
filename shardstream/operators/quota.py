"""Producer limits per shard: batches, and the earliest second a record may go out."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shardstream.functions.retry import RetryPolicy
from shardstream.operators.ordering import MAX, Scan, sums_before, with_position

# Fixed limits of the log service: records per request, records and bytes per shard and second.
MAX_RECORDS_PER_REQUEST = 500
MAX_RECORDS_PER_SHARD_PER_SECOND = 1000
MAX_BYTES_PER_SHARD_PER_SECOND = 1_000_000

MICROS = 1_000_000


@dataclass(frozen=True)
class PutSettings:
    parallelism: int
    max_batch_size: int
    max_records_per_second: int
    max_bytes_per_second: int
    retry: RetryPolicy = field(default_factory=RetryPolicy)

    def __post_init__(self):
        limits = (self.parallelism, self.max_batch_size, self.max_records_per_second, self.max_bytes_per_second)
        if min(limits) < 1:
            raise ValueError("every limit must be at least 1")

    @classmethod
    def by_number_of_shards(cls, shards: int) -> PutSettings:
        """Settings that use the whole quota of ``shards`` shards."""
        per_shard = MAX_RECORDS_PER_SHARD_PER_SECOND // MAX_RECORDS_PER_REQUEST
        return cls(
            parallelism=shards * per_shard,
            max_batch_size=MAX_RECORDS_PER_REQUEST,
            max_records_per_second=shards * MAX_RECORDS_PER_SHARD_PER_SECOND,
            max_bytes_per_second=shards * MAX_BYTES_PER_SHARD_PER_SECOND,
        )


def quota_by_shards(records: DataFrame) -> DataFrame:
    """The quota of the shards that occur in ``records``, as one row."""
    one = PutSettings.by_number_of_shards(1)
    shards = F.col("shards")
    return (
        records.select("shard_id")
        .distinct()
        .agg(F.count("shard_id").cast("int").alias("shards"))
        .select(
            shards,
            (shards * one.parallelism).alias("parallelism"),
            F.lit(one.max_batch_size).alias("max_batch_size"),
            (shards * one.max_records_per_second).alias("max_records_per_second"),
            (shards * one.max_bytes_per_second).alias("max_bytes_per_second"),
            F.lit(one.retry.max_retries).alias("max_retries"),
            F.lit(one.retry.base_ms).alias("base_ms"),
        )
    )


def with_batch(
    records: DataFrame, max_batch_size: int = MAX_RECORDS_PER_REQUEST, window_rows: int | None = None
) -> DataFrame:
    """Pack each shard's records, in order, into requests of at most ``max_batch_size``. Payloads are not read for it."""
    placed = with_position(records, into="_rows_before", window_rows=window_rows)
    return placed.withColumn("batch_no", _per_shard_batch(max_batch_size)).drop("_rows_before")


def with_throttle_slot(
    records: DataFrame,
    max_batch_size: int = MAX_RECORDS_PER_REQUEST,
    records_per_second: int = MAX_RECORDS_PER_SHARD_PER_SECOND,
    bytes_per_second: int = MAX_BYTES_PER_SHARD_PER_SECOND,
    window_rows: int | None = None,
) -> DataFrame:
    """Batch number, and earliest second from the start under both limits of the shard.

    The limits are budgets that add up: by the end of second ``s`` at most
    ``(s + 1) * records_per_second`` records are out, and a record starts only while the bytes before
    it stay below ``(s + 1) * bytes_per_second``. A budget left over in one second may be used later.
    """
    slot = F.greatest(
        F.expr(f"_rows_before div {int(records_per_second)}"), F.expr(f"_bytes_before div {int(bytes_per_second)}")
    )
    size = F.coalesce(F.octet_length("data"), F.lit(0)).cast("bigint")
    placed = with_position(records, also={"_bytes_before": size}, into="_rows_before", window_rows=window_rows)
    return placed.withColumns({"batch_no": _per_shard_batch(max_batch_size), "slot_s": slot}).drop(*_PLACE)


def with_departure(
    records: DataFrame,
    records_per_second: int = MAX_RECORDS_PER_SHARD_PER_SECOND,
    bytes_per_second: int = MAX_BYTES_PER_SHARD_PER_SECOND,
    window_rows: int | None = None,
) -> DataFrame:
    """The time at which each record goes out, ``departure_ts``, under limits that hold in every second.

    Records of a shard go out in sequence order, none before it has arrived. Each keeps the shard busy for the longer of a
    record's part of a second and the time its bytes take; the next one goes out after that. So no second, wherever it
    begins, holds more than ``records_per_second`` records, or payloads that with all but its last record come to
    ``bytes_per_second`` or more. A shard that has had nothing to send saves nothing up.

    The departure after all before it is the largest, over a record and those before it, of an arrival and the time
    that the records from there on take: a running sum and a running maximum, which need no task per shard.
    """
    busy = F.greatest(
        F.lit(-(-MICROS // records_per_second)), F.expr(f"(_bytes * {MICROS} + {bytes_per_second - 1}) div {bytes_per_second}")
    )
    size = F.coalesce(F.octet_length("data"), F.lit(0)).cast("bigint")
    timed = records.withColumn("_bytes", size).withColumn("_busy", busy).drop("_bytes")
    before = sums_before(timed, ["shard_id"], "sequence_number", {"_busy_before": F.col("_busy")}, window_rows=window_rows)
    idle = F.unix_micros("arrival_ts") - F.col("_busy_before")
    ready = sums_before(
        before.withColumn("_idle", idle), ["shard_id"], "sequence_number", {"_idle_before": Scan(F.col("_idle"), MAX)},
        window_rows=window_rows,
    )
    departure = F.timestamp_micros(F.col("_busy_before") + F.greatest("_idle_before", "_idle"))
    return ready.withColumn("departure_ts", departure).drop("_busy", "_busy_before", "_idle", "_idle_before")


_PLACE = ("_rows_before", "_bytes_before")


def _per_shard_batch(max_batch_size: int):
    return F.expr(f"_rows_before div {int(max_batch_size)}")
