"""Bounded fetches, record sets, and going back to single records."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shardstream.model import COMMITTABLE_COLUMNS, RECORD_COLUMNS, SET_RECORD_FIELDS
from shardstream.operators.ordering import with_position

DEFAULT_MAX_RECORDS = 10_000


def with_fetch(
    records: DataFrame,
    max_records: int = DEFAULT_MAX_RECORDS,
    max_bytes: int | None = None,
    window_rows: int | None = None,
) -> DataFrame:
    """Cut every shard, in sequence order, into fetches of at most ``max_records`` records.

    With ``max_bytes`` the payloads before the last record of a fetch are fewer bytes than that, so a fetch holds at most
    ``max_bytes`` and one record; fetch numbers go up but may leave some out. Payloads are read for this.
    """
    if max_records < 1 or (max_bytes is not None and max_bytes < 1):
        raise ValueError("max_records and max_bytes must be at least 1")
    by_records = F.expr(f"fetch_no div {int(max_records)}")
    if max_bytes is None:
        return with_position(records, into="fetch_no", window_rows=window_rows).withColumn("fetch_no", by_records)
    size = F.coalesce(F.octet_length("data"), F.lit(0)).cast("bigint")
    numbered = with_position(records, also={"_bytes_before": size}, into="fetch_no", window_rows=window_rows)
    by_bytes = F.expr(f"_bytes_before div {int(max_bytes)}")
    return numbered.withColumn("fetch_no", by_records + by_bytes).drop("_bytes_before")


def fetch_summary(fetches: DataFrame) -> DataFrame:
    """One row per fetch: its size, last sequence number and last arrival."""
    return fetches.groupBy("shard_id", "fetch_no").agg(
        F.count(F.lit(1)).alias("records"),
        F.max("sequence_number").alias("last_sequence_number"),
        F.max("arrival_ts").alias("last_arrival_ts"),
    )


def record_sets(fetches: DataFrame, fields: Sequence[str] = SET_RECORD_FIELDS) -> DataFrame:
    """One row per fetch with its records as an array in sequence order.

    An array holds at most one fetch, so ``with_fetch`` bounds it. ``cache_entry_time`` is the last
    arrival in the fetch. ``fields`` are those of a record that are needed, the sequence number first; others are
    not moved.
    """
    record = F.struct(*fields)
    return fetches.groupBy("shard_id", "fetch_no").agg(
        F.array_sort(F.collect_list(record)).alias("records"),
        F.max("arrival_ts").alias("cache_entry_time"),
    )


def flatten_record_sets(sets: DataFrame) -> DataFrame:
    """One row per record, with its place ``pos`` in the set; every other column is repeated."""
    kept = [c for c in sets.columns if c != "records"]
    exploded = sets.select(*kept, F.posexplode("records").alias("pos", "record"))
    return exploded.select(*kept, "pos", "record.*")


def attach_envelope(sets: DataFrame) -> DataFrame:
    """Committable records: each record with its set's shard, starting sequence and lag."""
    return flatten_record_sets(sets).select(*COMMITTABLE_COLUMNS)


def strip_envelope(committable: DataFrame) -> DataFrame:
    """The bare records of committable ones."""
    return committable.select(*RECORD_COLUMNS)


def time_in_cache_ms(entry: Column | str, exit_: Column | str) -> Column:
    """Whole milliseconds between entering and leaving the cache."""
    return F.timestamp_diff("MILLISECOND", F.col(entry) if isinstance(entry, str) else entry,
                            F.col(exit_) if isinstance(exit_, str) else exit_)


def with_time_in_cache(sets: DataFrame, exit_time: Column | None = None) -> DataFrame:
    """Add the exit time (now, unless given) and the time spent in the cache."""
    if exit_time is not None or "cache_exit_time" not in sets.columns:
        sets = sets.withColumn("cache_exit_time", F.current_timestamp() if exit_time is None else exit_time)
    return sets.withColumn("time_spent_in_cache_ms", time_in_cache_ms("cache_entry_time", "cache_exit_time"))
