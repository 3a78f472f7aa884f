"""The given tables seen as a log of four shards, and the small tables the queries need with it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shardstream.functions.payload import to_bytes
from shardstream.functions.routing import shard_of
from shardstream.model import ATTEMPTS, TERMINATE
from shardstream.operators.positions import shard_tips
from shardstream.sources.log import append_slice

SHARDS = 4
STREAM = "events"
FETCH_RECORDS = 500

# Most that one micro-batch reads.
BATCH_BYTES = 256 * 1024**3

# Days that one slice of the log holds, from its first day on; the last slice holds all that follows.
SLICE_DAYS, SLICES, FIRST_DAY = 6, 5, "2024-01-01"

# Fixed values of the test log: dates that cut it, and the state of each shard.
PROGRESS_UNTIL = "2024-01-10"
LATEST_FROM = "2024-01-25"
SINCE = "2024-01-15"
SHARD_STATUS = (("shard-0", None), ("shard-1", "TERMINATE"), ("shard-2", "ZOMBIE"), ("shard-3", None))

RETRIES = 5


def events(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/events.parquet")


def events_stream(spark: SparkSession, folder: str) -> DataFrame:
    """The events as a stream. A pattern, because a plain path would have to be a folder."""
    reader = spark.readStream.schema(events(spark, folder).schema).option("maxBytesPerTrigger", BATCH_BYTES)
    return reader.parquet(f"{folder}/events.parque[t]")


def padded(number: Column | str) -> Column:
    return F.lpad(F.col(number).cast("string") if isinstance(number, str) else number.cast("string"), 20, "0")


def as_log(rows: DataFrame) -> DataFrame:
    """Events as RECORD rows; also works on a stream of events."""
    key = F.col("user_id").cast("string")
    return rows.select(
        F.lit(STREAM).alias("stream_name"),
        shard_of(key, SHARDS).alias("shard_id"),
        padded("event_id").alias("sequence_number"),
        key.alias("partition_key"),
        to_bytes("props").alias("data"),
        F.col("ts").cast("timestamp").alias("arrival_ts"),
    )


def log(spark: SparkSession, folder: str) -> DataFrame:
    return as_log(events(spark, folder))


def slice_of(arrival: Column | str) -> Column:
    """The slice that a record is appended with."""
    days = F.floor((F.unix_timestamp(arrival) - F.unix_timestamp(F.lit(FIRST_DAY).cast("timestamp"))) / (86400 * SLICE_DAYS))
    return F.least(F.greatest(days, F.lit(0)), F.lit(SLICES - 1))


def append_slices(records: DataFrame, folder: str) -> str:
    """Write the log to ``folder`` slice by slice, in the order of arrival."""
    for number in range(SLICES):
        append_slice(records.where(slice_of("arrival_ts") == number), folder, number)
    return folder


def shard_status(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(SHARD_STATUS, "shard_id string, shutdown_reason string")


def shard_endings(spark: SparkSession, records: DataFrame) -> DataFrame:
    """The status of shards, two of them terminated: ``shard-1`` ends with its last record, ``shard-3`` with one
    that has not been delivered."""
    tips = shard_tips(records).select("shard_id", "sequence_number")
    terminated = F.col("shard_id").isin("shard-1", "shard-3")
    ending = F.when(F.col("shard_id") == "shard-3", F.concat("sequence_number", F.lit("9"))).otherwise(F.col("sequence_number"))
    return (
        shard_status(spark)
        .join(tips, "shard_id", "left")
        .select(
            "shard_id",
            F.when(terminated, TERMINATE).otherwise(F.col("shutdown_reason")).alias("shutdown_reason"),
            F.when(terminated, ending).alias("ending_sequence_number"),
        )
    )


def tips_until(records: DataFrame, day: str) -> DataFrame:
    return shard_tips(records.where(F.col("arrival_ts") < F.lit(day).cast("timestamp"))).select(
        "shard_id", "sequence_number"
    )


def prior_progress(records: DataFrame) -> DataFrame:
    return tips_until(records, PROGRESS_UNTIL)


def failures(event_id: Column | str = "event_id") -> Column:
    """Failed attempts of a record before one succeeds."""
    return (F.col(event_id) if isinstance(event_id, str) else event_id) % 8


def attempts(failed: Column) -> Column:
    """The attempts list of a record: attempt i succeeds iff more than ``failed`` were made."""
    tries = F.sequence(F.lit(1), (F.least(failed, F.lit(RETRIES)) + 1).cast("int"))
    return F.transform(
        tries,
        lambda i: F.struct(
            i.alias("attempt"),
            (i > failed).alias("successful"),
            F.when(i <= failed, "Throttled").alias("error_code"),
            F.when(i <= failed, F.concat(F.lit("slow down "), i.cast("string"))).alias("error_message"),
        ),
    ).cast(ATTEMPTS)


def change_log(rows: DataFrame) -> DataFrame:
    """Events as change records: the payload is the JSON of an inserted item."""
    item = F.struct(
        F.struct(F.col("user_id").cast("string").alias("N")).alias("Id"),
        F.struct(F.col("event_type").alias("S")).alias("Value"),
    )
    payload = F.to_json(F.struct(F.lit("INSERT").alias("eventName"), F.struct(item.alias("NewImage")).alias("dynamodb")))
    key = F.col("user_id").cast("string")
    return rows.select(
        F.lit(STREAM).alias("stream_name"),
        shard_of(key, SHARDS).alias("shard_id"),
        padded("event_id").alias("sequence_number"),
        key.alias("partition_key"),
        to_bytes(payload).alias("data"),
        F.col("ts").cast("timestamp").alias("arrival_ts"),
    )


def nested_changes(rows: DataFrame) -> DataFrame:
    """Change records whose images hold values of every kind."""
    user, kind = F.col("user_id").cast("string"), F.col("event_type")

    def value(tag: str, of: Column) -> Column:
        return F.struct(of.alias(tag))

    lists = F.array(value("S", kind), value("S", user))
    inside = F.struct(value("N", user).alias("user"), value("L", lists).alias("two words"))
    item = F.struct(
        value("N", user).alias("Id"),
        value("BOOL", F.col("event_id") % 2 == 0).alias("even"),
        value("NULL", F.lit(True)).alias("none"),
        value("B", F.base64(to_bytes("props"))).alias("props"),
        value("SS", F.array(kind, user)).alias("words"),
        value("NS", F.array(user, F.concat(user, F.lit(".5")))).alias("numbers"),
        value("BS", F.array(F.base64(to_bytes(kind)))).alias("bytes"),
        value("M", inside).alias("map"),
    )
    payload = F.to_json(F.struct(F.lit("MODIFY").alias("eventName"), F.struct(item.alias("NewImage")).alias("dynamodb")))
    return as_log(rows.select("event_id", "user_id", "ts", payload.alias("props")))


NESTED_IMAGE = {
    "id": ("Id", "N", "bigint"),
    "even": ("even", "BOOL", "boolean"),
    "none": ("none", "NULL", "boolean"),
    "props": ("props", "B", "binary"),
    "words": ("words", "SS", "array<string>"),
    "numbers": ("numbers", "NS", "array<double>"),
    "bytes": ("bytes", "BS", "array<binary>"),
    "user": (("map", "user"), "N", "bigint"),
    "second": (("map", "two words", 1), "S", "string"),
    "list": (("map", "two words"), "L", "array<struct<S: string>>"),
    "map": ("map", "M", "variant"),
    "absent": ("absent", "S", "string"),
}


IMAGE = {"id": ("Id", "N", "bigint"), "value": ("Value", "S", "string")}


def put_requests(rows: DataFrame) -> DataFrame:
    """Events as put requests. ``arrival_ts`` keeps the times of the test data."""
    return rows.select(
        padded("event_id").alias("request_id"),
        F.lit(STREAM).alias("stream_name"),
        F.col("user_id").cast("string").alias("partition_key"),
        to_bytes("props").alias("data"),
        F.col("ts").cast("timestamp").alias("arrival_ts"),
    )
