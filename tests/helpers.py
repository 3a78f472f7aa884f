from pyspark.sql import functions as F

from shardstream.model import RECORD


def rows(frame, *columns):
    """All rows as a sorted list of tuples."""
    frame = frame.select(*columns) if columns else frame
    return sorted((tuple(r) for r in frame.collect()), key=lambda r: tuple((v is not None, str(v)) for v in r))


def records(spark, *triples):
    """RECORD rows from (shard, sequence, text) with arrivals one second apart."""
    made = spark.createDataFrame(
        [(shard, sequence, text, i) for i, (shard, sequence, text) in enumerate(triples)],
        "shard_id string, sequence_number string, text string, i int",
    )
    return made.select(
        F.lit("s").alias("stream_name"),
        "shard_id",
        "sequence_number",
        F.lit("k").alias("partition_key"),
        F.encode("text", "UTF-8").alias("data"),
        F.timestamp_seconds(F.col("i") + 1_700_000_000).alias("arrival_ts"),
    ).to(spark.createDataFrame([], RECORD).schema)
