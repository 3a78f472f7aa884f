"""How far reading is behind the end of each shard."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shardstream.operators.fetch import fetch_summary
from shardstream.operators.positions import shard_tips, with_starting_sequence
from shardstream.operators.shards import join_shards, join_small
from shardstream.session import settle


def behind_ms(last: Column | str, tip: Column | str) -> Column:
    """Whole milliseconds from the last record of a fetch to the shard's tip."""
    return F.timestamp_diff("MILLISECOND", F.col(last) if isinstance(last, str) else last,
                            F.col(tip) if isinstance(tip, str) else tip)


def with_millis_behind(
    rows: DataFrame, tips: DataFrame, last: str, salt_by: str = "fetch_no", settled: bool = False
) -> DataFrame:
    """Add the lag of rows that know their fetch's last arrival."""
    joined = join_shards(rows, tips.select("shard_id", "tip_ts"), salt_by=salt_by, settled=settled)
    return joined.withColumn("millis_behind_latest", behind_ms(last, "tip_ts")).drop("tip_ts")


def committable(
    fetches: DataFrame, tips: DataFrame | None = None, progress: DataFrame | None = None, settled: bool = False
) -> DataFrame:
    """Records of fetches with starting sequence and lag, both constant over one fetch.

    ``tips`` default to the ends of the given records. ``settled`` tells that tips and progress are
    cheap to read again and will not change. The last arrival of each fetch comes from narrow columns and is joined, so
    that payloads move for the numbering of fetches only.
    """
    tips = shard_tips(fetches) if tips is None else tips
    keys = ["shard_id", "fetch_no"]
    last = settle(fetch_summary(fetches).select(*keys, F.col("last_arrival_ts").alias("_last"), F.col("records").alias("_rows")))
    marked = join_small(fetches, last.drop("_rows"), keys, settled=True, sizes=last)
    behind = with_millis_behind(marked, tips, "_last", settled=settled).drop("_last")
    return with_starting_sequence(behind, progress, settled)
