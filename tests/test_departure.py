"""Departures under limits that hold in every second."""

import random

import pytest
from pyspark.sql import functions as F

from shardstream.operators.quota import with_departure
from tests.helpers import records, rows

MICROS = 1_000_000


def arrivals(spark, shards):
    """Records of (shard, [(arrival in milliseconds, bytes)]) in sequence order."""
    flat = [(s, f"{k:06d}", "x" * size, ms) for s, sent in shards.items() for k, (ms, size) in enumerate(sent)]
    made = records(spark, *[r[:3] for r in flat])
    times = spark.createDataFrame([(s, n, ms) for s, n, _, ms in flat], "shard_id string, sequence_number string, ms bigint")
    return made.drop("arrival_ts").join(times, ["shard_id", "sequence_number"]).withColumn("arrival_ts", F.timestamp_millis("ms"))


def one_by_one(sent, per_second, bytes_per_second):
    free, out = 0, []
    for ms, size in sent:
        start = max(free, ms * 1000)
        free = start + max(-(-MICROS // per_second), -(-size * MICROS // bytes_per_second))
        out.append(start)
    return out


def departures(timed):
    out = {}
    for s, _, at in rows(timed.withColumn("at", F.unix_micros("departure_ts")), "shard_id", "sequence_number", "at"):
        out.setdefault(s, []).append(at)
    return out


@pytest.mark.parametrize("window_rows", [10, 100_000])
@pytest.mark.parametrize(("per_second", "bytes_per_second"), [(50, 10_000), (1000, 400), (7, 90)])
def test_equal_to_sending_one_by_one(spark, window_rows, per_second, bytes_per_second):
    rng = random.Random(per_second)
    shards = {
        "hot": [(1_700_000_000_000 + rng.randrange(4000) + 20 * k, rng.randrange(60)) for k in range(150)],
        "idle": [(1_700_000_000_000 + 5000 * k, 10) for k in range(20)],
        "empty": [(1_700_000_000_000, 0)] * 30,
    }
    timed = with_departure(arrivals(spark, shards), per_second, bytes_per_second, window_rows)
    assert timed.columns[-1] == "departure_ts" and "_busy" not in timed.columns
    got = departures(timed)
    assert got == {s: one_by_one(sent, per_second, bytes_per_second) for s, sent in shards.items()}
    for s, times in got.items():
        sizes = [size for _, size in shards[s]]
        for k, at in enumerate(times):
            inside = [j for j, other in enumerate(times) if at <= other < at + MICROS]
            assert len(inside) <= per_second
            assert sum(sizes[j] for j in inside[:-1]) < bytes_per_second or len(inside) == 1
            assert at >= shards[s][k][0] * 1000


def test_nothing_to_send(spark):
    assert with_departure(arrivals(spark, {"a": [(0, 1)]}).where("false")).count() == 0
