import pytest

from shardstream.operators import shards
from tests.helpers import rows


@pytest.fixture
def table(spark):
    return spark.createDataFrame([("shard-0", "a"), ("shard-2", "b")], "shard_id string, mark string")


def plan(frame):
    return frame._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("how", ["left", "inner"])
def test_salted_join_gives_the_same_rows(log, table, how, monkeypatch):
    columns = ("shard_id", "sequence_number", "mark")
    small = rows(shards.join_shards(log, table, how), *columns)
    monkeypatch.setattr(shards, "BROADCAST_ROWS", 1)
    large = shards.join_shards(log, table, how)
    assert rows(large, *columns) == small
    assert "_salt" not in large.columns


def test_a_large_table_is_copied_for_hot_keys_alone(log, table, monkeypatch):
    columns = ("shard_id", "sequence_number", "mark")
    small = rows(shards.join_shards(log, table), *columns)
    monkeypatch.setattr(shards, "BROADCAST_ROWS", 1)
    assert "Generate" not in plan(shards.join_shards(log, table))
    sizes = sorted(r["count"] for r in log.groupBy("shard_id").count().collect())
    monkeypatch.setattr(shards, "HOT_ROWS", sizes[1])
    some_hot = shards.join_shards(log, table)
    assert "Generate" in plan(some_hot)
    assert rows(some_hot, *columns) == small
    known = log.groupBy("shard_id").count().withColumnRenamed("count", "_rows")
    assert rows(shards.join_small(log, table, ["shard_id"], sizes=known), *columns) == small


def test_small_table_is_broadcast_and_the_log_stays(log, table):
    text = plan(shards.join_shards(log, table))
    assert "BroadcastHashJoin" in text
    assert "Exchange hashpartitioning" not in text


def test_size_is_measured_in_rows_and_bytes(spark, monkeypatch):
    long = spark.createDataFrame([("s", "x" * 1000)], "shard_id string, mark string")
    assert shards.fits_broadcast(long)
    monkeypatch.setattr(shards, "BROADCAST_BYTES", 999)
    assert not shards.fits_broadcast(long)


def test_other_joins_are_refused(log, table):
    with pytest.raises(ValueError):
        shards.join_shards(log, table, "full")
