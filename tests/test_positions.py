import pytest
from pyspark.sql import functions as F

from shardstream.model import AT_TIMESTAMP, LATEST, SHARD_END, TRIM_HORIZON
from shardstream.operators import positions
from tests.helpers import records, rows

PROGRESS = "shard_id string, sequence_number string"


@pytest.fixture
def made(spark):
    return records(spark, ("a", "1", ""), ("a", "2", ""), ("b", "1", ""), ("b", "2", ""), ("c", "5", ""))


def read(frame):
    return rows(frame, "shard_id", "sequence_number")


def test_resume_after_each_shards_progress(spark, made):
    stored = spark.createDataFrame([("a", "1"), ("b", "2"), ("gone", "9")], PROGRESS)
    assert read(positions.resume(made, stored)) == [("a", "2"), ("c", "5")]


def test_positions_in_a_progress_table(spark, made):
    stored = spark.createDataFrame([("a", TRIM_HORIZON), ("b", SHARD_END), ("c", None)], PROGRESS)
    assert read(positions.resume(made, stored)) == [("a", "1"), ("a", "2"), ("c", "5")]


def test_resume_of_all_listed_shards_reads_the_same(spark, made):
    for stored in ([("a", "1"), ("b", "1"), ("c", "5")], [("a", "1"), ("b", TRIM_HORIZON), ("c", "5")],
                   [("a", SHARD_END), ("b", SHARD_END), ("c", SHARD_END)]):
        table = spark.createDataFrame(stored, PROGRESS)
        assert read(positions.resume(made, table, every_shard_listed=True)) == read(positions.resume(made, table))


def test_a_shard_without_progress_starts_at_the_start_position(spark, made):
    stored = spark.createDataFrame([("a", "1")], PROGRESS)
    since = made.where("shard_id = 'b' and sequence_number = '2'").first()["arrival_ts"]
    got = positions.start_reading(made, AT_TIMESTAMP, since=since, progress=stored)
    assert read(got) == [("a", "2"), ("b", "2"), ("c", "5")]


def test_latest_takes_only_later_records_and_new_shards(spark, made):
    tips = spark.createDataFrame([("a", "2"), ("b", "1")], PROGRESS)
    assert read(positions.start_reading(made, LATEST, tips=tips)) == [("b", "2"), ("c", "5")]
    stored = spark.createDataFrame([("a", "1")], PROGRESS)
    assert read(positions.start_reading(made, LATEST, tips=tips, progress=stored)) == [("a", "2"), ("b", "2"), ("c", "5")]


def test_trim_horizon_reads_all(made):
    assert positions.start_reading(made, TRIM_HORIZON).count() == 5


def test_bad_positions_are_refused(made):
    for position in (AT_TIMESTAMP, LATEST, "SOMEWHERE"):
        with pytest.raises(ValueError):
            positions.start_reading(made, position)


def test_timestamp_and_lowest_progress_reach_the_scan(spark, log, tmp_path):
    from shardstream.sources.log import append_slice, read_log

    append_slice(log, str(tmp_path), 0)
    stored = read_log(spark, str(tmp_path))
    plan = positions.from_timestamp(stored, "2024-01-15")._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(arrival_ts" in plan
    tips = positions.shard_tips(stored.where(F.col("arrival_ts") < "2024-01-10"))
    plan = positions.resume(stored, tips, every_shard_listed=True)._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThan(sequence_number" in plan
