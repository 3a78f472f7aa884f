import pytest

from shardstream.model import SHARD_END, TERMINATE, TRIM_HORIZON
from shardstream.operators import fetch, progress
from tests.helpers import records, rows

STATUS = "shard_id string, shutdown_reason string, ending_sequence_number string"
PROGRESS = "shard_id string, sequence_number string"


@pytest.fixture
def made(spark):
    return records(spark, ("a", "1", ""), ("a", "2", ""), ("b", "1", ""), ("c", "7", ""))


@pytest.fixture
def status(spark):
    return spark.createDataFrame([("a", None, None), ("b", "ZOMBIE", None), ("idle", None, None), ("over", TERMINATE, "3")], STATUS)


def test_a_shut_down_shard_is_marked_not_removed(made, status):
    got = rows(progress.with_can_checkpoint(made, status), "shard_id", "sequence_number", "can_checkpoint")
    assert got == [("a", "1", True), ("a", "2", True), ("b", "1", False), ("c", "7", True)]


def test_the_last_eligible_record_is_the_progress(made, status):
    assert rows(progress.checkpoint_records(made, status), "shard_id", "sequence_number") == [("a", "2"), ("c", "7")]
    assert len(rows(progress.checkpoint_records(made))) == 3


def test_commit_of_sets(spark, made, status):
    sets = fetch.record_sets(fetch.with_fetch(made, 1))
    got = rows(progress.checkpoint_record_sets(sets, status), "shard_id", "fetch_no", "sequence_number", "outcome")
    assert got == [
        ("a", 0, "1", "committed"),
        ("a", 1, "2", "committed"),
        ("b", 0, None, "skipped"),
        ("c", 0, "7", "committed"),
    ]


def test_commit_of_an_empty_set_fails_unless_shut_down(spark, made, status):
    sets = fetch.record_sets(fetch.with_fetch(made, 5)).selectExpr("shard_id", "fetch_no", "slice(records, 1, 0) as records")
    got = rows(progress.checkpoint_record_sets(sets, status), "shard_id", "sequence_number", "outcome")
    assert got == [("a", None, "failed"), ("b", None, "skipped"), ("c", None, "failed")]


def test_merged_progress_knows_every_shard(spark, made, status):
    prior = spark.createDataFrame([("a", "1"), ("b", "0"), ("old", "4"), ("over", "3")], PROGRESS)
    merged = progress.merge_progress(progress.checkpoint_records(made, status), status, prior)
    assert rows(merged, "shard_id", "sequence_number", "shutdown_reason") == [
        ("a", "2", None),
        ("b", "0", "ZOMBIE"),
        ("c", "7", None),
        ("idle", None, None),
        ("old", "4", None),
        ("over", SHARD_END, TERMINATE),
    ]


def test_a_terminated_shard_ends_where_it_has_been_read_to(spark):
    ends = [("all", TERMINATE, "5"), ("some", TERMINATE, "9"), ("unknown", TERMINATE, None), ("lost", "ZOMBIE", "5"), ("unread", TERMINATE, "5")]
    committed = spark.createDataFrame([("all", "5"), ("some", "5"), ("unknown", "5"), ("lost", "5")], PROGRESS)
    status = spark.createDataFrame(ends, STATUS)
    merged = progress.merge_progress(committed, status, None)
    assert rows(merged, "shard_id", "sequence_number") == [
        ("all", SHARD_END), ("lost", "5"), ("some", "5"), ("unknown", "5"), ("unread", None),
    ]
    without = progress.merge_progress(committed, status.drop("ending_sequence_number"), None)
    assert SHARD_END not in {s for _, s in rows(without, "shard_id", "sequence_number")}
    delivered = records(spark, ("all", "5", ""), ("lost", "5", ""), ("other", "1", ""))
    assert rows(progress.delivered_progress(delivered, status), "shard_id", "sequence_number") == [("all", "5"), ("other", "1")]


def test_merged_progress_never_goes_back(spark):
    committed = spark.createDataFrame([("a", "2"), ("b", "2"), ("c", "2")], PROGRESS)
    prior = spark.createDataFrame([("a", "3"), ("b", SHARD_END), ("c", TRIM_HORIZON)], PROGRESS)
    merged = progress.merge_progress(committed, None, prior)
    assert rows(merged, "shard_id", "sequence_number") == [("a", "3"), ("b", SHARD_END), ("c", "2")]


def test_invalid_progress_is_not_in_the_log(spark, made):
    stored = spark.createDataFrame(
        [("a", "1"), ("b", "2"), ("c", "70"), ("d", "1"), ("e", SHARD_END), ("f", TRIM_HORIZON), ("g", None)], PROGRESS
    )
    assert rows(progress.invalid_progress(stored, made)) == [("b", "2"), ("c", "70"), ("d", "1")]


def test_the_log_is_not_shuffled_for_the_check(spark, log):
    stored = spark.createDataFrame([("shard-0", "1")], PROGRESS)
    plan = progress.invalid_progress(stored, log)._jdf.queryExecution().executedPlan().toString()
    semi = plan[plan.index("LeftSemi") :]
    assert "BroadcastHashJoin" in plan
    assert "Exchange hashpartitioning" not in semi[: semi.index("FileScan")]


def test_backward_progress(spark):
    former = spark.createDataFrame([("a", "2"), ("b", "2"), ("c", SHARD_END), ("d", "5"), ("e", TRIM_HORIZON)], PROGRESS)
    new = spark.createDataFrame(
        [("a", "3"), ("b", "1"), ("c", "9"), ("d", TRIM_HORIZON), ("e", "0"), ("f", "0")], PROGRESS
    )
    assert [r[0] for r in rows(progress.backward_progress(new, former))] == ["b", "c", "d"]
