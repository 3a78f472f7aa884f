import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from shardstream.functions import attempts as a
from shardstream.functions.retry import EXPONENTIAL, LINEAR, RetryPolicy, classify, delay_ms
from shardstream.model import ATTEMPTS
from shardstream.operators import puts, quota
from tests.helpers import records, rows


def test_default_delays_are_powers_of_the_base():
    assert RetryPolicy().delays() == [100, 10_000, 1_000_000, 100_000_000, 10_000_000_000]
    assert RetryPolicy(strategy=LINEAR).delays() == [100, 200, 300, 400, 500]


def test_policies_are_checked():
    with pytest.raises(ValueError):
        RetryPolicy(max_retries=20)
    with pytest.raises(ValueError):
        RetryPolicy(max_retries=-1)
    with pytest.raises(ValueError):
        delay_ms("quadratic", 100, 1)


@settings(max_examples=10, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.integers(0, 6), st.sampled_from([EXPONENTIAL, LINEAR]), st.integers(0, 300), st.integers(0, 9))
def test_schedule_adds_up(spark, max_retries, strategy, base, failures):
    policy = RetryPolicy(max_retries, strategy, base)
    tried = min(failures, max_retries) + 1
    made = [(k, k > failures, None, None) for k in range(1, tried + 1)]
    results = spark.createDataFrame([("r", made)], f"request_id string, attempts {ATTEMPTS}")
    schedule = puts.attempt_schedule(results, policy).orderBy("attempt").collect()
    assert [r.attempt for r in schedule] == list(range(1, tried + 1))
    assert [r.due_ms for r in schedule] == [sum(delay_ms(strategy, base, i) for i in range(1, k)) for k in range(1, tried + 1)]
    assert [r.status for r in schedule[:-1]] == ["retry"] * (tried - 1)
    outcome = puts.retry_outcome(results, policy).first()
    assert schedule[-1].status == outcome.status == ("failed" if failures > max_retries else "success")
    assert outcome.attempts_made == tried
    assert outcome.backoff_ms == schedule[-1].due_ms


def test_limits_of_the_retries(spark):
    made = spark.createDataFrame(
        [(False, "record_failed", 5), (False, "record_failed", 6), (False, "connection_lost", 1), (True, None, 6)],
        "ok boolean, kind string, attempt int",
    )
    got = made.select("attempt", "ok", classify(F.col("ok"), F.col("kind"), F.col("attempt"), RetryPolicy()))
    assert rows(got) == [(1, False, "failed"), (5, False, "retry"), (6, False, "failed"), (6, True, "success")]


def test_reading_attempts(spark):
    made = spark.createDataFrame(
        [
            ("none", []),
            ("good", [(1, True, None, None)]),
            ("late", [(1, False, "T", "slow"), (2, True, None, None)]),
            ("bad", [(1, False, "T", "slow")]),
        ],
        f"k string, attempts {ATTEMPTS}",
    )
    got = made.select("k", a.all_attempts_ok("attempts"), a.last_error_code("attempts"), a.last_error_message("attempts"))
    assert rows(got) == [
        ("bad", False, "T", "slow"), ("good", True, None, None), ("late", False, None, None), ("none", True, None, None),
    ]


def test_quota_of_shards():
    settings = quota.PutSettings.by_number_of_shards(3)
    assert (settings.parallelism, settings.max_batch_size) == (6, 500)
    assert (settings.max_records_per_second, settings.max_bytes_per_second) == (3000, 3_000_000)
    assert (settings.retry.max_retries, settings.retry.base_ms, settings.retry.strategy) == (5, 100, EXPONENTIAL)
    with pytest.raises(ValueError):
        quota.PutSettings.by_number_of_shards(0)


def test_slots_keep_both_budgets(spark):
    made = records(spark, *[("a", f"{i:04d}", "x" * (i % 7)) for i in range(200)], ("b", "0000", "y"))
    slots = quota.with_throttle_slot(made, max_batch_size=9, records_per_second=20, bytes_per_second=50).collect()
    shard = sorted((r for r in slots if r.shard_id == "a"), key=lambda r: r.sequence_number)
    sent = 0
    for i, r in enumerate(shard):
        assert r.batch_no == i // 9
        assert i < 20 * (r.slot_s + 1)
        assert sent < 50 * (r.slot_s + 1)
        assert r.slot_s == max(i // 20, sent // 50)
        sent += len(r.data)
    assert [r.slot_s for r in slots if r.shard_id == "b"] == [0]


def test_null_payload_has_no_bytes(spark):
    made = records(spark, ("a", "0", None), ("a", "1", "xxxx"), ("a", "2", "x"))
    got = rows(quota.with_throttle_slot(made, bytes_per_second=4), "sequence_number", "slot_s")
    assert got == [("0", 0), ("1", 0), ("2", 1)]
