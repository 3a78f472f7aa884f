"""Puts that fail wait in a table, over rounds and restarts."""

import sys
from collections import Counter
from pathlib import Path

import pyarrow as pa
import pytest
from pyspark import TaskContext, cloudpickle
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from shardstream.functions.retry import EXPONENTIAL, LINEAR, RECORD_FAILED, RetryPolicy
from shardstream.model import PUT_REQUEST
from shardstream.operators.quota import PutSettings
from shardstream.streaming.producer import DEAD_LETTER
from shardstream.streaming.put_queue import PutQueue, SystemClock

# Workers cannot import this file; they get its functions with the job.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


class Hand(SystemClock):
    """A clock that is moved by hand."""

    def __init__(self):
        self.ms, self.waits = 1000, []

    def now_ms(self):
        return self.ms

    def wait_until(self, due_ms):
        self.waits.append(due_ms - self.ms)
        self.ms = max(self.ms, due_ms)


def settings(**retry):
    return PutSettings(2, 3, 1000, 1_000_000, RetryPolicy(**({"strategy": LINEAR, "base_ms": 100} | retry)))


def service(folder, failures=0, kind=RECORD_FAILED):
    """A service that fails the first attempts of a record, as its payload says, and notes every call."""

    def put(batch):
        ids, tries = batch["request_id"].to_pylist(), batch["attempt"].to_pylist()
        with open(Path(folder) / "calls", "a") as calls:
            calls.writelines(f"{i} {a}\n" for i, a in zip(ids, tries, strict=True))
        wanted = [int(d.decode()) if d else failures for d in batch["data"].to_pylist()]
        return pa.table(
            {
                "shard_id": ["s0"] * len(ids),
                "sequence_number": ids,
                "successful": [a > f for a, f in zip(tries, wanted, strict=True)],
                "error_kind": [kind] * len(ids),
                "error_code": ["Slow"] * len(ids),
                "error_message": ["slow down"] * len(ids),
            }
        )

    return put


def calls(folder):
    return Counter(tuple(line.split()) for line in (Path(folder) / "calls").read_text().splitlines())


def write(spark, folder, requests):
    rows = [(i, "stream", "k", None if f is None else str(f).encode()) for i, f in requests.items()]
    spark.createDataFrame(rows, PUT_REQUEST).coalesce(1).write.mode("append").parquet(str(folder))


def stream(spark, folder):
    return spark.readStream.schema(PUT_REQUEST).parquet(str(folder))


def results(queue):
    return {r.request_id: (r.successful, len(r.attempts)) for r in queue.results().collect()}


def test_every_record_is_put_until_it_succeeds_or_is_given_up(spark, tmp_path):
    write(spark, tmp_path / "in", {"a": 0, "b": 2, "c": 5, "d": 6, "e": 9})
    queue = PutQueue(spark, str(tmp_path / "job"), service(tmp_path), settings(), DEAD_LETTER, clock=Hand())
    queue.put_all(stream(spark, tmp_path / "in"))
    assert results(queue) == {"a": (True, 1), "b": (True, 3), "c": (True, 6), "d": (False, 6), "e": (False, 6)}
    assert calls(tmp_path) == Counter(
        {(i, str(a)): 1 for i, n in {"a": 1, "b": 3, "c": 6, "d": 6, "e": 6}.items() for a in range(1, n + 1)}
    )
    assert queue.clock.waits == [100, 200, 300, 400, 500]
    assert queue.unfinished() is None
    last = queue.results().where("request_id = 'c'").first()
    assert last.last_ms - last.first_ms == 1500
    assert [a.error_code for a in last.attempts] == ["Slow"] * 5 + [None]


def test_waiting_records_outlive_the_job(spark, tmp_path):
    clock, job = Hand(), str(tmp_path / "job")
    write(spark, tmp_path / "in", {"a": 1, "b": 3})
    PutQueue(spark, job, service(tmp_path), settings(), clock=clock).start(stream(spark, tmp_path / "in"), once=True).awaitTermination()
    again = PutQueue(spark, job, service(tmp_path), settings(), clock=clock)
    assert results(again) == {}
    waiting = {r.request_id: (r.due_ms, len(r.attempts), bytes(r.data)) for r in again.unfinished().collect()}
    assert waiting == {"a": (1100, 1, b"1"), "b": (1100, 1, b"3")}
    clock.ms = 1100
    write(spark, tmp_path / "in", {"c": 0})
    again.start(stream(spark, tmp_path / "in"), once=True).awaitTermination()
    assert results(again) == {"a": (True, 2), "c": (True, 1)}
    assert [r.request_id for r in again.unfinished().collect()] == ["b"]
    again.drain()
    assert results(again) == {"a": (True, 2), "b": (True, 4), "c": (True, 1)}
    # After a drain the stream goes on with its own batches.
    write(spark, tmp_path / "in", {"d": 1})
    again.put_all(stream(spark, tmp_path / "in"))
    assert results(again)["d"] == (True, 2)
    assert max(calls(tmp_path).values()) == 1


def test_a_finished_round_is_not_put_again(spark, tmp_path):
    queue = PutQueue(spark, str(tmp_path / "job"), service(tmp_path), settings(), clock=Hand())
    requests = spark.createDataFrame([("a", "s", "k", b"0"), ("b", "s", "k", b"1")], PUT_REQUEST)
    assert queue.run_round(0, 0, requests)
    assert not queue.run_round(0, 0, requests)
    assert not queue.run_round(1, 0, requests.where("false"))
    assert calls(tmp_path) == {("a", "1"): 1, ("b", "1"): 1}


def test_a_record_is_not_put_before_it_is_due(spark, tmp_path):
    clock = Hand()
    queue = PutQueue(spark, str(tmp_path / "job"), service(tmp_path), settings(), clock=clock)
    queue.run_round(0, 0, spark.createDataFrame([("a", "s", "k", b"2")], PUT_REQUEST))
    clock.ms = 1099
    assert not queue.run_round(1, 0, None)
    clock.ms = 1100
    assert queue.run_round(2, 0, None)
    clock.ms = 1050  # a clock that is put back does not bring a round back
    assert not queue.run_round(3, 0, None)
    assert calls(tmp_path) == {("a", "1"): 1, ("a", "2"): 1}


def test_no_delay_is_a_millisecond(spark, tmp_path):
    queue = PutQueue(spark, str(tmp_path / "job"), service(tmp_path), settings(base_ms=0), clock=Hand())
    queue.run_round(0, 0, spark.createDataFrame([("a", "s", "k", b"2")], PUT_REQUEST))
    assert queue.drain() == 2
    assert results(queue) == {"a": (True, 3)}


def test_long_delays_are_kept_as_they_are(spark, tmp_path):
    queue = PutQueue(
        spark, str(tmp_path / "job"), service(tmp_path), settings(strategy=EXPONENTIAL), DEAD_LETTER, clock=Hand()
    )
    queue.run_round(0, 0, spark.createDataFrame([("a", "s", "k", b"9")], PUT_REQUEST))
    queue.drain()
    assert queue.clock.waits == [100**a for a in range(1, 6)]
    assert results(queue) == {"a": (False, 6)}


@pytest.mark.parametrize(("failures", "kind"), [(9, RECORD_FAILED), (1, "connection_lost")])
def test_a_failure_that_is_not_retried_fails_the_stream(spark, tmp_path, failures, kind):
    write(spark, tmp_path / "in", {"a": failures})
    queue = PutQueue(spark, str(tmp_path / "job"), service(tmp_path, kind=kind), settings(max_retries=1), clock=Hand())
    with pytest.raises(Exception, match="given up after attempt"):
        queue.put_all(stream(spark, tmp_path / "in"))
    assert results(queue) == {}
    # With a service that answers, the same batch goes through.
    healed = PutQueue(spark, str(tmp_path / "job"), service(tmp_path), settings(max_retries=9), clock=Hand())
    healed.put_all(stream(spark, tmp_path / "in"))
    assert results(healed)["a"][0]


def test_what_waits_is_put_before_a_failing_source_fails(spark, tmp_path):
    write(spark, tmp_path / "in", {"a": 2})
    broken = stream(spark, tmp_path / "in").where(
        F.when(F.col("request_id") == "z", F.raise_error(F.lit("broken")).cast("boolean")).otherwise(F.lit(True))
    )
    queue = PutQueue(spark, str(tmp_path / "job"), service(tmp_path), settings(), clock=Hand())
    queue.start(broken, once=True).awaitTermination()
    (tmp_path / "in" / "part-zz.parquet").write_bytes(b"no parquet")
    with pytest.raises(StreamingQueryException):
        queue.put_all(broken)
    assert results(queue) in ({"a": (True, 3)}, {})


def test_rounds_go_on_while_nothing_arrives(spark, tmp_path):
    write(spark, tmp_path / "in", {"a": 2})
    queue = PutQueue(spark, str(tmp_path / "job"), service(tmp_path), settings(base_ms=200))
    query = queue.start(stream(spark, tmp_path / "in"))
    try:
        for _ in range(60):
            if results(queue):
                break
            query.awaitTermination(1)
    finally:
        query.stop()
    assert results(queue) == {"a": (True, 3)}


def test_requests_without_ids_and_without_payload(spark, tmp_path):
    requests = spark.createDataFrame([("s", "k", None)] * 5, "stream_name string, partition_key string, data binary")
    queue = PutQueue(spark, str(tmp_path / "job"), service(tmp_path, failures=1), settings(), clock=Hand())
    queue.run_round(0, 0, requests)
    queue.drain()
    assert sorted(results(queue).values()) == [(True, 2)] * 5


def test_nothing_yet(spark, tmp_path):
    queue = PutQueue(spark, str(tmp_path / "job"), service(tmp_path), settings())
    assert queue.results().count() == 0 and queue.unfinished() is None and queue.drain() == 0


def test_without_limits_the_requests_of_one_file_are_put_by_many_tasks(spark, tmp_path):
    def put(batch):
        with open(tmp_path / "tasks", "a") as tasks:
            tasks.writelines(f"{TaskContext.get().partitionId()} {a}\n" for a in batch["attempt"].to_pylist())
        return answer(batch)

    answer = service(tmp_path)
    write(spark, tmp_path / "in", {f"r{i}": i % 2 for i in range(200)})
    queue = PutQueue(spark, str(tmp_path / "job"), put, settings(), limit_writers=False, clock=Hand())
    queue.put_all(stream(spark, tmp_path / "in"))
    assert results(queue) == {f"r{i}": (True, 1 + i % 2) for i in range(200)}
    tasks = Counter(tuple(line.split()) for line in (tmp_path / "tasks").read_text().splitlines())
    for attempt, records in (("1", 200), ("2", 100)):
        of_task = [n for (_, a), n in tasks.items() if a == attempt]
        assert len(of_task) > 4 and sum(of_task) == records and max(of_task) < records / 2
