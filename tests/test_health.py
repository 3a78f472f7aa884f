import threading
import time

import pytest
from pyspark.sql import functions as F

from shardstream.session import CHECKPOINT_CONF, new_folder, settle, work_folder
from shardstream.sources.changes import metrics_listener
from shardstream.sources.log import append_slice, stream_log
from shardstream.streaming.health import Endings, UnexpectedStop, check_running, throughput, watch


@pytest.fixture
def start(spark, log, tmp_path):
    append_slice(log, str(tmp_path / "log"), 0)
    started = []

    def run(process=lambda batch, batch_id: batch.count() and None):
        stream = stream_log(spark, str(tmp_path / "log"))
        job = str(tmp_path / f"job{len(started)}")
        started.append(stream.writeStream.foreachBatch(process).option("checkpointLocation", job).start())
        return started[-1]

    yield run
    for query in started:
        query.stop()


def until(condition, seconds=20):
    end = time.monotonic() + seconds
    while not condition() and time.monotonic() < end:
        time.sleep(0.05)
    assert condition()


def test_stopped_query_is_noticed(start):
    query = start()
    check_running(query)
    query.stop()
    assert not query.isActive and query.exception() is None
    with pytest.raises(UnexpectedStop):
        check_running(query)


def test_error_of_the_query_is_raised(start):
    def fail(batch, batch_id):
        raise RuntimeError("broken step")

    query = start(fail)
    wanted = threading.Event()
    wanted.set()
    with pytest.raises(Exception, match="broken step"):
        watch(query, wanted, 0.1)


def test_watch_stops_a_query_that_is_no_longer_wanted(start):
    query, wanted = start(), threading.Event()
    wanted.set()
    threading.Timer(0.5, wanted.clear).start()
    watch(query, wanted, 0.1)
    assert not query.isActive


def test_endings_and_progress_are_reported(spark, start):
    endings, reports = Endings(), []
    calls = metrics_listener(None, reports.append)
    spark.streams.addListener(endings)
    spark.streams.addListener(calls)
    try:
        query = start()
        query.processAllAvailable()
        query.stop()
        until(lambda: str(query.id) in endings.by_query)
        assert endings.by_query[str(query.id)] is None
        until(lambda: any(p.numInputRows == 1000 for p in reports))
        assert throughput(spark, query).agg(F.sum("input_rows")).first()[0] == 1000
    finally:
        spark.streams.removeListener(endings)
        spark.streams.removeListener(calls)


def test_work_folder_is_the_configured_one(spark):
    configured = spark.conf.get(CHECKPOINT_CONF, None)
    if configured is not None:
        assert work_folder(spark) == configured
    assert new_folder(spark, "x") != new_folder(spark, "x")


def test_settled_rows_do_not_change(spark):
    table = settle(spark.range(100).withColumn("r", F.rand()))
    assert sorted(table.collect()) == sorted(table.collect())
