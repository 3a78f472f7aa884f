"""Running consumers: deliveries, progress, restarts, failures, order."""

import pytest
from pyspark.errors.exceptions.captured import StreamingQueryException
from pyspark.sql import functions as F

from shardstream.model import LATEST, RECORD_COLUMNS, SHARD_END, TRIM_HORIZON
from shardstream.operators.positions import resume
from shardstream.operators.progress import checkpoint_records
from shardstream.plans import tables
from shardstream.sources.log import append_slice, read_log, stream_log
from shardstream.sources.options import Overrides, SourceOptions
from shardstream.streaming.changes import start_changes
from shardstream.streaming.consumer import read_records, start_consumer, start_from_config, write_batches
from shardstream.streaming.health import Endings
from shardstream.streaming.progress_table import current_progress
from tests.helpers import records, rows

STATUS = "shard_id string, shutdown_reason string, ending_sequence_number string"
FROM_START = SourceOptions(initial_position=TRIM_HORIZON)


@pytest.fixture
def place(tmp_path):
    return {name: str(tmp_path / name) for name in ("log", "job", "out")}


def slices(log, parts=4):
    """The log cut into slices by sequence, in order of arrival."""
    cut = F.expr(f"cast(sequence_number as bigint) * {parts} div 1000")
    return [log.where(cut == i) for i in range(parts)]


def run(spark, place, process=None, options=FROM_START, **more):
    stream = read_records(spark, place["log"], place["job"], options)
    process = process or write_batches(place["out"])
    start_consumer(stream, process, place["job"], options, once=True, **more).awaitTermination()


def progress(spark, place):
    return rows(current_progress(spark, place["job"] + "/progress"), "shard_id", "sequence_number")


def test_one_record_is_consumed(spark, place):
    append_slice(records(spark, ("shard-0", "1", "abc")), place["log"], 0)
    run(spark, place)
    assert rows(spark.read.parquet(place["out"]).select(F.decode("data", "UTF-8"))) == [("abc",)]
    assert progress(spark, place) == [("shard-0", "1")]


def test_stream_delivers_the_same_as_the_table(spark, log, place):
    append_slice(log, place["log"], 0)
    run(spark, place)
    assert rows(spark.read.parquet(place["out"]), *RECORD_COLUMNS) == rows(log, *RECORD_COLUMNS)
    assert progress(spark, place) == rows(checkpoint_records(log))


def test_restart_reads_only_what_was_appended(spark, log, place):
    parts = slices(log)
    seen = []
    for i, part in enumerate(parts):
        append_slice(part, place["log"], i)
        run(spark, place, lambda batch, batch_id: seen.append(batch.count()))
    assert seen == [part.count() for part in parts]
    assert progress(spark, place) == rows(checkpoint_records(log))


def test_failed_batch_is_run_again_without_duplicates(spark, log, place):
    parts = slices(log, 2)
    append_slice(parts[0], place["log"], 0)
    run(spark, place)
    append_slice(parts[1], place["log"], 1)
    write = write_batches(place["out"])

    def crash(batch, batch_id):
        write(batch, batch_id)
        raise RuntimeError("lost after the write")

    before = progress(spark, place)
    with pytest.raises(StreamingQueryException, match="lost after the write"):
        run(spark, place, crash)
    assert progress(spark, place) == before
    run(spark, place)
    out = spark.read.parquet(place["out"])
    assert out.count() == out.select("sequence_number").distinct().count() == 1000
    assert progress(spark, place) == rows(checkpoint_records(log))


def test_latest_starts_after_the_tips_of_the_first_start(spark, log, place):
    first, second, third, _ = slices(log)
    latest = SourceOptions(initial_position=LATEST)
    append_slice(first, place["log"], 0)
    run(spark, place, options=latest)
    append_slice(second, place["log"], 1)
    run(spark, place, options=latest)
    append_slice(third, place["log"], 2)
    run(spark, place, options=latest)
    wanted = rows(second.unionByName(third), "sequence_number")
    assert rows(spark.read.parquet(place["out"]), "sequence_number") == wanted


def test_timestamp_start(spark, log, place):
    append_slice(log, place["log"], 0)
    since = log.where("sequence_number = '00000000000000000500'").first()["arrival_ts"]
    run(spark, place, options=SourceOptions(timestamp=since))
    wanted = rows(log.where(F.col("arrival_ts") >= F.lit(since)), "sequence_number")
    assert rows(spark.read.parquet(place["out"]), "sequence_number") == wanted


def test_shut_down_shards_are_delivered_but_not_committed(spark, log, place):
    last = dict(rows(checkpoint_records(log)))
    ends = [("shard-1", "TERMINATE", last["shard-1"]), ("shard-2", "ZOMBIE", None), ("shard-3", "TERMINATE", last["shard-3"] + "9")]
    status = spark.createDataFrame(ends, STATUS)
    append_slice(log, place["log"], 0)
    run(spark, place, status=lambda: status)
    assert spark.read.parquet(place["out"]).count() == 1000
    stored = dict(progress(spark, place))
    assert stored["shard-1"] == SHARD_END
    assert stored["shard-2"] is None
    assert stored["shard-3"] == last["shard-3"]
    assert stored["shard-0"] == dict(rows(checkpoint_records(log)))["shard-0"]


def test_no_record_of_a_terminated_shard_is_lost_over_a_stop(spark, log, place):
    wanted = log.where("shard_id = 'shard-1'")
    end = wanted.agg(F.max("sequence_number")).first()[0]
    status = spark.createDataFrame([("shard-1", "TERMINATE", end)], STATUS)
    first, second = slices(log, 2)
    append_slice(first, place["log"], 0)
    run(spark, place, status=lambda: status)
    stored = current_progress(spark, place["job"] + "/progress")
    assert dict(rows(stored, "shard_id", "sequence_number"))["shard-1"] < end
    append_slice(second, place["log"], 1)
    rest = resume(read_log(spark, place["log"]), stored.select("shard_id", "sequence_number"))
    got = first.where("shard_id = 'shard-1'").unionByName(rest.where("shard_id = 'shard-1'"))
    assert rows(got, "sequence_number") == rows(wanted, "sequence_number")
    run(spark, place, status=lambda: status)
    assert dict(progress(spark, place))["shard-1"] == SHARD_END


@pytest.mark.parametrize("with_envelope", [False, True])
def test_records_of_a_shard_are_handed_over_in_order(spark, log, place, with_envelope):
    spread = log.orderBy(F.xxhash64("sequence_number"))
    for i in range(6):
        part = spread.where(F.col("sequence_number").cast("bigint") % 6 == i)
        append_slice(part.repartition(1 + i, "data"), place["log"], i)
    last, seen = {}, []

    def note(batch, batch_id):
        for number, shard, sequence in batch.select(F.spark_partition_id(), "shard_id", "sequence_number").collect():
            assert last.get((batch_id, shard), (-1, "")) <= (number, sequence)
            last[batch_id, shard] = number, sequence
            seen.append(sequence)

    run(spark, place, note, FROM_START, with_envelope=with_envelope)
    assert len(seen) == 1000 and len({b for b, _ in last}) == 1


def test_start_on_a_log_that_is_not_there_yet(spark, log, place):
    latest = SourceOptions(initial_position=LATEST)
    query = start_consumer(read_records(spark, place["log"], place["job"], latest), write_batches(place["out"]), place["job"], latest)
    try:
        append_slice(log, place["log"], 0)
        query.processAllAvailable()
    finally:
        query.stop()
    assert spark.read.parquet(place["out"]).count() == 1000


def test_settings_of_a_stream_stay_with_it(spark, log, place):
    name = "spark.sql.streaming.noDataMicroBatches.enabled"
    before = spark.conf.get(name, None)
    append_slice(log, place["log"], 0)
    options = SourceOptions(initial_position=TRIM_HORIZON, call_for_empty_lists=before != "true")
    made = read_records(spark, place["log"], place["job"], options)
    assert made.sparkSession.conf.get(name) == str(before != "true").lower()
    assert spark.conf.get(name, None) == before


def test_only_handled_records_are_committed(spark, log, place):
    append_slice(log, place["log"], 0)
    run(spark, place, lambda batch, batch_id: batch.where("sequence_number < '00000000000000000100'"))
    assert all(sequence < "00000000000000000100" for _, sequence in progress(spark, place))


def test_commit_of_something_not_delivered_is_refused(spark, log, place):
    append_slice(log, place["log"], 0)
    strange = records(spark, ("shard-0", "5", ""))
    with pytest.raises(StreamingQueryException, match="not delivered"):
        run(spark, place, lambda batch, batch_id: strange)
    assert current_progress(spark, place["job"] + "/progress") is None


def test_envelope_starts_at_stored_progress(spark, log, place):
    first, second = slices(log, 2)
    starts = []

    def look(batch, batch_id):
        starts.append(rows(batch.select("shard_id", "starting_sequence_number").distinct()))
        assert batch.groupBy("shard_id", "fetch_no").count().agg(F.max("count")).first()[0] <= 100

    options = SourceOptions(initial_position=TRIM_HORIZON, max_records=100)
    append_slice(first, place["log"], 0)
    run(spark, place, look, options, with_envelope=True)
    append_slice(second, place["log"], 1)
    run(spark, place, look, options, with_envelope=True)
    assert starts[0] == [(f"shard-{i}", TRIM_HORIZON) for i in range(4)]
    assert starts[1] == rows(checkpoint_records(first))


def test_order_of_a_shard_holds_across_micro_batches(spark, log, place):
    for i, part in enumerate(slices(log)):
        append_slice(part, place["log"], i, in_order=True)
    spans = []

    def note(batch, batch_id):
        ends = batch.groupBy("shard_id").agg(F.min("sequence_number"), F.max("sequence_number"))
        spans.append({shard: (low, high) for shard, low, high in ends.collect()})

    stream = stream_log(spark, place["log"], maxFilesPerTrigger="1")
    start_consumer(stream, note, place["job"], FROM_START, once=True).awaitTermination()
    assert len(spans) >= 4
    last = {}
    for span in spans:
        for shard, (low, high) in span.items():
            assert low > last.get(shard, "")
            last[shard] = high


def test_bytes_bound_a_micro_batch(spark, log, place):
    for i, part in enumerate(slices(log)):
        append_slice(part, place["log"], i)
    sizes = []
    options = SourceOptions(initial_position=TRIM_HORIZON, max_cache_byte_size=1)
    run(spark, place, lambda batch, batch_id: sizes.append(batch.count()), options)
    assert len(sizes) > 1
    assert sum(sizes) == 1000


def test_progress_of_a_stream_in_update_mode(spark, log, place):
    for i, part in enumerate(slices(log)):
        append_slice(part, place["log"], i)
    latest = {}
    query = (
        checkpoint_records(stream_log(spark, place["log"], maxFilesPerTrigger="2"))
        .writeStream.outputMode("update")
        .foreachBatch(lambda batch, _: latest.update(rows(batch)))
        .option("checkpointLocation", place["job"])
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    assert sorted(latest.items()) == rows(checkpoint_records(read_log(spark, place["log"])))


def test_a_complete_slice_is_left_alone(spark, log, place):
    assert append_slice(log.limit(10), place["log"], 0)
    assert not append_slice(log, place["log"], 0)
    assert read_log(spark, place["log"]).count() == 10


def test_old_progress_tables_are_removed(spark, log, place, monkeypatch):
    from shardstream.sources.folders import batch_folder, exists
    from shardstream.streaming import progress_table

    monkeypatch.setattr(progress_table, "KEPT_BATCHES", 2)
    for i, part in enumerate(slices(log)):
        append_slice(part, place["log"], i)
        run(spark, place)
    folder = place["job"] + "/progress"
    assert [exists(spark, batch_folder(folder, i)) for i in range(4)] == [False, False, True, True]
    assert progress(spark, place) == rows(checkpoint_records(log))


def test_settings_from_a_configuration(spark, log, place):
    append_slice(log, place["log"], 0)
    config = {"initial-position-in-stream": "LATEST", "max-records": 70}
    sizes = []

    def look(batch, batch_id):
        sizes.extend(r["count"] for r in batch.groupBy("shard_id", "fetch_no").count().collect())

    start_from_config(
        spark, place["log"], place["job"], look, config, Overrides(initial_position=TRIM_HORIZON),
        with_envelope=True, once=True,
    ).awaitTermination()
    assert sum(sizes) == 1000 and max(sizes) == 70


def test_changes_are_decoded_and_reported(spark, events, place):
    append_slice(tables.change_log(events), place["log"], 0)
    seen = []

    def keep(batch, batch_id):
        seen.extend(rows(batch, "id", "value", "starting_sequence_number"))

    def start(**reports):
        return start_changes(
            spark, place["log"], place["job"], tables.IMAGE, keep, options=FROM_START,
            with_envelope=True, once=True, **reports,
        )

    with pytest.raises(ValueError, match="either"):
        start()
    listener = Endings()
    query = start(listener=listener)
    query.awaitTermination()
    spark.streams.removeListener(listener)
    assert sorted((i, v) for i, v, _ in seen) == sorted(tuple(r) for r in events.select("user_id", "event_type").collect())
    assert {start for _, _, start in seen} == {TRIM_HORIZON}


def test_leftovers_of_a_crashed_append_are_not_read(spark, log, place):
    append_slice(log.limit(10), place["log"], 0)
    log.limit(7).write.parquet(place["log"] + "/_staging/batch_id=1")
    assert read_log(spark, place["log"]).count() == 10
    run(spark, place)
    assert spark.read.parquet(place["out"]).count() == 10
    assert append_slice(log.limit(20), place["log"], 1)
    assert read_log(spark, place["log"]).count() == 30
    run(spark, place)
    assert spark.read.parquet(place["out"]).count() == 30


def test_incomplete_slice_is_replaced(spark, log, place):
    log.limit(5).write.option("mapreduce.fileoutputcommitter.marksuccessfuljobs", "false").parquet(place["log"] + "/batch_id=0")
    assert append_slice(log.limit(8), place["log"], 0)
    assert read_log(spark, place["log"]).count() == 8
