"""The index of a log's slices, and what is read through it."""

import shutil
from datetime import datetime, timezone
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from shardstream.model import AT_TIMESTAMP, LATEST, TRIM_HORIZON
from shardstream.operators.positions import shard_tips, start_reading
from shardstream.sources import index
from shardstream.sources.index import in_slices, index_missing, log_tips, read_from, read_index
from shardstream.sources.log import append_slice, read_log, stream_folder, stream_log
from shardstream.sources.options import SourceOptions
from shardstream.streaming.consumer import read_records, start_consumer
from tests.helpers import records, rows

KEYS = ("shard_id", "sequence_number")


def seconds(second):
    return datetime.fromtimestamp(1_700_000_000 + second, tz=timezone.utc)


def slice_of(spark, number, shards=("a", "b"), n=100):
    """Records one second apart, over the shards in turn; slices follow each other in time."""
    first = number * n
    made = records(spark, *[(shards[k % len(shards)], f"{first + k:08d}", "x" * (k % 3)) for k in range(n)])
    return made.withColumn("arrival_ts", F.timestamp_seconds(F.unix_seconds("arrival_ts") + first))


@pytest.fixture
def log(spark, tmp_path):
    folder = str(tmp_path / "log")
    for number in range(4):
        append_slice(slice_of(spark, number, ("a", "b") if number < 3 else ("b", "c")).coalesce(1), folder, number)
    return folder


def spoil(log, numbers):
    """Make the files of slices unreadable: whoever opens one of them fails."""
    for number in numbers:
        for file in (Path(log) / f"batch_id={number}").glob("*.parquet"):
            (file.parent / f".{file.name}.crc").unlink(missing_ok=True)
            file.write_bytes(b"spoiled")


def test_every_slice_is_indexed(spark, log):
    got = rows(read_index(spark, log), "batch_id", "shard_id", "rows", "bytes", "first_sequence_number", "last_sequence_number")
    assert len(got) == 8
    assert got[0] == (0, "a", 50, 50, "00000000", "00000098")
    assert got[-1] == (3, "c", 50, 49, "00000301", "00000399")
    assert read_log(spark, log).count() == 400


def test_tips_are_those_of_the_log(spark, log):
    assert rows(log_tips(spark, log)) == rows(shard_tips(read_log(spark, log)))


def test_slices_without_an_index_are_read(spark, log):
    shutil.rmtree(Path(log) / "_index" / "slices" / "batch_id=1")
    shutil.rmtree(Path(log) / "_index" / "slices" / "batch_id=3")
    before = rows(read_index(spark, log).drop("first_arrival_ts"))
    assert len(before) == 8
    assert index_missing(spark, log) == 2 and index_missing(spark, log) == 0
    assert rows(read_index(spark, log).drop("first_arrival_ts")) == before


def test_an_index_ahead_of_its_slice_does_not_count(spark, log):
    shutil.move(str(Path(log) / "batch_id=3"), str(Path(log).parent / "later"))
    assert {r.batch_id for r in read_index(spark, log).collect()} == {0, 1, 2}
    assert "c" not in {r.shard_id for r in log_tips(spark, log).collect()}
    # The slice comes again: its index is replaced.
    assert append_slice(slice_of(spark, 3, ("d",)), log, 3)
    assert {r.shard_id for r in log_tips(spark, log).collect()} == {"a", "b", "d"}


def test_logs_without_slices(spark, tmp_path):
    assert read_index(spark, str(tmp_path / "none")).count() == 0
    flat = str(tmp_path / "flat")
    slice_of(spark, 0).write.parquet(flat)
    assert rows(log_tips(spark, flat)) == rows(shard_tips(spark.read.parquet(flat)))
    assert rows(read_from(spark, flat, AT_TIMESTAMP, since=seconds(50)), *KEYS) == rows(
        read_log(spark, flat).where(F.col("arrival_ts") >= F.lit(seconds(50))), *KEYS
    )


POSITIONS = {
    "latest": dict(position=LATEST, tips={"a": "00000150", "b": "00000199"}),
    "progress": dict(position=TRIM_HORIZON, progress={"a": "00000298", "b": "00000250", "c": "00000000"}),
    "no progress of a shard": dict(position=TRIM_HORIZON, progress={"a": "SHARD_END"}),
    "all done": dict(position=TRIM_HORIZON, progress={"a": "SHARD_END", "b": "99999999", "c": "SHARD_END"}),
    "from the start": dict(position=TRIM_HORIZON, progress={"a": TRIM_HORIZON, "b": "99999999", "c": "SHARD_END"}),
    "timestamp": dict(position=AT_TIMESTAMP, since=seconds(250)),
    "timestamp and progress": dict(position=AT_TIMESTAMP, since=seconds(310), progress={"a": "00000100"}),
    "all": dict(position=TRIM_HORIZON),
}
WANTED = {
    "latest": {1, 2, 3}, "progress": {2, 3}, "no progress of a shard": {0, 1, 2, 3}, "all done": set(), "from the start": {0, 1, 2},
    "timestamp": {2, 3}, "timestamp and progress": {1, 2, 3}, "all": {0, 1, 2, 3},
}


@pytest.mark.parametrize("case", POSITIONS)
def test_same_records_from_fewer_slices(spark, log, case):
    given = dict(POSITIONS[case])
    for name in ("tips", "progress"):
        if name in given:
            given[name] = spark.createDataFrame(list(given[name].items()), "shard_id string, sequence_number string")
    position = given.pop("position")
    wanted = rows(start_reading(read_log(spark, log), position, **given), *KEYS)
    assert {int(s) // 100 for _, s in wanted} == WANTED[case]
    spoil(log, {0, 1, 2, 3} - WANTED[case])
    assert rows(read_from(spark, log, position, **given), *KEYS) == wanted


def test_filters_on_slices(spark, monkeypatch):
    frame = spark.range(30).withColumnRenamed("id", "batch_id")
    wanted = {0, 1, 2, 7, 9, 10, 29}
    for most in (50, 2):
        monkeypatch.setattr(index, "MOST_RANGES", most)
        assert {r.batch_id for r in frame.where(in_slices(wanted)).collect()} == wanted
        assert frame.where(in_slices(set())).count() == 0


def test_lag_of_a_stream_is_behind_the_end_of_the_log(spark, tmp_path):
    """Three slices, one a batch: the first record of a shard is the whole log behind, and only the last batch ends at 0."""
    log, seen = str(tmp_path / "log"), {}
    for number in range(3):
        append_slice(slice_of(spark, number).coalesce(1), log, number)
    stream = stream_log(spark, log, maxFilesPerTrigger=1)
    assert stream_folder(stream).endswith(log)

    def look(batch, batch_id):
        lags = batch.groupBy("shard_id").agg(F.min("millis_behind_latest"), F.max("millis_behind_latest"))
        seen[batch_id] = rows(lags)

    options = SourceOptions(initial_position=TRIM_HORIZON, max_records=10)
    start_consumer(stream, look, str(tmp_path / "job"), options, with_envelope=True, once=True).awaitTermination()
    assert seen == {
        k: [("a", 200_000 - 100_000 * k, 280_000 - 100_000 * k), ("b", 200_000 - 100_000 * k, 280_000 - 100_000 * k)]
        for k in range(3)
    }


def test_lag_grows_with_what_is_appended_meanwhile(spark, tmp_path):
    log, seen = str(tmp_path / "log"), []
    append_slice(slice_of(spark, 0), log, 0)

    def look(batch, batch_id):
        seen.append(batch.agg(F.min("millis_behind_latest")).first()[0])

    options = SourceOptions(initial_position=TRIM_HORIZON)
    job = str(tmp_path / "job")
    start_consumer(stream_log(spark, log), look, job, options, with_envelope=True, once=True).awaitTermination()
    append_slice(slice_of(spark, 1).coalesce(1), log, 1)
    append_slice(slice_of(spark, 2).coalesce(1), log, 2)
    start_consumer(stream_log(spark, log, maxFilesPerTrigger=1), look, job, options, with_envelope=True, once=True).awaitTermination()
    assert seen == [0, 100_000, 0]


@pytest.mark.parametrize("options", [SourceOptions(initial_position=LATEST), SourceOptions(timestamp=seconds(450))])
def test_a_stream_does_not_open_slices_before_its_start(spark, log, tmp_path, options):
    """Only the slice that is appended after the first start is read."""
    job, out, read = str(tmp_path / "job"), [], []

    def run():
        stream = read_records(spark, log, job, options)
        query = start_consumer(stream, lambda b, i: out.extend(rows(b, *KEYS)), job, options, once=True)
        query.awaitTermination()
        read.append(sum(p["numInputRows"] for p in query.recentProgress))

    run()
    append_slice(slice_of(spark, 4, ("a", "d")), log, 4)
    spoil(log, range(4))
    run()
    wanted = slice_of(spark, 4, ("a", "d"))
    if options.timestamp:
        wanted = wanted.where(F.col("arrival_ts") >= F.lit(options.timestamp))
    assert sorted(out) == rows(wanted, *KEYS)
    assert read[0] == 0 and 0 < read[1] <= 300
