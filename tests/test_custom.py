"""A user's reader and a user's put function as Spark data sources."""

import json
from pathlib import Path

import pytest
from pyspark.errors.exceptions.captured import StreamingQueryException
from pyspark.sql import functions as F

from shardstream.model import TRIM_HORIZON
from shardstream.sources.custom import put_sink, read_custom, reader_source
from shardstream.sources.options import SourceOptions
from shardstream.streaming.consumer import start_consumer, write_batches
from shardstream.streaming.progress_table import current_progress
from tests.helpers import rows


def file_reader(name, commits=None):
    """Shards are text files of a folder, one record per line."""

    def tips(options):
        return {p.stem: len(p.read_text().splitlines()) for p in Path(options["folder"]).glob("*.txt")}

    def fetch(options, shard, start, end):
        from datetime import UTC, datetime

        lines = (Path(options["folder"]) / f"{shard}.txt").read_text().splitlines()
        for i in range(start, end):
            yield ("files", shard, f"{i:06d}", "k", lines[i].encode(), datetime(2024, 1, 1, tzinfo=UTC))

    def commit(options, end):
        (Path(options["folder"]) / "committed").write_text(json.dumps(end))

    return reader_source(name, tips, fetch, commit, range_size=3)


def write(folder, **shards):
    folder.mkdir(exist_ok=True)
    for shard, lines in shards.items():
        (folder / f"{shard}.txt").write_text("\n".join(lines))


def test_custom_reader_with_stored_progress(spark, tmp_path):
    source, folder, job = file_reader("files_a"), tmp_path / "in", str(tmp_path / "job")
    options = SourceOptions(initial_position=TRIM_HORIZON)
    write(folder, a=[f"a{i}" for i in range(10)], b=["b0"])
    out = str(tmp_path / "out")

    def consume():
        stream = read_custom(spark, source, folder=str(folder))
        query = start_consumer(stream, write_batches(out), job, options)
        query.processAllAvailable()
        query.stop()

    consume()
    assert rows(current_progress(spark, job + "/progress"), "shard_id", "sequence_number") == [("a", "000009"), ("b", "000000")]
    write(folder, a=[f"a{i}" for i in range(12)], b=["b0"])
    consume()
    got = rows(spark.read.parquet(out).select(F.decode("data", "UTF-8")))
    assert got == sorted([(f"a{i}",) for i in range(12)] + [("b0",)])
    assert rows(current_progress(spark, job + "/progress"), "shard_id", "sequence_number")[0] == ("a", "000011")


def test_registered_name_is_enough(spark, tmp_path):
    source, folder = file_reader("files_b"), tmp_path / "in"
    write(folder, a=["x"])
    spark.dataSource.register(source)
    assert read_custom(spark, "files_b", folder=str(folder)).isStreaming


def test_a_reader_may_give_arrow_batches(spark, tmp_path):
    def tips(options):
        return {"a": 7}

    def fetch(options, shard, start, end):
        import pyarrow as pa

        yield pa.RecordBatch.from_arrays([pa.array([shard] * (end - start)), pa.array(range(start, end))], ["shard_id", "n"])

    source = reader_source("arrow_a", tips, fetch, schema="shard_id string, n bigint", range_size=3)
    out = str(tmp_path / "out")
    stream = read_custom(spark, source, columns=("shard_id", "n"))
    query = stream.writeStream.format("parquet").option("path", out).option("checkpointLocation", str(tmp_path / "job")).start()
    query.processAllAvailable()
    query.stop()
    assert rows(spark.read.parquet(out), "n") == [(n,) for n in range(7)]


def test_put_function_as_a_sink(spark, events, tmp_path):
    folder = tmp_path / "sink"
    folder.mkdir()

    def put(options, batch):
        import uuid

        assert batch.num_rows <= 40
        (Path(options["folder"]) / f"{uuid.uuid4().hex}.json").write_text(json.dumps(batch["event_id"].to_pylist()))

    def on_commit(options, batch_id, count):
        (Path(options["folder"]) / f"commit-{batch_id}").write_text(str(count))

    sink = put_sink("puts_a", put, on_commit, batch_size=40)
    spark.dataSource.register(sink)
    events.select("event_id").write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema("event_id bigint").parquet(str(tmp_path / "in"))
    query = (
        stream.writeStream.format("puts_a")
        .option("folder", str(folder))
        .option("checkpointLocation", str(tmp_path / "job"))
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    ids = [i for p in folder.glob("*.json") for i in json.loads(p.read_text())]
    assert sorted(ids) == list(range(1000))
    assert [p.read_text() for p in folder.glob("commit-*")] == ["1000"]


def test_failing_put_aborts_the_batch(spark, events, tmp_path):
    def put(options, batch):
        raise RuntimeError("refused")

    def on_abort(options, batch_id):
        (Path(options["folder"]) / "aborted").write_text(str(batch_id))

    spark.dataSource.register(put_sink("puts_b", put, on_abort=on_abort))
    events.limit(5).write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(events.schema).parquet(str(tmp_path / "in"))
    query = (
        stream.writeStream.format("puts_b")
        .option("folder", str(tmp_path))
        .option("checkpointLocation", str(tmp_path / "job"))
        .trigger(availableNow=True)
        .start()
    )
    with pytest.raises(Exception, match="refused"):
        query.awaitTermination()
    assert (tmp_path / "aborted").read_text() == "0"


def moody_reader(name, calls):
    """A reader that notes every call, gives one record more each time it is asked for a shard, and never the same data."""

    def tips(options):
        return {"a": 5, "b": 5}

    def fetch(options, shard, start, end):
        from datetime import UTC, datetime
        from pathlib import Path
        from uuid import uuid4

        asked = len(list(Path(calls).glob(f"{shard}-*")))
        (Path(calls) / f"{shard}-{uuid4().hex}").touch()
        for i in range(start + 1 + asked):
            yield ("moody", shard, f"{i:06d}", "k", uuid4().hex.encode(), datetime(2024, 1, 1, tzinfo=UTC))

    return reader_source(name, tips, fetch, range_size=5)


@pytest.mark.parametrize("with_envelope", [False, True])
def test_a_reader_that_does_not_repeat_is_asked_once(spark, tmp_path, with_envelope):
    calls, job, out = tmp_path / "calls", str(tmp_path / "job"), str(tmp_path / "out")
    calls.mkdir()
    options, seen = SourceOptions(initial_position=TRIM_HORIZON), []

    def process(batch, batch_id):
        seen.append(rows(batch.select(F.decode("data", "UTF-8"))))
        write_batches(out)(batch, batch_id)
        if len(seen) == 1:
            raise RuntimeError("after it was written")

    source = moody_reader(f"moody_{with_envelope}".lower(), str(calls))
    for fails in (True, False):
        stream = read_custom(spark, source)
        query = start_consumer(stream, process, job, options, with_envelope=with_envelope, repeatable=False)
        try:
            query.processAllAvailable()
        except StreamingQueryException:
            assert fails
        query.stop()
    assert len(list(calls.iterdir())) == 2  # one range of each shard
    assert len(seen) == 2 and len(seen[0]) == 2 and seen[0] == seen[1] == rows(spark.read.parquet(out).select(F.decode("data", "UTF-8")))
    done = rows(current_progress(spark, job + "/progress"), "shard_id", "sequence_number")
    assert done == [("a", "000000"), ("b", "000000")]  # what it gave, not what it would give now


def test_a_job_that_was_reset_reads_again(spark, tmp_path):
    source, folder, job, out = file_reader("files_reset"), tmp_path / "in", tmp_path / "job", str(tmp_path / "out")
    options = SourceOptions(initial_position=TRIM_HORIZON)
    for lines in (["old"], ["new", "newer"]):
        write(folder, a=lines)
        query = start_consumer(read_custom(spark, source, folder=str(folder)), write_batches(out), str(job), options, repeatable=False)
        query.processAllAvailable()
        query.stop()
        assert rows(spark.read.parquet(out).select(F.decode("data", "UTF-8"))) == sorted((x,) for x in lines)
        (job / "checkpoint").rename(tmp_path / f"checkpoint-{lines[0]}")
