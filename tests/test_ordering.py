"""Positions and running sums: the bucketed way equals one window over the shard."""

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.errors.exceptions.captured import SparkRuntimeException
from pyspark.sql import Window
from pyspark.sql import functions as F

from shardstream.operators import ordering
from shardstream.operators.ordering import (
    MAX,
    Scan,
    _cut,
    _first_prefix,
    _range,
    rank_by_sequence,
    sums_before,
    with_position,
)
from tests.helpers import rows


def size():
    return {"before": F.octet_length("data").cast("bigint")}


def one_pass(records):
    w = Window.partitionBy("shard_id").orderBy("sequence_number").rowsBetween(Window.unboundedPreceding, -1)
    return records.withColumn("before", F.coalesce(F.sum(F.octet_length("data")).over(w), F.lit(0)))


@pytest.fixture
def window_rows(monkeypatch):
    return lambda n: monkeypatch.setattr(ordering, "WINDOW_ROWS", n)


@pytest.mark.parametrize("limit", [1, 3, 10, 50, 100_000])
def test_small_buckets_give_the_window_result(log, window_rows, limit):
    window_rows(limit)
    got = sums_before(log, ["shard_id"], "sequence_number", size())
    assert got.columns == [*log.columns, "before"]
    columns = ("shard_id", "sequence_number", "before")
    assert rows(got, *columns) == rows(one_pass(log), *columns)


def first_prefix(made, order, largest):
    value = F.col(order)
    ends = made.agg(F.min(value), F.max(value), F.max(F.length(value))).first()
    return _first_prefix(*ends, largest, ordering.WINDOW_ROWS)


def cut(records, length=None):
    """Sizes of the buckets, and the totals per shard, of one cut."""
    length = length or first_prefix(records, "sequence_number", records.count())
    bucketed, totals = _cut(records, ["shard_id"], "sequence_number", "b", length, size(), ordering.WINDOW_ROWS)
    return [r[0] for r in bucketed.groupBy("shard_id", "b").count().select("count").collect()], totals


def test_no_task_numbers_more_than_it_may(log, window_rows):
    window_rows(20)
    sizes, totals = cut(log)
    assert max(sizes) <= 20 and sum(sizes) == 1000
    assert totals.count() == len(sizes)
    assert totals.groupBy("shard_id").count().agg(F.max("count")).first()[0] > 20


def test_only_large_buckets_are_cut_further(spark, window_rows):
    """A third of a hot shard lies behind one long common prefix."""
    window_rows(1000)
    sizes, totals = cut(hot_prefix(spark))
    assert max(sizes) <= 1000
    assert len(sizes) < 800


def test_shared_characters_are_skipped(spark, window_rows):
    window_rows(10)
    made = spark.range(1000).select(F.concat(F.lit("tenant/a/"), F.lpad(F.col("id").cast("string"), 8, "0")).alias("s"))
    assert first_prefix(made, "s", 1000) == len("tenant/a/00000") + 2
    assert first_prefix(made.select(F.lit("x").alias("s")), "s", 1000) == 0


def test_empty_table(spark, log):
    none = log.where("false")
    assert with_position(none).count() == 0


def test_unpadded_numbers_come_in_string_order(spark):
    made = spark.range(0, 1001).select(F.col("id").cast("string").alias("sequence_number"))
    ranked = dict(rows(rank_by_sequence(made), "sequence_number", "sequence_rank"))
    in_order = sorted(ranked, key=ranked.get)
    assert in_order == sorted(str(i) for i in range(1001))
    assert in_order[:4] == ["0", "1", "10", "100"]


def test_equal_numbers_of_two_shards_come_in_shard_order(spark):
    made = spark.createDataFrame([("b", "1"), ("a", "1"), ("a", "0")], "shard_id string, sequence_number string")
    ranked = rows(rank_by_sequence(made), "sequence_rank", "shard_id", "sequence_number")
    assert ranked == [(1, "a", "0"), (2, "a", "1"), (3, "b", "1")]


def test_missing_numbers_are_kept(spark, window_rows):
    window_rows(1)
    made = spark.createDataFrame([("a", None), ("a", "11"), ("a", "12")], "shard_id string, sequence_number string")
    assert rows(with_position(made), "position", "sequence_number") == [(0, None), (1, "11"), (2, "12")]


def test_equal_numbers_are_all_numbered(spark, window_rows):
    window_rows(2)
    made = spark.createDataFrame([("a", "77")] * 5 + [("a", "12")], "shard_id string, sequence_number string")
    assert [r[0] for r in rows(with_position(made), "position")] == [0, 1, 2, 3, 4, 5]


def hot_prefix(spark):
    return spark.range(0, 30_000).select(
        F.when(F.col("id") % 100 == 0, "cold").otherwise("hot").alias("shard_id"),
        F.when(F.col("id") % 3 == 0, F.concat(F.lit("tenant-000000001-"), F.lpad(F.col("id").cast("string"), 6, "0")))
        .otherwise(F.md5(F.col("id").cast("string").cast("binary")))
        .alias("sequence_number"),
        F.encode(F.lit("x"), "UTF-8").alias("data"),
    )


def test_hot_shard_with_one_hot_prefix(spark, window_rows):
    window_rows(1000)
    hot = hot_prefix(spark)
    columns = ("shard_id", "sequence_number", "before")
    assert rows(sums_before(hot, ["shard_id"], "sequence_number", size()), *columns) == rows(one_pass(hot), *columns)


@settings(max_examples=10, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(
    numbers=st.lists(st.text("019a", min_size=1, max_size=6), unique=True, min_size=1, max_size=40),
    limit=st.integers(1, 8),
)
def test_position_is_the_place_in_string_order(spark, numbers, limit):
    made = spark.createDataFrame([("x", n) for n in numbers], "shard_id string, sequence_number string")
    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(ordering, "WINDOW_ROWS", limit)
        got = {r.sequence_number: r.position for r in with_position(made).collect()}
    assert got == {n: i for i, n in enumerate(sorted(numbers))}


def test_rows_that_change_while_they_are_numbered_stop_the_job(log):
    rows_ = log.select("shard_id", "sequence_number", "data")
    bucketed, totals = _cut(rows_, ["shard_id"], "sequence_number", "b", 18, size(), 20)
    less = totals.where("b <> '000000000000000000'")
    starts = sums_before(less, ["shard_id"], "b", {"_start_before": F.col("_total_before")})
    late = bucketed.join(starts.select("shard_id", "b", "_start_before"), ["shard_id", "b"], "left")
    with pytest.raises(SparkRuntimeException, match="rows changed"):
        late.select(ordering._counted("_start_before")).collect()


def uneven(spark):
    """Numbers of which nearly each has a prefix of its own, and runs that share all but their ends."""
    run = F.concat(F.lit("7" * 40), F.lpad(F.col("id").cast("string"), 6, "0"))
    number = F.when(F.col("id") % 3 == 0, run).otherwise(F.md5(F.col("id").cast("string").cast("binary")))
    shard = F.when(F.col("id") % 50 == 0, "cold").otherwise("hot")
    data = F.encode(F.repeat(F.lit("x"), (F.col("id") % 7).cast("int")), "UTF-8")
    return spark.range(0, 5000).select(shard.alias("shard_id"), number.alias("sequence_number"), data.alias("data"))


@pytest.mark.parametrize("limit", [16, 300])
def test_measured_ranges_hold_no_more_rows_than_a_task_may_number(spark, limit):
    sums = {"before": Scan(F.octet_length("data").cast("bigint"))}
    bucketed, totals = _range(uneven(spark), ["shard_id"], ["sequence_number"], "b", sums, limit, 5000)
    assert totals.agg(F.max("_rows"), F.sum("_rows")).first() == (totals.agg(F.max("_rows")).first()[0], 5000)
    assert totals.agg(F.max("_rows")).first()[0] <= limit
    ends = bucketed.groupBy("shard_id", "b").agg(F.min("sequence_number"), F.max("sequence_number"))
    spans = rows(ends)
    assert all(a[0] != b[0] or a[3] < b[2] for a, b in zip(spans, spans[1:], strict=False))


@pytest.mark.parametrize("limit", [12, 700])
def test_uneven_numbers_give_the_window_result(spark, window_rows, limit):
    window_rows(limit)
    columns = ("shard_id", "sequence_number", "before")
    assert rows(sums_before(uneven(spark), ["shard_id"], "sequence_number", size()), *columns) == rows(
        one_pass(uneven(spark)), *columns
    )


@pytest.mark.parametrize("limit", [3, 40, 100_000])
def test_running_maxima(log, window_rows, limit):
    window_rows(limit)
    value = F.pmod(F.xxhash64("sequence_number"), F.lit(1000))
    w = Window.partitionBy("shard_id").orderBy("sequence_number").rowsBetween(Window.unboundedPreceding, -1)
    want = log.withColumn("before", F.max(value).over(w))
    got = sums_before(log, ["shard_id"], "sequence_number", {"before": Scan(value, MAX)})
    columns = ("shard_id", "sequence_number", "before")
    assert rows(got, *columns) == rows(want, *columns)


def test_all_rows_equal(spark, window_rows):
    window_rows(8)
    made = spark.createDataFrame([("a", "7")] * 50, "shard_id string, sequence_number string")
    assert [r[0] for r in rows(with_position(made).withColumn("position", F.col("position").cast("int")), "position")] == sorted(
        range(50), key=str
    )


def test_small_windows_do_not_make_more_ranges_than_tasks_need(spark):
    """A range is a task and a file: there must not be one for every few rows."""
    made = spark.range(20_000).select(F.md5(F.col("id").cast("string")).alias("sequence_number"))
    bucketed, totals = _range(made, [], ["sequence_number"], "b", {"n": Scan(F.lit(1).cast("bigint"))}, 16, 20_000)
    assert totals.agg(F.max("_rows"), F.sum("_rows")).first() == (16, 20_000)
    assert len(bucketed.inputFiles()) <= 10
    spans = rows(bucketed.groupBy("b").agg(F.min("sequence_number"), F.max("sequence_number")))
    assert all(a[2] < b[1] for a, b in zip(spans, spans[1:], strict=False))
