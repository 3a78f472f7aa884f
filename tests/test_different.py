"""Counting different values over tasks of bounded size."""

from pyspark.sql import functions as F

from shardstream.operators.different import count_different
from tests.helpers import rows


def test_as_count_distinct_with_nulls_and_repeats(spark):
    value = F.when(F.col("id") % 5 > 0, (F.col("id") % 700).cast("string"))
    made = spark.range(3000).select((F.col("id") % 3).alias("k"), value.alias("v"))
    want = made.groupBy("k").agg(F.countDistinct("v").alias("n"))
    assert rows(count_different(made, "k", "v", "n", task_rows=100), "k", "n") == rows(want, "k", "n")
    assert rows(count_different(made.where("v is null"), "k", "v", "n")) == [(0, 0), (1, 0), (2, 0)]
    assert count_different(made.where("false"), "k", "v", "n").count() == 0


def test_rows_are_dealt_out_before_values_are_collected(spark, tmp_path):
    spark.range(3000).select(F.lit("a").alias("k"), F.col("id").alias("v")).coalesce(1).write.parquet(str(tmp_path / "ids"))
    plan = count_different(spark.read.parquet(str(tmp_path / "ids")), "k", "v", "n", task_rows=100)
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(k" in text and ", 30), REPARTITION_BY_NUM" in text
    below = text[text.index("REPARTITION_BY_NUM") :]
    assert "HashAggregate" not in below


def test_put_stream_counts_ids_that_way(spark, small):
    from shardstream.plans.queries import QUERIES

    text = QUERIES["put_stream"](spark, small)._jdf.queryExecution().executedPlan().toString()
    assert "Expand" not in text
    assert text.count("REPARTITION_BY_NUM") == 2
