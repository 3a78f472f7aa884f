"""Accounting of puts: attempts, delays, results that are missing."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shardstream.functions.retry import (
    RECORD_FAILED,
    RetryPolicy,
    classify,
    delay_after_ms,
    due_ms,
    total_backoff_ms,
)


def unacknowledged(requests: DataFrame, results: DataFrame) -> DataFrame:
    """Requests without a result. The put is drained exactly when there is none.

    Repeated results of one request are dropped before they are shuffled.
    """
    return requests.join(results.select("request_id").distinct(), "request_id", "left_anti")


def attempt_schedule(results: DataFrame, policy: RetryPolicy) -> DataFrame:
    """One row per attempt that was made: its number, earliest start and what followed it.

    Read from the attempts that results keep. Every failed attempt of a record was one of the record.
    """
    rows = results.withColumn("_made", F.explode("attempts"))
    attempt = F.col("_made")["attempt"].cast("bigint")
    return rows.withColumns(
        {
            "attempt": attempt,
            "due_ms": due_ms(attempt, policy),
            "status": classify(F.col("_made")["successful"], F.lit(RECORD_FAILED), attempt, policy),
        }
    ).drop("_made")


def retry_outcome(results: DataFrame, policy: RetryPolicy) -> DataFrame:
    """State per result: retries used, attempts made, what follows the last one, and summed delay."""
    last = F.try_element_at("attempts", F.lit(-1))
    made = F.size("attempts").cast("bigint")
    return results.withColumns(
        {
            "retries": made - 1,
            "attempts_made": made,
            "status": classify(last["successful"], F.lit(RECORD_FAILED), made, policy),
            "backoff_ms": total_backoff_ms(made - 1, policy),
        }
    )


def due_later(requests: DataFrame, results: DataFrame, policy: RetryPolicy) -> DataFrame:
    """Requests that are to be put again: with the ``attempts`` made so far and ``wait_ms``, the wait after the last one.

    ``put_through`` takes them up where they are once that time is over. Only results that are not final are joined.
    """
    made = F.size("attempts")
    open_ = results.where(~F.col("successful") & (made <= policy.max_retries))
    open_ = open_.select("request_id", "attempts", delay_after_ms(made, policy).alias("wait_ms"))
    return requests.drop("attempts", "wait_ms").join(open_, "request_id")
