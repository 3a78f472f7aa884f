"""Retry rules of a put, as settings on the driver and as columns.

Attempts count from 1. A record-level failure on attempt ``a`` is tried again while
``a <= max_retries``; any other error fails at once.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from itertools import accumulate

from pyspark.sql import Column
from pyspark.sql import functions as F

EXPONENTIAL = "exponential"
LINEAR = "linear"

SUCCESS = "success"
RETRY = "retry"
FAILED = "failed"

RECORD_FAILED = "record_failed"

_LONGEST_DELAY = 2**63 - 1


def delay_ms(strategy: str, base_ms: int, attempt: int) -> int:
    """Wait after failed attempt ``attempt``: ``base ** attempt`` or ``base * attempt`` milliseconds."""
    if strategy == EXPONENTIAL:
        return base_ms**attempt
    if strategy == LINEAR:
        return base_ms * attempt
    raise ValueError(f"unknown backoff strategy {strategy!r}")


@dataclass(frozen=True)
class RetryPolicy:
    max_retries: int = 5
    strategy: str = EXPONENTIAL
    base_ms: int = 100

    def __post_init__(self):
        if self.max_retries < 0 or self.base_ms < 0:
            raise ValueError("max_retries and base_ms must not be negative")
        if self.totals()[-1] > _LONGEST_DELAY:
            raise ValueError("the delays of this policy do not fit into 64 bits")

    def delays(self) -> list[int]:
        """Waits after failed attempts 1 to ``max_retries``."""
        return [delay_ms(self.strategy, self.base_ms, a) for a in range(1, self.max_retries + 1)]

    def totals(self) -> list[int]:
        """Summed waits after 0 to ``max_retries`` retries."""
        return list(accumulate(self.delays(), initial=0))


def _pick(values: Sequence[int], index: Column) -> Column:
    """``values[index]`` from an exact constant array; null outside of it."""
    constants = F.array(*[F.lit(v) for v in values]).cast("array<bigint>")
    return F.try_element_at(constants, (index + 1).cast("int"))


def retries_used(failures: Column | str, policy: RetryPolicy) -> Column:
    failures = F.col(failures) if isinstance(failures, str) else failures
    return F.least(failures, F.lit(policy.max_retries).cast("bigint"))


def final_status(failures: Column | str, policy: RetryPolicy) -> Column:
    """State once nothing is left to try, for a record whose first ``failures`` attempts fail."""
    failures = F.col(failures) if isinstance(failures, str) else failures
    return F.when(failures > policy.max_retries, FAILED).otherwise(SUCCESS)


def total_backoff_ms(retries: Column | str, policy: RetryPolicy) -> Column:
    """Summed waits of a record that was retried ``retries`` times (0 to ``max_retries``)."""
    return _pick(policy.totals(), F.col(retries) if isinstance(retries, str) else retries)


def due_ms(attempt: Column | str, policy: RetryPolicy) -> Column:
    """Earliest start of an attempt, in milliseconds after the first one was put."""
    attempt = F.col(attempt) if isinstance(attempt, str) else attempt
    return _pick(policy.totals(), attempt - 1)


def delay_after_ms(attempt: Column | str, policy: RetryPolicy) -> Column:
    """Wait after a failed attempt; null for an attempt that is not followed by another."""
    attempt = F.col(attempt) if isinstance(attempt, str) else attempt
    return _pick(policy.delays(), attempt - 1)


def classify(successful: Column, error_kind: Column, attempt: Column, policy: RetryPolicy) -> Column:
    """What follows one put: done, another attempt, or failure of the whole job."""
    may_retry = (error_kind == RECORD_FAILED) & (attempt <= policy.max_retries)
    return F.when(successful, SUCCESS).when(may_retry, RETRY).otherwise(FAILED)
