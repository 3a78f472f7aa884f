"""Reading the list of attempts in a put result."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def all_attempts_ok(attempts: Column | str) -> Column:
    """True when no attempt failed; true for an empty list."""
    return F.forall(attempts, lambda attempt: attempt["successful"])


def last_attempt(attempts: Column | str) -> Column:
    """The last attempt, null when there was none."""
    return F.try_element_at(F.col(attempts) if isinstance(attempts, str) else attempts, F.lit(-1))


def last_error_code(attempts: Column | str) -> Column:
    return last_attempt(attempts)["error_code"]


def last_error_message(attempts: Column | str) -> Column:
    return last_attempt(attempts)["error_message"]


def is_complete(shard_id: Column | str, sequence_number: Column | str) -> Column:
    """A result names both the shard and the sequence number it was stored under."""
    shard_id = F.col(shard_id) if isinstance(shard_id, str) else shard_id
    sequence_number = F.col(sequence_number) if isinstance(sequence_number, str) else sequence_number
    return shard_id.isNotNull() & sequence_number.isNotNull()
