"""User functions over record sets."""

from __future__ import annotations

from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import DataFrame

SetFunction = Callable[[pa.Table], pa.Table]


def process_record_sets(fetches: DataFrame, process: SetFunction, schema: str) -> DataFrame:
    """Call ``process`` once per fetch with its records, an Arrow table in sequence order.

    A fetch is bounded by ``with_fetch``, so a hot shard is many calls on many workers. What a shard
    comes to as a whole is an aggregate over the results.
    """

    def run(records: pa.Table) -> pa.Table:
        return process(records.sort_by("sequence_number"))

    return fetches.groupBy("shard_id", "fetch_no").applyInArrow(run, schema)
