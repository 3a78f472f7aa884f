"""Counting values that are nearly all different, such as ids."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Rows that one task counts; it holds their values.
TASK_ROWS = 500_000


def count_different(rows: DataFrame, by: str, column: str, into: str, task_rows: int | None = None) -> DataFrame:
    """Per ``by`` the number of different values of a column, nulls aside.

    ``countDistinct`` collects the values of a whole split before its shuffle, which for ids saves nothing and takes as much memory
    as there are rows in the split. Here rows are dealt out by value first, to as many tasks as their number asks for. Counts the
    rows for that, so it is for tables and micro-batches.
    """
    tasks = max(1, math.ceil(rows.count() / (task_rows or TASK_ROWS)))
    values = rows.select(by, column).repartition(tasks, by, column).distinct()
    return values.groupBy(by).agg(F.count(column).alias(into))
