"""Joining a log with small tables: one row per shard (progress, status, tips), or per other key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shardstream.session import settle

# A small table is sent to every executor only up to this size, which is counted first.
BROADCAST_ROWS = 1_000_000
BROADCAST_BYTES = 64 * 1024 * 1024

# A key with more rows than this is hot: its row of a larger table is copied, so that its rows go to this many tasks.
HOT_ROWS = 200_000
SALTS = 64


def fits_broadcast(table: DataFrame) -> bool:
    """Count the rows and the bytes of their text; the table should be settled or small."""
    text = [F.coalesce(F.octet_length(F.col(c).cast("string")), F.lit(0)) for c in table.columns]
    size = table.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum(sum(text, F.lit(0))), F.lit(0)).alias("b")).first()
    return size["n"] <= BROADCAST_ROWS and size["b"] <= BROADCAST_BYTES


def join_small(
    rows: DataFrame,
    table: DataFrame,
    keys: Sequence[str],
    how: str = "left",
    salt_by: str = "sequence_number",
    settled: bool = False,
    sizes: DataFrame | None = None,
) -> DataFrame:
    """Join ``rows`` with a table that has one row per ``keys``, adding the table's other columns.

    The table is settled (unless it already is) and measured: if it is small it is broadcast and
    ``rows`` do not move. Otherwise both sides are shuffled by key, and by a salt too where a key is hot. Only rows of the table
    with hot keys are copied for that. ``sizes`` has the ``_rows`` of every key, where these are known; else they are counted.
    """
    if how not in ("left", "inner"):
        raise ValueError(f"join_small does left and inner joins, not {how!r}")
    columns = [*rows.columns, *[c for c in table.columns if c not in keys]]
    if not settled:
        table = settle(table)
    if fits_broadcast(table):
        joined = rows.join(F.broadcast(table), [*keys], how)
    else:
        if sizes is None:
            sizes = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("_rows"))
        hot = settle(sizes.where(F.col("_rows") > HOT_ROWS).select(*keys, F.lit(True).alias("_hot")))
        if hot.isEmpty():
            joined = rows.join(table, [*keys], how)
        else:
            marked, copied = (side.join(F.broadcast(hot), [*keys], "left") for side in (rows, table))
            salt = F.when(F.col("_hot"), F.pmod(F.xxhash64(salt_by), F.lit(SALTS)).cast("int")).otherwise(0)
            salts = F.when(F.col("_hot"), F.sequence(F.lit(0), F.lit(SALTS - 1))).otherwise(F.array(F.lit(0)))
            copies = copied.withColumn("_salt", F.explode(salts)).drop("_hot")
            joined = marked.withColumn("_salt", salt).join(copies, [*keys, "_salt"], how)
    return joined.select(*columns)


def join_shards(
    rows: DataFrame,
    per_shard: DataFrame,
    how: str = "left",
    salt_by: str = "sequence_number",
    settled: bool = False,
) -> DataFrame:
    """``join_small`` on the shard."""
    return join_small(rows, per_shard, ["shard_id"], how, salt_by, settled)
