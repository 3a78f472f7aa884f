"""Exact copies: grouped by a 128-bit hash of their bytes, the bytes compared inside the groups.

DataFrame functions only. Texts are read twice and moved only where their hash repeats, a text once for each task that
holds copies of it; what is shuffled otherwise is the hash and the id of a row.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shardstream.llm.common import pin
from shardstream.operators.shards import fits_broadcast

LARGEST, SMALLEST = "largest", "smallest"
#: Groups of at least this share of the rows are joined without moving the rows; there are no more than its inverse.
HEAVY = 1 / 10_000


def content_hash(text: Column) -> Column:
    """128 bits of a text's UTF-8 bytes."""
    return F.unhex(F.md5(text))


def exact_copies(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    keep: str = SMALLEST,
    also: Mapping[str, Column] | None = None,
) -> DataFrame:
    """Say of every row which row of equal text stays: the one with the smallest id, or the largest.

    One row per input row: the id, ``keep_id``, ``group_size`` (rows of equal text, itself included), ``kept``, and the columns
    of ``also``, which are computed where the texts are read and may use all columns of ``docs``. Texts are equal if their
    bytes are, whatever their hashes.

    A null text counts as empty, and empty texts are equal. A row with a null id counts in ``group_size`` and stays only where no
    row of its text has an id; ``keep_id`` is null then. Rows that repeat an id and a text are all kept if their id is
    the one that stays, as an id names one document. An empty table gives an empty table; columns of other names, those of
    the result too, are neither read nor passed on.
    """
    if keep not in (LARGEST, SMALLEST):
        raise ValueError(f"keep must be {LARGEST!r} or {SMALLEST!r}, not {keep!r}")
    also = dict(also or {})
    text = F.coalesce(F.col(text_col), F.lit(""))
    best = F.max if keep == LARGEST else F.min
    read = [F.col(id_col).alias("_id"), content_hash(text).alias("_hash")]
    carried = F.struct(*[c.alias(n) for n, c in also.items()]) if also else F.lit(0)
    hashed = pin(docs.select(*read, carried.alias("_also")), "hashed")

    sizes = hashed.groupBy("_hash").agg(F.count("*").alias("_n"))
    repeated = pin(sizes.filter("_n > 1"), "repeated")
    # Texts with the hash of another row: found before anything is shuffled where the hashes fit, else all texts are grouped.
    texts = docs.select(*read, text.alias("_text"))
    if fits_broadcast(repeated):
        texts = texts.join(F.broadcast(repeated.select("_hash")), "_hash", "left_semi")
    classes = texts.groupBy("_hash", "_text").agg(F.count("*").alias("_n"), best("_id").alias("_keep"))
    alike = classes.groupBy("_hash").agg(
        F.count("*").alias("_texts"), F.sum("_n").alias("_n"), F.min("_keep").alias("_keep")
    )
    alike = pin(alike.filter("_n > 1"), "alike")

    rows = _with_group(hashed, alike.filter("_texts = 1").select("_hash", "_n", "_keep"))
    collided = alike.filter("_texts > 1").select("_hash")
    if not collided.isEmpty():
        same_hash = docs.select(*read, carried.alias("_also"), text.alias("_text")).join(collided, "_hash", "left_semi")
        rows = rows.join(collided, "_hash", "left_anti").unionByName(_with_text_group(same_hash, best))
    keep_id = F.when(F.col("_n").isNull(), F.col("_id")).otherwise(F.col("_keep"))
    return rows.withColumn("_keep", keep_id).select(
        F.col("_id").alias(id_col),
        F.col("_keep").alias("keep_id"),
        F.coalesce("_n", F.lit(1)).cast("long").alias("group_size"),
        F.col("_id").eqNullSafe(F.col("_keep")).alias("kept"),
        *[F.col("_also")[n].alias(n) for n in also],
    )


def _with_group(hashed: DataFrame, groups: DataFrame) -> DataFrame:
    """Rows with their group's size and kept id, null where there is no group.

    The largest groups are sent to the rows, so that those of one text are not brought together.
    """
    least = max(2, int(hashed.count() * HEAVY))
    heavy = groups.filter(F.col("_n") >= least)
    light = groups.filter(F.col("_n") < least)
    marked = hashed.join(F.broadcast(heavy), "_hash", "left")  # at most 1 / HEAVY groups
    columns = ["_id", "_hash", "_also", "_n", "_keep"]
    done = marked.filter("_n is not null").select(*columns)
    # Groups under a ten-thousandth of the rows; rows of no group have a hash of their own.
    rest = marked.filter("_n is null").drop("_n", "_keep").join(light, "_hash", "left").select(*columns)
    return done.unionByName(rest)


def _with_text_group(rows: DataFrame, best: Callable) -> DataFrame:
    """Rows whose hash belongs to several texts, with the size and kept id of their own text's group."""
    classes = rows.groupBy("_hash", "_text").agg(F.count("*").alias("_n"), best("_id").alias("_keep"))
    return rows.join(classes, ["_hash", "_text"]).select("_id", "_hash", "_also", "_n", "_keep")
