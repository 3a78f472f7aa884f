"""Winnowing: a text's fingerprint is the smallest k-gram hash of every window, the rightmost one on ties.

Two texts that share a stretch of ``K + WINDOW - 1`` characters share a chosen hash; stretches under ``K``
characters never match. Positions are kept, so that a match can be found again in both texts.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shardstream.llm.common import map_rows, partitions

K, WINDOW = 8, 16
BLOCK = 1 << 20
PLACE_BITS = 22  # places within a block and its overlap, in the low bits of what is compared
ODD = 0x9E3779B97F4A7C15


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def rolled(codes: np.ndarray, k: int) -> np.ndarray:
    """Polynomial hash of each run of ``k`` code points, by doubling the length of what is hashed."""
    power, length, step = mixed(codes.astype(np.uint64) + np.uint64(ODD)), 1, ODD
    out, done = None, 0
    while True:
        if k & length:
            piece = power[done:]
            out = piece if out is None else out[: len(piece)] * np.uint64(step) + piece[: len(out)]
            done += length
        if done == k:
            return mixed(out[: len(codes) - k + 1])
        power = power[:-length] * np.uint64(step) + power[length:]
        step, length = step * step % (1 << 64), length * 2


def smallest(values: np.ndarray, window: int) -> np.ndarray:
    """Minimum of each window, by doubling."""
    length = 1
    while length * 2 <= window:
        values = np.minimum(values[:-length], values[length:])
        length *= 2
    rest = window - length
    return np.minimum(values[: len(values) - rest], values[rest:]) if rest else values


def winnow(text: str, k: int = K, window: int = WINDOW) -> tuple[np.ndarray, np.ndarray]:
    """Places and 40-bit hashes that winnowing chooses. A text of under ``k`` characters is one gram, an empty one none."""
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    if not len(codes):
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    k = min(k, len(codes))
    grams = len(codes) - k + 1
    window = min(window, grams)
    low = np.uint64((1 << PLACE_BITS) - 1)
    places, hashes = [], []
    for at in range(0, grams - window + 1, BLOCK):
        until = min(at + BLOCK + window - 1, grams)
        found = rolled(codes[at : until + k - 1], k) & ~low
        found |= low - np.arange(until - at, dtype=np.uint64)  # the rightmost of equal hashes is the smallest
        chosen = smallest(found, window)
        chosen = chosen[np.r_[True, chosen[1:] != chosen[:-1]]]
        places.append(at + (low - (chosen & low)).astype(np.int64))
        hashes.append(chosen >> np.uint64(PLACE_BITS))
    places, hashes = np.concatenate(places), np.concatenate(hashes)
    first = np.r_[True, places[1:] != places[:-1]]
    return places[first], hashes[first]


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """Shared part of two sets of hashes; 1 for two empty ones."""
    if not len(a) or not len(b):
        return float(len(a) == len(b))
    shared = len(np.intersect1d(a, b, assume_unique=True))
    return shared / (len(a) + len(b) - shared)


def fingerprint_texts(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = K, window: int = WINDOW
) -> DataFrame:
    """Fingerprint every whole text: id, ``n_chars`` and ``grams``, an array of (place, hash) in order of place.

    A null or empty text has no grams. Null ids and repeated rows are kept; an empty table gives an empty
    table; other columns are not read. Long texts are worked through in blocks. Nothing is shuffled.
    """

    def start():
        def fingerprint(key, text):
            places, hashes = winnow(text or "", k, window)
            return key, len(text or ""), grams(places, hashes)

        return fingerprint

    kind = docs.schema[id_col].dataType.simpleString()
    schema = f"{id_col} {kind}, n_chars bigint, grams array<struct<place: bigint, hash: bigint>>"
    return map_rows(docs, [id_col, text_col], schema, start)


def sliced(rows: DataFrame, slices: int) -> tuple[DataFrame, list[int]]:
    """The rows with a ``slice`` number: slices follow each other from high ids to low ones and hold about as many
    rows each; null ids are the last. Also the numbers of the slices that hold rows."""
    cuts = rows.select(F.percentile_approx("id", [k / slices for k in range(1, slices)], 100 * slices)).first()[0]
    cuts = np.unique(np.array(cuts or [], np.int64))

    @F.pandas_udf("int")
    def number(ids: pd.Series) -> pd.Series:
        place = len(cuts) - np.searchsorted(cuts, ids.fillna(0).to_numpy(np.int64))
        return pd.Series(np.where(ids.isna(), len(cuts) + 1, place).astype(np.int32))

    numbered = rows.withColumn("slice", number("id"))
    return numbered, sorted(r[0] for r in numbered.select("slice").distinct().collect())


def with_context(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """All rows in slices of ids, and at the end of each slice a copy of the row that comes next (``own`` false).

    The order is by falling id, then falling text, null ids last; the row after the last one is the first. The
    texts are shuffled once; the copies are one row a slice.
    """
    n = partitions(docs.sparkSession)
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    numbered, present = sliced(rows, 2 * n)
    heads = numbered.groupBy("slice").agg(F.max("id").alias("id")).collect()
    before = dict(zip(present, present[-1:] + present[:-1], strict=True))  # the slice whose last row meets this head
    ids = [h.id for h in heads if h.id is not None]
    some = F.col("id").isin(ids) if len(ids) == len(heads) else F.col("id").isin(ids) | F.col("id").isNull()
    texts = rows.filter(some).groupBy("id").agg(F.max("text").alias("text"))
    to = {h.id: before[h.slice] for h in heads}
    known = F.create_map(*(F.lit(x) for h in ids for x in (h, to[h]))) if ids else F.create_map(F.lit(0), F.lit(0))
    copies = texts.select(
        "id", "text", F.coalesce(F.try_element_at(known, F.col("id")), F.lit(to.get(None))).cast("int").alias("slice")
    )
    both = numbered.withColumn("own", F.lit(True)).unionByName(copies.withColumn("own", F.lit(False)))
    return both.repartitionById(n, "slice").sortWithinPartitions(
        "slice", F.desc("own"), F.desc_nulls_last("id"), F.desc("text")
    )


def edited(text: str, following: str) -> str:
    """The text with its last third, rounded down, replaced by as many first characters of the following one."""
    third = len(text) // 3
    return text[: len(text) - third] + following[:third]


def compare_with_next(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = K, window: int = WINDOW
) -> DataFrame:
    """Fingerprint every text and its edited form, and compare both with the text and with the next row's.

    One row per input row: the id as a long, ``n_chars``, ``edited_sha256``, ``grams`` and ``edited_grams`` as in
    ``fingerprint_texts``, ``near_edited`` and ``near_next``. The next row is that of the next lower id; the
    lowest id is followed by the highest. Repeated ids follow each other by falling text, null ids come last and
    nulls count as empty texts. A single row is its own next one. An empty table gives an empty table; other
    columns are not read.
    """
    schema = (
        f"{id_col} bigint, n_chars bigint, edited_sha256 string, grams array<struct<place: bigint, hash: bigint>>,"
        " edited_grams array<struct<place: bigint, hash: bigint>>, near_edited double, near_next double"
    )

    def start():
        held = []

        def compare(part, key, text, own):
            places, hashes = winnow(text, k, window)
            now = (part, key, text, places, hashes, np.unique(hashes))
            out = []
            if held and held[0][0] == part:
                _, key, text, places, hashes, known = held.pop()
                changed = edited(text, now[2])
                e_places, e_hashes = winnow(changed, k, window)
                digest = hashlib.sha256(changed.encode("utf-8", "surrogatepass")).hexdigest()
                near = likeness(known, np.unique(e_hashes)), likeness(known, now[5])
                out.append((key, len(text), digest, grams(places, hashes), grams(e_places, e_hashes), *near))
            held[:] = [now]
            return out

        return compare

    return map_rows(with_context(docs, id_col, text_col), ["slice", "id", "text", "own"], schema, start, many=True)


def grams(places: np.ndarray, hashes: np.ndarray) -> list[dict]:
    return [{"place": p, "hash": h} for p, h in zip(places.tolist(), hashes.tolist(), strict=True)]
