"""Similarity join of word shingles: groups of documents linked by their Jaccard similarity.

Candidates come from prefix filtering under several global orders of the shingles. In any order, two sets that are
similar enough share a shingle among the first few of each. The first order puts rare shingles first, by counts in
a table of fixed size; pairs it lets through must also share a shingle among the first ones of two random orders before
their whole sets are compared.

Documents with equal sets are one class. Classes that share a shingle are first compared with one of them, the one
in which the shingle stands earliest; classes that this links need not be compared with each other, as only groups
are asked for. Then all pairs are compared that the groups so far leave open.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shardstream.llm.common import Kept, map_rows, pin, small_batches
from shardstream.llm.components import connected_components
from shardstream.llm.fingerprints import mixed

WORDS, PERCENT = 5, 80
#: Entries of the table of counts that orders shingles: what is broadcast has this size however large the input.
COUNTERS = 1 << 20
#: Counters that one row holds where tasks hand theirs over: rows, and groups to sum up, are so many times fewer.
COUNTERS_A_ROW = 32
KEPT_WORDS = 120_000
SECOND = np.uint64(0x9E3779B97F4A7C15)


class Shingles:
    """Sorted 64-bit hashes of the distinct runs of ``size`` words; fewer words are one run, no words none."""

    def __init__(self, size: int):
        self.size, self.hashed = size, Kept(xxhash.xxh64_intdigest, KEPT_WORDS)

    def __call__(self, text: str | None) -> np.ndarray:
        words = (text or "").encode().lower().split()  # lower-cases A-Z, splits at the white space of ASCII
        found = np.fromiter(map(self.hashed.__getitem__, words), np.uint64, len(words))
        run = min(self.size, len(found))
        n = len(found) - run + 1 if run else 0
        out = np.zeros(n, np.uint64)
        for k in range(run):
            out = mixed(out + found[k : k + n])
        return np.unique(out)


def prefix_length(n: int, percent: int) -> int:
    return n - -(-percent * n // 100) + 1


def count_shingles(docs: DataFrame, size: int) -> np.ndarray:
    """How many documents have a shingle, summed over all shingles with the same low bits."""
    columns = [f"n{k}" for k in range(COUNTERS_A_ROW)]

    def run(batches):
        shingles, counts = Shingles(size), np.zeros(COUNTERS, np.int64)
        for batch in batches:
            for text in batch.column(0):
                np.add.at(counts, (shingles(text.as_py()) & np.uint64(COUNTERS - 1)).astype(np.int64), 1)
        counts = counts.reshape(-1, COUNTERS_A_ROW)
        place = np.flatnonzero(counts.any(axis=1))
        made = [pa.array(place.astype(np.int32)), *(pa.array(counts[place, k]) for k in range(COUNTERS_A_ROW))]
        yield pa.RecordBatch.from_arrays(made, ["place", *columns])

    counted = docs.select("text").mapInArrow(run, ", ".join(["place int", *(f"{c} bigint" for c in columns)]))
    counted = counted.groupBy("place").agg(*(F.sum(c).alias(c) for c in columns))
    counted = counted.select("place", *(F.least(c, F.lit(2**31 - 1)).cast("int").alias(c) for c in columns))
    with small_batches(docs.sparkSession):
        rows = counted.toArrow()  # at most COUNTERS / COUNTERS_A_ROW rows
    table = np.zeros((COUNTERS // COUNTERS_A_ROW, COUNTERS_A_ROW), np.int32)
    for k, c in enumerate(columns):
        table[rows["place"].to_numpy(), k] = rows[c].to_numpy()
    return table.reshape(-1)


def ordered_prefixes(docs: DataFrame, counts: np.ndarray, size: int, percent: int) -> DataFrame:
    """(id, digest, n, first): a digest of the whole set, its size, and its first shingles in the order of rareness."""
    shared = docs.sparkSession.sparkContext.broadcast(counts)

    def start():
        shingles = Shingles(size)

        def row(key, text):
            found = shingles(text)
            if not len(found):
                return key, None, 0, []
            common = shared.value[(found & np.uint64(COUNTERS - 1)).astype(np.int64)]
            first = found[np.lexsort((found, common))[: prefix_length(len(found), percent)]]
            return key, hashlib.md5(found.tobytes()).digest(), len(found), first.view(np.int64).tolist()

        return row

    return map_rows(docs, ["id", "text"], "id bigint, digest binary, n int, first array<bigint>", start)


def whole_sets(docs: DataFrame, ids: DataFrame, size: int, percent: int) -> DataFrame:
    """(id, n, tokens, second, third): whole sets of some documents and their first shingles in two random orders.

    ``ids`` is broadcast where its files are small enough for that, else the texts are shuffled.
    """

    def start():
        shingles = Shingles(size)

        def row(key, text):
            found = shingles(text)
            length = prefix_length(len(found), percent) if len(found) else 0
            other = found[np.argsort(mixed(found * SECOND), kind="stable")[:length]]
            return key, len(found), *(x.view(np.int64).tolist() for x in (found, found[:length], other))

        return row

    schema = "id bigint, n int, tokens array<bigint>, second array<bigint>, third array<bigint>"
    wanted = docs.join(ids.select("id"), "id", "left_semi")
    return map_rows(wanted, ["id", "text"], schema, start)


def may_link(percent: int, n: Column, at: Column, other_n: Column, other_at: Column) -> Column:
    """True unless the sizes, or what is left of either set after its place of the shared shingle, rule a link out.

    A pair that links passes at the first shingle that it shares.
    """
    needed = F.ceil(percent * (n + other_n) / F.lit(100 + percent) - 1e-9)
    similar_sizes = F.least(n, other_n) * 100 >= F.greatest(n, other_n) * percent
    return similar_sizes & (F.least(n - at, other_n - other_at) >= needed)


def links_of(pairs: DataFrame, docs: DataFrame, size: int, percent: int, repeats: bool) -> DataFrame:
    """Those of the pairs (a, b) of ids that link: both random orders let them through and whole sets are compared.

    Sets are brought together and compared, to leave one of each that an id has, only where ``repeats`` says that ids repeat.
    """
    pairs = pin(pairs.filter("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "pairs")
    ids = pin(pairs.select(F.explode(F.array("a", "b")).alias("id")).distinct(), "candidates")
    sets = whole_sets(docs, ids, size, percent)
    with small_batches(docs.sparkSession):
        sets = pin(sets.dropDuplicates(["id", "tokens"]) if repeats else sets, "sets")

    def beside(table: DataFrame, columns: list[str]) -> DataFrame:
        for side in "ab":
            table = table.join(sets.select(F.col("id").alias(side), *(F.col(c).alias(f"{side}_{c}") for c in columns)), side)
        return table

    passed = beside(pairs, ["second", "third"]).filter(
        F.arrays_overlap("a_second", "b_second") & F.arrays_overlap("a_third", "b_third")
    )
    both = beside(pin(passed.select("a", "b").distinct(), "pairs"), ["n", "tokens"])
    shared = F.size(F.array_intersect("a_tokens", "b_tokens"))
    return both.filter(shared * 100 >= (F.col("a_n") + F.col("b_n") - shared) * percent).select("a", "b").distinct()


def jaccard_groups(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = WORDS, percent: int = PERCENT
) -> DataFrame:
    """Group documents whose sets of shingles have a Jaccard similarity of ``percent`` or more.

    One row per input row: the id as a long, ``n_shingles`` and ``component_id``, the smallest id reachable by links. Every
    document is compared, and groups are those of an exhaustive comparison.

    A text of fewer than ``size`` words is one shingle. A null or empty text, or one of white space, has none and is
    alone. Rows that repeat an id are one document: what any of them links to belongs to the group of all. Rows
    with a null id get their number of shingles and a null component, and link with nothing. An empty table
    gives an empty table; other columns are not read.
    """
    docs = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    counts = count_shingles(docs, size)
    with small_batches(docs.sparkSession):
        rows = pin(ordered_prefixes(docs, counts, size, percent), "prefixes")
    linkable = rows.filter("id is not null and n > 0")
    repeats = not linkable.groupBy("id").agg(F.count("*").alias("m")).filter("m > 1").isEmpty()
    # Copies meet here; all but the one with the smallest id are left behind.
    reps = linkable.groupBy("digest").agg(F.min("id").alias("rep"), F.min_by(F.struct("n", "first"), "id").alias("set"))
    reps = pin(reps.select("digest", "rep", "set.n", "set.first"), "classes")

    postings = reps.select(F.col("rep").alias("id"), "n", F.posexplode("first").alias("at", "token"))
    often = postings.groupBy("token").agg(F.count("*").alias("m")).filter("m > 1").select("token")
    postings = pin(postings.join(often, "token"), "postings")

    pivot = postings.groupBy("token").agg(
        F.min(F.struct((F.col("at") / F.col("n")).alias("share"), "id", "n", "at")).alias("pivot")
    )
    other = F.col("pivot")
    close = may_link(percent, F.col("n"), F.col("at"), other["n"], other["at"])
    stars = postings.join(pivot, "token").filter(close).select(F.col("id").alias("a"), other["id"].alias("b"))
    links = pin(links_of(stars, docs, size, percent, repeats), "links")

    found = connected_components(links)
    grouped = postings.join(found.withColumnRenamed("node", "id"), "id", "left")
    grouped = pin(grouped.select("token", "id", "n", "at", F.coalesce("component", "id").alias("component")), "postings")
    # Only pairs across groups are open. Those within a token's largest group are never made.
    parts = grouped.groupBy("token", "component").agg(F.count("*").alias("m")).groupBy("token")
    parts = parts.agg(F.max(F.struct("m", "component")).alias("largest"), F.count("*").alias("groups")).filter("groups > 1")
    grouped = grouped.join(parts.select("token", F.col("largest.component").alias("main")), "token")
    grouped = pin(grouped, "open")
    few = grouped.filter("component <> main").select("token", *(F.col(c).alias(f"a_{c}") for c in ("id", "n", "at", "component")))
    across = (F.col("component") != F.col("a_component")) & ((F.col("component") == F.col("main")) | (F.col("a_id") < F.col("id")))
    close = may_link(percent, F.col("n"), F.col("at"), F.col("a_n"), F.col("a_at"))
    rest = few.join(grouped, "token").filter(across & close).select(F.col("a_id").alias("a"), F.col("id").alias("b"))
    links = links.unionByName(links_of(rest, docs, size, percent, repeats))

    # An id that stands for several sets links their classes.
    classes = linkable.select("id", "digest").distinct().join(reps.select("digest", "rep"), "digest")
    several = classes.groupBy("id").agg(F.min("rep").alias("a"), F.count("*").alias("m")).filter("m > 1")
    links = links.unionByName(classes.join(several, "id").select("a", F.col("rep").alias("b")).filter("a <> b"))

    components = connected_components(links).withColumnRenamed("node", "rep")
    component = reps.select("digest", "rep").join(components, "rep", "left")
    component = component.select("digest", F.coalesce("component", "rep").alias("component_id"))
    alone = F.when(F.col("n") == 0, F.col("id"))
    return rows.select("id", "n", "digest").join(component, "digest", "left").select(
        F.col("id").alias(id_col),
        F.col("n").cast("long").alias("n_shingles"),
        F.when(F.col("id").isNotNull(), F.coalesce("component_id", alone)).alias("component_id"),
    )
