"""Importance resampling: documents are weighted by how much likelier their n-grams are in good text than in all text.

Two generative models over hashed n-grams are compared: the target model counts the n-grams of documents labelled
good, the raw model those of all documents. An n-gram is a word, or the shapes of two neighbours in a row
with whether each repeats the word before it. A document's weight is the mean log ratio of its n-grams. N-grams are
counted in buckets, whose number grows with the corpus as its vocabulary does.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shardstream.llm.common import Kept, add_columns, labelled_sample, pin, small_batches

#: Buckets of words for each square root of a byte of text, which is how vocabularies grow, and at least so many.
BUCKETS_PER_ROOT, LEAST_WORD_BUCKETS = 6, 1 << 16
#: Buckets of words for each bucket of shapes.
WORDS_PER_SHAPE = 4
#: Labelled documents of each label that the target model and the cut are fitted on.
MOST_LABELLED = 20_000
TEMPERATURE = 0.02
KEPT_WORDS = 120_000
BINS_PER_UNIT = 100
COLLECTED_KEYS = 10_000


def shape(word: str) -> str:
    """Kinds of characters in a row: U, l, 9 or the character itself, and + where one repeats."""
    out: list[str] = []
    for ch in word:
        kind = "U" if ch.isupper() else "l" if ch.islower() else "9" if ch.isdigit() else ch
        if out and out[-1][0] == kind:
            out[-1] = kind + "+"
        else:
            out.append(kind)
    return "".join(out)


def hashed_word(word: str) -> int:
    """48 bits of the lower-cased word above 16 bits of its shape."""
    return xxhash.xxh64_intdigest(word.lower()) >> 16 << 16 | xxhash.xxh64_intdigest(shape(word)) >> 48


def word_buckets(docs: DataFrame, text_col: str) -> int:
    """The number of buckets of words for a corpus: a power of two in proportion to the square root of all its bytes."""
    size = docs.agg(F.sum(F.octet_length(text_col).cast("double"))).first()[0] or 0.0
    return max(LEAST_WORD_BUCKETS, 1 << round(float(np.log2(BUCKETS_PER_ROOT * np.sqrt(size) + 1))))


class NGrams:
    """Buckets of all n-grams of a text: ``words`` buckets of words, and after them those of shapes."""

    def __init__(self, words: int):
        self.words, self.shapes = words, words // WORDS_PER_SHAPE
        self.buckets = self.words + self.shapes
        self.hashed = Kept(hashed_word, KEPT_WORDS)

    def __call__(self, text: str | None) -> np.ndarray:
        words = (text or "").split()
        found = np.fromiter(map(self.hashed.__getitem__, words), np.uint64, len(words))
        word, kind = found >> np.uint64(16), found & np.uint64(0xFFFF)
        repeats = np.zeros(len(word), np.uint64)
        repeats[1:] = word[1:] == word[:-1]
        kind = kind * np.uint64(2) + repeats
        pairs = kind * np.uint64(0x9E3779B97F4A7C15)
        pairs[:-1] += kind[1:] * np.uint64(0xC2B2AE3D27D4EB4F)
        in_words = word % np.uint64(self.words)
        in_shapes = np.uint64(self.words) + (pairs >> np.uint64(40)) % np.uint64(self.shapes)
        return np.concatenate([in_words, in_shapes]).astype(np.int64)


def count_ngrams(docs: DataFrame, id_col: str, text_col: str, sample: DataFrame, words: int) -> DataFrame:
    """Counts of every bucket over all documents and over those of the sample labelled 1: (bucket, raw, target).

    Each task sums its documents up before anything is shuffled.
    """
    rows = docs.select(F.col(id_col).alias("labelled_id"), F.col(text_col).alias("text"))
    rows = rows.join(F.broadcast(sample), "labelled_id", "left").select("text", F.coalesce("label", F.lit(0)).alias("good"))

    def run(batches):
        ngrams = NGrams(words)
        counts = np.zeros((2, ngrams.buckets), np.int64)
        for batch in batches:
            for text, good in zip(batch.column(0), batch.column(1), strict=True):
                bucket, n = np.unique(ngrams(text.as_py()), return_counts=True)
                counts[0, bucket] += n
                if good.as_py():
                    counts[1, bucket] += n
        bucket = np.flatnonzero(counts[0])
        yield pa.RecordBatch.from_arrays(
            [pa.array(bucket), pa.array(counts[0, bucket]), pa.array(counts[1, bucket])], ["bucket", "raw", "target"]
        )

    counted = rows.mapInArrow(run, "bucket bigint, raw bigint, target bigint")
    return counted.groupBy("bucket").agg(F.sum("raw").alias("raw"), F.sum("target").alias("target"))


def fit_log_ratios(docs: DataFrame, sample: DataFrame, id_col: str, text_col: str, words: int) -> np.ndarray:
    """Log ratio of target and raw model for every bucket, smoothed by one count; zeros where nothing is labelled good."""
    buckets = NGrams(words).buckets
    with small_batches(docs.sparkSession):
        rows = count_ngrams(docs, id_col, text_col, sample, words).toArrow()  # at most one row a bucket
    raw, target, bucket = np.zeros(buckets), np.zeros(buckets), rows["bucket"].to_numpy()
    raw[bucket], target[bucket] = rows["raw"].to_numpy(), rows["target"].to_numpy()
    if not target.any():
        return np.zeros(buckets)
    return np.log((target + 1) / (target.sum() + buckets)) - np.log((raw + 1) / (raw.sum() + buckets))


def weigh(docs: DataFrame, log_ratios: np.ndarray, id_col: str, text_col: str, seed: int, words: int) -> DataFrame:
    """All columns, and ``n_grams``, ``log_ratio`` (the mean, 0 without n-grams) and ``gumbel``, a noise that the id, the
    text and the seed alone decide."""
    ratios = docs.sparkSession.sparkContext.broadcast(log_ratios)

    def start():
        ngrams = NGrams(words)

        def function(key, text):
            found = ngrams(text)
            mean = float(ratios.value[found].mean()) if len(found) else 0.0
            drawn = (xxhash.xxh64_intdigest(f"{key}\0{text or ''}".encode("utf-8", "surrogatepass"), seed) >> 11) + 0.5
            return len(found), mean, float(-np.log(-np.log(drawn / 2**53)))

        return function

    return add_columns(docs, [id_col, text_col], "n_grams bigint, log_ratio double, gumbel double", start)


def fit_cut(weighed: DataFrame, sample: DataFrame, id_col: str) -> float:
    """The log ratio that best tells labels 1 and 0 apart, halfway between the two; without either label, none is cut."""
    known = weighed.join(F.broadcast(sample), F.col(id_col) == F.col("labelled_id"))
    place = F.floor(F.least(F.greatest(F.col("log_ratio"), F.lit(-40.0)), F.lit(40.0)) * BINS_PER_UNIT)
    rows = known.groupBy(place.alias("bin"), "label").agg(F.count("*").alias("n")).toPandas()  # a bounded number of bins
    good, bad = (rows[rows["label"] == k].groupby("bin")["n"].sum().sort_index() for k in (1, 0))
    if good.empty or bad.empty:
        return -np.inf
    edges = np.arange(min(good.index.min(), bad.index.min()), max(good.index.max(), bad.index.max()) + 2)
    lost = np.array([good[good.index < e].sum() for e in edges]) / good.sum()
    let_in = np.array([bad[bad.index >= e].sum() for e in edges]) / bad.sum()
    best = np.flatnonzero(lost + let_in == (lost + let_in).min())
    return float((edges[best[0]] + edges[best[-1]]) / 2 / BINS_PER_UNIT)


def kth_largest(table: DataFrame, column: str, k: int) -> float:
    """The k-th largest value, found by counting in ever narrower ranges, of which the last one is collected."""
    low, high, n = table.agg(F.min(column), F.max(column), F.count(column)).first()
    while n > COLLECTED_KEYS and (width := (high - low) / 1024) > 0:
        place = F.least(F.floor((F.col(column) - low) / width), F.lit(1023))  # low and high never share a bin
        inside = table.filter(F.col(column).between(low, high)).groupBy(place.alias("bin"))
        for row in sorted(inside.agg(F.min(column), F.max(column), F.count("*")).collect(), reverse=True):
            if k <= row[3]:
                low, high, n = row[1:]
                break
            k -= row[3]
    if low == high or n > COLLECTED_KEYS:
        return high
    values = table.filter(F.col(column).between(low, high)).select(column).collect()
    return sorted((r[0] for r in values), reverse=True)[k - 1]


def resample(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    size: int | None = None,
    temperature: float = TEMPERATURE,
    most_labelled: int = MOST_LABELLED,
    seed: int = 0,
    with_columns: bool = False,
) -> DataFrame:
    """Sample documents without replacement, the likelier the better they fit the target model.

    Rows: the id, ``n_grams``, ``log_ratio``, ``good`` (the log ratio reaches the cut fitted on the labels), ``key`` and
    ``sampled``; with ``with_columns`` only sampled rows, with the columns of ``docs``. A key is the log ratio over the
    temperature plus Gumbel noise; the ``size`` largest keys are sampled, by default as many as there are good rows.
    Rows that tie with the last key are all taken.

    A null or empty text has log ratio 0. Rows that repeat have the same key. Null ids are weighed as others are.
    Without labels of both kinds all rows are good; an empty table gives an empty table. Columns of ``docs`` named as
    one made here are replaced. All counts cover all rows; only the target model and the cut rest on a sample,
    of at most ``most_labelled`` documents of each label.
    """
    sample = pin(labelled_sample(labels, "quality", most_labelled), "labelled")
    words = word_buckets(docs, text_col)
    log_ratios = fit_log_ratios(docs, sample, id_col, text_col, words)
    weighed = weigh(docs.select(id_col, text_col), log_ratios, id_col, text_col, seed, words).drop(text_col)
    with small_batches(docs.sparkSession):
        weighed = pin(weighed, "weights")
    cut = fit_cut(weighed, sample, id_col)
    good, key = F.col("log_ratio") >= F.lit(cut), F.col("log_ratio") / F.lit(temperature) + F.col("gumbel")
    scored = weighed.select(id_col, "n_grams", "log_ratio", good.alias("good"), key.alias("key"))
    wanted = scored.filter("good").count() if size is None else size
    last = kth_largest(scored, "key", min(wanted, scored.count())) if wanted else np.inf
    last = np.inf if last is None else last
    if not with_columns:
        return scored.withColumn("sampled", F.col("key") >= F.lit(last))
    chosen = weigh(docs, log_ratios, id_col, text_col, seed, words).filter(key >= F.lit(last))
    return chosen.select(*docs.columns)
