"""Toxicity: a weighted lexicon, learned from labels, matched by Aho-Corasick in folded text.

Folding undoes look-alike letters and digits written for letters. A lexicon entry is a whole word or the beginning of
words; its weight is its log odds among toxic documents. Words inside an exception phrase do not count. The
sum of weights over the number of words is turned into a probability by a logistic curve.
"""

from __future__ import annotations

import re

import ahocorasick
import numpy as np
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shardstream.llm.common import Kept, add_columns, labelled_sample, map_rows, pin

#: Labelled documents of each label that the lexicon and the curve are fitted on.
MOST_LABELLED = 20_000
KEPT_CHUNKS = 120_000
PREFIXES = range(3, 9)
#: What a beginning of words needs: so many words of toxic documents, and this share of them in toxic documents.
LEAST_WORDS, LEAST_SHARE = 4, 0.6
LEAST_WEIGHT, PULL = 2.0, 4
THRESHOLD = 0.7
#: Phrases in which an entry is harmless. More are learned: neighbours of an entry seen in clean documents only.
EXCEPTIONS = ("trash can", "trash bin", "class clown", "pond scum")

# Letters of other scripts that look like Latin ones, and digits and signs written for letters.
LOOKALIKES = {
    "а": "a", "в": "b", "е": "e", "к": "k", "м": "m", "н": "h", "о": "o", "р": "p", "с": "c", "т": "t", "у": "y", "х": "x",
    "і": "i", "ј": "j", "ѕ": "s", "ԁ": "d", "һ": "h", "ԛ": "q", "ԝ": "w", "α": "a", "ε": "e", "ι": "i", "κ": "k", "ν": "v",
    "ο": "o", "ρ": "p", "τ": "t", "υ": "u", "χ": "x", "ı": "i", "ɑ": "a", "ɡ": "g", "ⅼ": "l", "ⅰ": "i", "ⅽ": "c", "ⅾ": "d",
    "ⅿ": "m",
}
FOR_LETTERS = {"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "8": "b", "@": "a", "$": "s", "!": "i", "|": "i"}

FULL_WIDTH = {code: code - 0xFEE0 for code in range(0xFF01, 0xFF5F)}
FOLDED = str.maketrans(LOOKALIKES) | FULL_WIDTH
# 1 stands for i and l alike, so both are written i, in lexicon and text.
SAME = str.maketrans({"l": "i"})
UNSIGNED = str.maketrans(FOR_LETTERS)
IN_WORDS = re.compile(r"(?<=[^\W\d_])[0134578@$!|]+(?=[^\W\d_])|\b[013457]+(?=[^\W\d_]{2})")
BETWEEN = re.compile(r"[\W_]+")


def folded_chunk(chunk: str) -> str:
    """What stands between white space in folded form: words with single spaces between them."""
    chunk = chunk.lower()
    word = chunk.strip(".,;:!?")
    if word.isalpha() and max(word) < "\u0100":  # letters of Latin-1, of which none looks like another
        return word.translate(SAME)
    chunk = chunk.translate(FOLDED).lower()
    chunk = IN_WORDS.sub(lambda m: m[0].translate(UNSIGNED), chunk)
    return BETWEEN.sub(" ", chunk).strip(" ").translate(SAME)


def folded(text: str, chunks: Kept | None = None) -> str:
    """Words in folded form, each between single spaces, one space first and last; ``chunks`` keeps what was folded."""
    fold = folded_chunk if chunks is None else chunks.__getitem__
    words = " ".join(filter(None, map(fold, text.split())))
    return f" {words} " if words else " "


def in_training(id_col: Column) -> Column:
    """Rows whose labels may be learned from: the CRC-32 of the id as text does not leave 1 when divided by 3."""
    return F.crc32(id_col.cast("string").cast("binary")) % 3 != 1


def word_counts(known: DataFrame) -> DataFrame:
    """(word, toxic, clean): in how many kinds of document a word stands. Near copies count as one kind: those that share
    the smallest hash of their words."""

    def start():
        chunks = Kept(folded_chunk, KEPT_CHUNKS)

        def words(text, label):
            found = set(folded(text or "", chunks).split())
            kind = min(map(xxhash.xxh64_intdigest, found), default=0) >> 1
            return kind, label, sorted(found)

        return words

    kinds = map_rows(known, ["text", "label"], "kind bigint, label int, words array<string>", start)
    words = kinds.select("kind", "label", F.explode("words").alias("word")).distinct()
    return words.groupBy("word").agg(
        F.sum("label").cast("long").alias("toxic"), F.sum(1 - F.col("label")).cast("long").alias("clean")
    )


def fit_lexicon(known: DataFrame) -> dict[str, float]:
    """Entries and weights. An entry begins with a space, one that is a whole word ends with one.

    An entry's share of toxic documents must be too high for chance among as many words as there are. The beginning of
    words is an entry if several words of toxic documents begin so. Of two entries of which one begins the other the
    less likely one by chance stays. The weight is the log odds of the share, drawn towards the share of all words
    where support is small. What the driver gets is as bounded as the sample: an entry needs several toxic kinds of document.
    """
    counts = pin(word_counts(known), "words")
    total = counts.agg(F.count("*"), F.sum("toxic"), F.sum("clean")).first()
    if not total[1] or not total[2]:
        return {}
    base, chance = total[1] / (total[1] + total[2]), float(np.log(total[0]))
    word = F.col("word")
    terms = F.array(
        F.concat(F.lit(" "), word, F.lit(" ")),
        *(F.when(F.length(word) >= k, F.concat(F.lit(" "), word.substr(1, k))) for k in PREFIXES),
    )
    summed = counts.select(F.explode(terms).alias("term"), "toxic", "clean").filter("term is not null").groupBy("term")
    summed = summed.agg(
        F.sum("toxic").alias("toxic"),
        F.sum("clean").alias("clean"),
        F.count_if(F.col("toxic") > F.col("clean")).alias("words"),
    )
    n = F.col("toxic") + F.col("clean")
    share = F.col("toxic") / n
    surprise = F.col("toxic") * F.log(share / base) + F.when(
        F.col("clean") > 0, F.col("clean") * F.log((1 - share) / (1 - base))
    ).otherwise(0.0)
    drawn = (F.col("toxic") + PULL * base) / (n + PULL)
    whole = (surprise >= chance - 3) & (share > base)
    begins = (F.col("words") >= LEAST_WORDS) & (share >= LEAST_SHARE) & (surprise >= chance + 2)
    chosen = summed.filter(F.col("toxic") > 0).filter(F.when(F.col("term").endswith(" "), whole).otherwise(begins))
    chosen = chosen.withColumn("weight", F.log(drawn / (1 - drawn)) - float(np.log(base / (1 - base))))
    chosen = chosen.withColumn("surprise", surprise).filter(F.col("weight") >= LEAST_WEIGHT)
    best = chosen.orderBy(F.desc("surprise"), F.desc(F.length("term")), "term").select("term", "weight").collect()
    lexicon: dict[str, float] = {}
    begun: set[str] = set()
    for term, weight in ((r.term, r.weight) for r in best):
        parts = {term[:k] for k in range(2, len(term) + 1)}
        if term not in begun and not parts & lexicon.keys():
            lexicon[term] = weight
            begun |= parts
    return lexicon


def learned_exceptions(known: DataFrame, lexicon: dict[str, float]) -> list[str]:
    """All pairs of neighbours that hold an entry and stand in at least three clean documents and in no toxic one."""
    if not lexicon:
        return []

    def start():
        matcher, chunks = Matcher(lexicon, ()), Kept(folded_chunk, KEPT_CHUNKS)

        def pairs(text, label):
            found = set()
            words = folded(text or "", chunks)
            for begin, _, _ in matcher.hits(words):  # begin is the space before the word
                end = words.find(" ", begin + 1)
                left, right = words.rfind(" ", 0, begin), words.find(" ", end + 1)
                if left >= 0:
                    found.add(words[left + 1 : end])
                if right > 0:
                    found.add(words[begin + 1 : right])
            return [(p, label) for p in found]

        return pairs

    pairs = map_rows(known, ["text", "label"], "pair string, label int", start, many=True)
    counted = pairs.groupBy("pair").agg(F.sum("label").alias("toxic"), F.count("*").alias("n"))
    rows = counted.filter("toxic = 0 and n >= 3").select("pair").collect()
    return [r.pair for r in rows]


class Matcher:
    """The lexicon and the exception phrases in one automaton."""

    def __init__(self, lexicon: dict[str, float], exceptions: tuple[str, ...] | list[str]):
        self.automaton = ahocorasick.Automaton()
        for phrase in exceptions:
            term = folded(phrase)
            self.automaton.add_word(term, (len(term), None))
        for term, weight in lexicon.items():
            self.automaton.add_word(term, (len(term), weight))
        self.empty = not len(self.automaton)
        if not self.empty:
            self.automaton.make_automaton()

    def hits(self, words: str) -> list[tuple[int, int, float]]:
        """(first, last place, weight) of the entries in folded text that no exception phrase holds."""
        if self.empty:
            return []
        found, spared = [], []
        for last, (length, weight) in self.automaton.iter(words):
            if weight is None:
                spared.append((last - length + 1, last))
            else:
                found.append((last - length + 1, last, weight))
        return [h for h in found if not any(a <= h[0] and h[1] <= b for a, b in spared)] if spared else found


def measure(docs: DataFrame, matcher_parts: tuple, text_col: str) -> DataFrame:
    """All columns, and ``n_words``, ``n_hits`` and ``density``, the logarithm of 1 and the summed weights per 1000 words."""
    parts = docs.sparkSession.sparkContext.broadcast(matcher_parts)

    def start():
        matcher, chunks = Matcher(*parts.value), Kept(folded_chunk, KEPT_CHUNKS)

        def function(text):
            words = folded(text or "", chunks)
            n_words, hits = words.count(" ") - 1, matcher.hits(words)
            total = sum(h[2] for h in hits)
            return max(n_words, 0), len(hits), float(np.log1p(1000 * total / max(n_words, 1)))

        return function

    return add_columns(docs, [text_col], "n_words bigint, n_hits bigint, density double", start)


def fit_curve(measured: DataFrame) -> tuple[float, float]:
    """Slope and intercept of a logistic curve from density to label, by Newton steps over a table of rounded densities.

    A small penalty on the slope keeps it finite where the labels are told apart without fault.
    """
    place = F.round(F.col("density"), 2)
    rows = measured.groupBy(place.alias("x"), "label").agg(F.count("*").alias("n")).toPandas()  # bounded by the rounding
    x, y, n = (rows[c].to_numpy(float) for c in ("x", "label", "n"))
    design, beta = np.stack([x, np.ones_like(x)], 1), np.zeros(2)
    if len(set(y)) < 2:
        return 0.0, -3.0
    penalty = np.diag([0.02, 1e-6])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(design @ beta, -30, 30)))
        gradient = design.T @ (n * (y - p)) - penalty @ beta
        hessian = (design * (n * np.maximum(p * (1 - p), 1e-9))[:, None]).T @ design + penalty
        step = np.linalg.solve(hessian, gradient)
        beta = beta + step * min(1.0, 2 / max(np.abs(step).max(), 1e-12))
        if np.abs(step).max() < 1e-8:
            break
    return float(beta[0]), float(beta[1])


def score_toxicity(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    exceptions: tuple[str, ...] = EXCEPTIONS,
    threshold: float = THRESHOLD,
    most_labelled: int = MOST_LABELLED,
) -> DataFrame:
    """Score every whole text: the columns of ``docs``, ``held_out``, ``score`` (0 to 1), ``predicted``, ``n_words`` and ``n_hits``.

    Learned from the labelled rows of ``docs`` that are not held out, at most ``most_labelled`` of each label; scores depend
    on the text alone. A null or empty text has no words and gets the score of a text without hits. Null ids are not
    held out and are never learned from. Rows that repeat get the same score. Without labels of both kinds the
    lexicon is empty and nothing is predicted toxic. An empty table gives an empty table. Columns of ``docs`` named as
    one made here are replaced. Only words of the sample are shuffled, no texts.
    """
    sample = labelled_sample(labels.filter(in_training(F.col("doc_id"))), "toxic", most_labelled)
    sample = pin(sample, "labelled")
    texts = docs.select(F.col(id_col).alias("labelled_id"), F.col(text_col).alias("text"))
    known = pin(texts.join(F.broadcast(sample), "labelled_id").select("text", "label"), "training")
    lexicon = fit_lexicon(known)
    parts = lexicon, [*exceptions, *learned_exceptions(known, lexicon)]
    slope, intercept = fit_curve(measure(known, parts, "text"))
    measured = measure(docs, parts, text_col)
    score = 1 / (1 + F.exp(-(F.lit(slope) * F.col("density") + F.lit(intercept))))
    made = ("held_out", "score", "predicted", "n_words", "n_hits")
    return measured.select(
        *(c for c in docs.columns if c not in made),
        F.coalesce(~in_training(F.col(id_col)), F.lit(False)).alias("held_out"),
        score.alias("score"),
        (score >= threshold).cast("int").alias("predicted"),
        "n_words",
        "n_hits",
    )
