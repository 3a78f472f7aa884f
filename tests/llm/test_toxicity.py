import math
import random
import zlib

import pytest
from pyspark.sql import functions as F

from shardstream.llm.toxicity import EXCEPTIONS, Matcher, fit_lexicon, folded, learned_exceptions, measure, score_toxicity
from tests.llm.data import documents, no_documents, odd_documents

LABELS = "doc_id bigint, quality int, toxic int"


def test_held_out_accuracy(spark):
    folder = "/root/testdata/sf0.1"
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    scored = score_toxicity(spark.read.parquet(f"{folder}/documents.parquet"), labels)
    rows = scored.join(labels, "doc_id").select("doc_id", "held_out", "predicted", "toxic", "score").collect()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in rows)
    assert all(r.predicted == int(r.score >= 0.7) and 0 <= r.score <= 1 for r in rows)
    held = [r for r in rows if r.held_out]
    caught = [r.predicted for r in held if r.toxic]
    assert sum(caught) / len(caught) >= 0.9
    spared = [not r.predicted for r in held if not r.toxic]
    assert sum(spared) / len(spared) >= 0.99


def test_labels_that_are_held_out_change_nothing(spark, small):
    docs, labels = (spark.read.parquet(f"{small}/{t}.parquet") for t in ("documents", "labels"))
    out = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 1
    turned = labels.withColumn("toxic", F.when(out, 1 - F.col("toxic")).otherwise(F.col("toxic")).cast("int"))
    scores = [score_toxicity(docs, x).orderBy("doc_id").select("doc_id", "score").collect() for x in (labels, turned)]
    assert scores[0] == scores[1]


def test_folding():
    assert folded("m0r0n MORON mоrоn ｍｏｒｏｎ tr@sh") == " moron moron moron moron trash "
    assert folded("1diot id!ot idiot!! 2024 THE!!") == " idiot idiot idiot 2024 the "
    assert folded("loser l0ser 1oser") == " ioser ioser ioser "
    assert folded("").strip() == ""


def test_exceptions_and_word_borders():
    matcher = Matcher({folded("trash"): 2.0, " vequ": 3.0}, ["trash can"])
    hits = lambda text: [h[2] for h in matcher.hits(folded(text))]
    assert hits("trash") == [2.0]
    assert hits("the trash can is trash") == [2.0]
    assert hits("trashy untrash vequ vequxyz avequ") == [3.0, 3.0]
    assert Matcher({}, ()).hits(folded("x")) == []


def plain_hits(text, lexicon, exceptions):
    """Weights of entries, by looking for each at every place of the folded text."""
    words = folded(text or "")
    places = lambda term: [k for k in range(len(words)) if words.startswith(term, k)]
    spared = [(k, k + len(folded(e))) for e in exceptions for k in places(folded(e))]
    hits = [(k, k + len(t), w) for t, w in lexicon.items() for k in places(t)]
    return [w for a, b, w in hits if not any(x <= a and b <= y for x, y in spared)]


def plain_exceptions(texts, lexicon):
    """Neighbours of words that hold an entry outside exceptions, in three clean documents or more and in no toxic one."""
    clean, toxic = {}, set()
    for text, label in texts:
        words = folded(text).split()
        held = [any(f" {w} ".startswith(t) for t in lexicon) for w in words]
        pairs = {f"{a} {b}" for a, b, x, y in zip(words, words[1:], held, held[1:], strict=False) if x or y}
        for pair in pairs:
            clean[pair] = clean.get(pair, 0) + 1
        toxic |= pairs if label else set()
    return {p for p, n in clean.items() if n >= 3} - toxic


def test_scores_equal_a_plain_search_with_the_learned_lexicon(spark):
    rng = random.Random(5)
    calm, rude = ["".join(rng.choices("aeghnoprtu", k=5)) for _ in range(2000)], ["vile", "v1le", "scum", "SCUM"]
    texts = []
    for k in range(240):
        label = k % 2
        words = rng.choices(calm, k=rng.randrange(8, 20)) + (rng.choices(rude, k=3) if label else [])
        rng.shuffle(words)
        if k % 48 == 0:
            words.append("scum bin")
        texts.append((" ".join(words), label))
    known = spark.createDataFrame(texts, "text string, label int")
    lexicon = fit_lexicon(known)
    assert lexicon and all(any(folded(w).strip() in t or t.strip() in folded(w) for w in rude) for t in lexicon)
    exceptions = learned_exceptions(known, lexicon)
    assert set(exceptions) == plain_exceptions(texts, lexicon) and "scum bin" in exceptions
    tried = [t for t, _ in texts] + ["", "trash can", "scum bin scum", None]
    rows = measure(documents(spark, tried), (lexicon, [*EXCEPTIONS, *exceptions]), "text").orderBy("doc_id").collect()
    for text, row in zip(tried, rows, strict=True):
        weights, n = plain_hits(text, lexicon, [*EXCEPTIONS, *exceptions]), len(folded(text or "").split())
        assert (row.n_words, row.n_hits) == (n, len(weights)), text
        assert row.density == pytest.approx(math.log1p(1000 * sum(weights) / max(n, 1)))


def test_odd_rows(spark):
    labels = spark.createDataFrame([(0, 1, 0), (3, 1, 1), (None, 1, 1), (5, None, None)], LABELS)
    docs = odd_documents(spark)
    rows = score_toxicity(docs, labels)
    assert rows.columns[: len(docs.columns) - 2] == [c for c in docs.columns if c not in ("score", "n_words")]
    found = rows.collect()
    assert len(found) == 10 and all(0 <= r.score <= 1 for r in found)
    assert len({r.score for r in found if not r.text}) == 1
    assert not any(r.held_out for r in found if r.doc_id is None)
    assert score_toxicity(no_documents(spark), labels).count() == 0
    no_labels = spark.createDataFrame([], LABELS)
    assert score_toxicity(documents(spark, ["a b", None]), no_labels).filter("predicted = 1").count() == 0
