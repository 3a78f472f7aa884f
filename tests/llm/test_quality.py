import math
import random
from collections import Counter

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from shardstream.llm.quality import LEAST_WORD_BUCKETS, WORDS_PER_SHAPE, kth_largest, resample, shape, word_buckets
from tests.llm.data import documents, no_documents, odd_documents

LABELS = "doc_id bigint, quality int, toxic int"


def test_good_documents_are_kept_and_junk_goes(spark):
    folder = "/root/testdata/sf0.01"
    docs, labels = (spark.read.parquet(f"{folder}/{t}.parquet") for t in ("documents", "labels"))
    rows = resample(docs, labels).join(labels, "doc_id").select("quality", "good", "sampled").collect()
    assert {(r.quality, r.good, r.sampled) for r in rows} == {(0, False, False), (1, True, True)}
    kept = resample(docs, labels, with_columns=True)
    assert kept.columns == docs.columns
    sampled = resample(docs, labels).filter("sampled")
    assert sorted(r[0] for r in kept.select("doc_id").collect()) == sorted(r[0] for r in sampled.select("doc_id").collect())


def test_size_and_seed(spark, small):
    docs, labels = (spark.read.parquet(f"{small}/{t}.parquet") for t in ("documents", "labels"))
    docs = docs.dropDuplicates(["text"])
    some, again, other = (resample(docs, labels, size=20, temperature=1.0, seed=s).filter("sampled") for s in (0, 0, 1))
    ids = [sorted(r.doc_id for r in x.collect()) for x in (some, again, other)]
    assert len(ids[0]) == 20 and ids[0] == ids[1] != ids[2]


def test_noise_is_gumbel(spark):
    docs = spark.range(4000).selectExpr("id as doc_id", "'a' as text")
    rows = resample(docs, spark.createDataFrame([], LABELS), temperature=1.0).select("key").collect()
    mean = sum(r.key for r in rows) / len(rows)
    assert abs(mean - 0.5772) < 0.08


def plain_ngrams(text):
    """Words, and pairs of neighbours' shapes with whether each repeats the word before it; no hashing."""
    words = (text or "").split()
    kinds = [(shape(w), k > 0 and w.lower() == words[k - 1].lower()) for k, w in enumerate(words)]
    return [w.lower() for w in words] + list(zip(kinds, [*kinds[1:], None], strict=False))


def plain_weights(texts, good, n_buckets):
    """Mean log ratio of each text, from counts in dictionaries."""
    raw, target = Counter(), Counter()
    for key, text in texts.items():
        raw.update(plain_ngrams(text))
        if key in good:
            target.update(plain_ngrams(text))
    all_raw, all_target = sum(raw.values()) + n_buckets, sum(target.values()) + n_buckets
    ratio = {g: math.log((target[g] + 1) / all_target) - math.log((raw[g] + 1) / all_raw) for g in raw}
    return {k: float(np.mean([ratio[g] for g in grams])) if (grams := plain_ngrams(t)) else 0.0 for k, t in texts.items()}


def plain_gumbel(key, text, seed):
    drawn = (xxhash.xxh64_intdigest(f"{key}\0{text or ''}".encode(), seed) >> 11) + 0.5
    return -math.log(-math.log(drawn / 2**53))


@pytest.mark.parametrize(("seed", "temperature", "size"), [(0, 1.0, 25), (7, 0.3, 60), (3, 0.02, 1)])
def test_weights_and_sample_equal_plain_gumbel_top_k(spark, seed, temperature, size):
    rng = random.Random(seed)
    vocabulary = ["the", "The", "river", "and", "stone", "of", "light", "BUY", "now!!", "$9", "click", "a1b2"]
    texts = {}
    for k in range(120):
        mostly = vocabulary[:7] if k % 3 else vocabulary[5:]
        texts[k] = " ".join(rng.choices(mostly, k=rng.randrange(0, 40))) or None
    good = {k for k in texts if k % 3 == 1 and k < 60}
    labels = spark.createDataFrame([(k, int(k in good), 0) for k in range(60) if k % 3 != 2], LABELS)
    docs = documents(spark, list(texts.values()))
    rows = {r.doc_id: r for r in resample(docs, labels, size=size, temperature=temperature, seed=seed).collect()}
    weights = plain_weights(texts, good, LEAST_WORD_BUCKETS + LEAST_WORD_BUCKETS // WORDS_PER_SHAPE)
    keys = {k: weights[k] / temperature + plain_gumbel(k, t, seed) for k, t in texts.items()}
    for k in texts:
        assert rows[k].log_ratio == pytest.approx(weights[k], abs=1e-9)
        assert rows[k].key == pytest.approx(keys[k], abs=1e-6)
    assert {k for k in rows if rows[k].sampled} == set(sorted(keys, key=keys.get)[-size:])


def test_inclusion_is_that_of_a_plain_gumbel_top_k(spark):
    """Of two kinds of text, the likelier one fills as much of the sample as independent Gumbel noise makes it fill."""
    kinds, n, size = ("plain words of a river", "BUY now!! click $9"), 4000, 1000
    docs = documents(spark, [kinds[k % 2] for k in range(n)])
    labels = spark.createDataFrame([(k, 1 - k % 2, 0) for k in range(200)], LABELS)
    rows = resample(docs, labels, size=size, temperature=2.0, seed=5).collect()
    weight = {k: next(r.log_ratio for r in rows if r.doc_id % 2 == k) for k in (0, 1)}
    assert weight[0] > weight[1]
    rng, shares = np.random.default_rng(1), []
    base = np.array([weight[k % 2] / 2.0 for k in range(n)])
    for _ in range(200):
        shares.append(np.mean(np.argsort(base + rng.gumbel(size=n))[-size:] % 2 == 0))
    share = sum(r.sampled and r.doc_id % 2 == 0 for r in rows) / size
    assert 0 < share < 1 and abs(share - np.mean(shares)) < 5 * np.std(shares)


def test_buckets_grow_with_the_corpus(spark):
    sizes = [spark.range(n).select(F.lit("x" * 10**6).alias("text")) for n in (0, 1, 1000, 4000, 16000)]
    found = [word_buckets(s, "text") for s in sizes]
    assert found[:2] == [LEAST_WORD_BUCKETS] * 2 and found[3] == 2 * found[2] and found[4] == 4 * found[2]
    assert word_buckets(spark.createDataFrame([(None,)], "text string"), "text") == LEAST_WORD_BUCKETS


def test_kth_largest(spark, monkeypatch):
    monkeypatch.setattr("shardstream.llm.quality.COLLECTED_KEYS", 20)
    rng = random.Random(3)
    values = [rng.gauss(0, 1) for _ in range(500)] + [0.25] * 100 + [1e9, -1e9]
    table = spark.createDataFrame([(v,) for v in values], "x double")
    for k in (1, 2, 150, 300, 602):
        assert kth_largest(table, "x", k) == sorted(values, reverse=True)[k - 1]


def test_shapes():
    assert [shape(w) for w in ("The", "THE!!", "ab12", "|", "")] == ["Ul+", "U+!+", "l+9+", "|", ""]


def test_odd_rows(spark):
    labels = spark.createDataFrame([(0, 1, 0), (4, 0, 0), (None, 1, 1), (5, None, None)], LABELS)
    docs = odd_documents(spark)
    rows = resample(docs, labels)
    assert rows.count() == 10
    empty = rows.filter("n_grams = 0")
    assert empty.count() == 4 and empty.filter("log_ratio <> 0").count() == 0
    assert resample(docs, labels, with_columns=True).columns == docs.columns
    assert resample(no_documents(spark), labels).count() == 0
    assert resample(no_documents(spark), labels, with_columns=True).count() == 0
    nothing = spark.createDataFrame([], LABELS)
    assert resample(docs, nothing).filter(~F.col("good") | ~F.col("sampled")).count() == 0
