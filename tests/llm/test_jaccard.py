import random
import re
from itertools import combinations

import numpy as np
import pytest

from shardstream.llm import jaccard
from shardstream.llm.common import BATCH_CONF, TEXTS_AT_ONCE
from shardstream.llm.components import connected_components
from shardstream.llm.jaccard import COUNTERS, Shingles, count_shingles, jaccard_groups
from tests.llm.data import documents, no_documents, odd_documents

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def shingles(text, size=5):
    words = WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    return {tuple(words[k : k + size]) for k in range(max(1, len(words) - size + 1))} if words else set()


def by_hand(docs, percent=80, size=5):
    """(id, n, component) of rows with ids: all pairs are compared."""
    sets = [(i, shingles(t, size)) for i, t in docs if i is not None]
    group = {i: i for i, _ in sets}
    for (i, a), (j, b) in combinations(sets, 2):
        both = len(a & b)
        if i == j or both and 100 * both >= percent * (len(a) + len(b) - both):
            old, new = max(group[i], group[j]), min(group[i], group[j])
            group = {k: new if g == old else g for k, g in group.items()}
    return sorted((i, len(s), group[i]) for i, s in sets)


def got(frame):
    return sorted((r.doc_id, r.n_shingles, r.component_id) for r in frame.collect() if r.doc_id is not None)


def test_all_documents(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    assert got(jaccard_groups(docs)) == by_hand([(r.doc_id, r.text) for r in docs.collect()])


@pytest.mark.parametrize(("percent", "seed"), [(80, 1), (80, 2), (60, 3)])
def test_groups_of_near_copies_that_share_passages(spark, percent, seed):
    rng = random.Random(seed)
    some = [f"w{k}" for k in range(60)]
    passage = rng.choices(some, k=30)
    docs = []
    for g in range(6):
        base = rng.choices(some, k=rng.randint(3, 60))
        for _ in range(rng.choice([1, 2, 9])):
            words = [rng.choice(some) if rng.random() < rng.choice([0, 0.01, 0.04]) else w for w in base]
            docs.append(" ".join(passage + words if g % 2 else words))
    # a chain whose ends do not link, words under the size, and case
    chain = [f"c{k}" for k in range(90)]
    docs += [" ".join(chain[k : k + 60]) for k in range(0, 31, 5)]
    docs += ["a b", "A  B", "a b c", "a", "É e", "é e"]
    rng.shuffle(docs)
    rows = list(enumerate(docs))
    assert got(jaccard_groups(documents(spark, docs), percent=percent)) == by_hand(rows, percent)


def test_odd_rows(spark):
    docs = odd_documents(spark)
    rows = jaccard_groups(docs).collect()
    assert len(rows) == 10
    assert all(r.component_id is None for r in rows if r.doc_id is None)
    pairs = [(r.doc_id, r.text) for r in docs.collect()]
    assert sorted((r.doc_id, r.n_shingles, r.component_id) for r in rows if r.doc_id is not None) == by_hand(pairs)
    assert jaccard_groups(no_documents(spark)).count() == 0


def test_an_id_of_several_texts_joins_their_groups(spark):
    docs = documents(spark, ["one text", "other text", "third", "one text", "other text"], [5, 5, 5, 2, 9])
    assert {(r.doc_id, r.component_id) for r in jaccard_groups(docs).collect()} == {(5, 2), (2, 2), (9, 2)}


@pytest.mark.parametrize("repeats", [False, True])
def test_texts_go_in_small_batches_and_sets_are_compared_only_where_ids_repeat(spark, monkeypatch, repeats):
    words = [f"w{k}" for k in range(80)]
    texts = [" ".join([*words[:k], f"x{k}", *words[k + 1 :]]) for k in range(0, 80, 20)]
    ids, pinned, pin = [3, 1, 4, 1 if repeats else 2], [], jaccard.pin

    def noted(table, purpose):
        plan = table._jdf.queryExecution().optimizedPlan().toString()
        pinned.append((purpose, int(spark.conf.get(BATCH_CONF)), "Aggregate" in plan))
        return pin(table, purpose)

    monkeypatch.setattr(jaccard, "pin", noted)
    before = spark.conf.get(BATCH_CONF)
    docs = documents(spark, texts, ids)
    assert {r.component_id for r in jaccard_groups(docs).collect()} == {1}
    assert spark.conf.get(BATCH_CONF) == before
    assert [most <= TEXTS_AT_ONCE for what, most, _ in pinned if what in ("prefixes", "sets")] == [True] * 3
    assert [compared for what, _, compared in pinned if what == "sets"] == [repeats] * 2


def test_counts_of_shingles(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    by_hand, shingles = np.zeros(COUNTERS, np.int64), Shingles(5)
    for row in docs.select("text").collect():
        np.add.at(by_hand, (shingles(row.text) & np.uint64(COUNTERS - 1)).astype(np.int64), 1)
    assert (count_shingles(docs.repartition(3), 5) == by_hand).all()
    assert not count_shingles(docs.limit(0), 5).any()


def test_components(spark):
    rng = random.Random(4)
    links = [(k, k + 1) for k in range(100, 140)] + [(0, k) for k in range(1, 30)] + [(7, 7), (200, 201), (201, 200)]
    links += [(rng.randint(300, 400), rng.randint(300, 400)) for _ in range(80)]
    group = {x: x for e in links for x in e if e[0] != e[1]}
    for a, b in links:
        if a != b:
            old, new = max(group[a], group[b]), min(group[a], group[b])
            group = {k: new if g == old else g for k, g in group.items()}
    rows = connected_components(spark.createDataFrame(links, "a bigint, b bigint")).collect()
    assert {r.node: r.component for r in rows} == group and len(rows) == len(group)
    assert connected_components(spark.createDataFrame([], "a bigint, b bigint")).count() == 0
