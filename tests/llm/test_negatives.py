import random

import pytest
from pyspark.sql import functions as F

from shardstream.llm import negatives
from shardstream.llm.negatives import mine_negatives, packed_keys, unpacked, usable

SCHEMA = "vec_id bigint, label int, embedding array<bigint>"


def by_hand(rows, is_anchor, positives=5, count=10, least=30, most=90):
    one = {}
    for i, label, v in rows:
        if i is not None and label is not None and v is not None and None not in v:
            one[i] = min(one.get(i, (label, v)), (label, v))
    out = []
    for a, (label, v) in one.items():
        if not is_anchor(a):
            continue
        scored = sorted((-sum(x * y for x, y in zip(v, w, strict=True)), i, m) for i, (m, w) in one.items() if i != a and len(w) == len(v))
        for p, i, _ in [s for s in scored if s[2] == label][:positives]:
            inside = [s for s in scored if s[2] != label and least * -p <= 100 * -s[0] <= most * -p]
            out += [(a, i, k + 1, s[1], -p, -s[0]) for k, s in enumerate(inside[:count])]
    return sorted(out)


def mined(frame, anchors=None, **more):
    return sorted(map(tuple, mine_negatives(frame, F.col("vec_id") % 10 == 0 if anchors is None else anchors, **more).collect()))


def vectors(n, dims, low, high, labels, seed):
    rng = random.Random(seed)
    return [(k, rng.choice(labels), [rng.randint(low, high) for _ in range(dims)]) for k in range(n)]


@pytest.mark.parametrize(("low", "high"), [(-1, 1), (-3, 2), (0, 9), (-200, 200)])
def test_equal_to_scoring_all(spark, monkeypatch, low, high):
    """Small numbers give many ties, and positives that score nothing or less."""
    monkeypatch.setattr(negatives, "CHUNK", 16)
    monkeypatch.setattr(negatives, "BLOCK", 8)
    monkeypatch.setattr(negatives, "AT_ONCE", 3)
    rows = vectors(300, 4, low, high, [0, 0, 0, 1, 2, 3], 1)
    got = mined(spark.createDataFrame(rows, SCHEMA).repartition(5))
    assert got == by_hand(rows, lambda i: i % 10 == 0) and len(got) > 100


def test_few_of_everything(spark):
    rows = vectors(60, 3, -4, 4, [0, 1], 2)
    frame = spark.createDataFrame(rows, SCHEMA)
    got = mined(frame, positives=2, negatives=3, least=0, most=50)
    assert got == by_hand(rows, lambda i: i % 10 == 0, 2, 3, 0, 50) and got


def test_keys_sort_by_score_downwards_then_id():
    import numpy as np

    pairs = [(s, i) for s in (-(1 << 40), -1, 0, 1, 1 << 49) for i in (-5, 0, 3, 1 << 62)]
    keys = [k.tobytes() for k in packed_keys(*(np.array(x) for x in zip(*pairs, strict=True)))]
    assert [unpacked(k) for k in keys] == pairs
    assert [unpacked(k) for k in sorted(keys)] == sorted(pairs, key=lambda p: (-p[0], p[1]))


def test_odd_rows(spark):
    rows = [
        (0, 1, [1, 2]), (1, 1, [3, 2]), (2, 2, [1, 1]), (2, 2, [1, 1]), (3, 1, [9, 9]), (3, 2, [2, 1]), (None, 1, [5, 5]),
        (4, None, [1, 1]), (5, 2, None), (6, 2, [1, None]), (7, 2, []), (8, 1, []), (10, 1, []), (9, 2, [1, 2, 3]), (11, 2, [1, 0]),
        (20, 3, [1, 1]), (-10, 2, [4, 4]), (-11, 2, [2, 2]),
    ]
    frame = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "'x' as id", "1 as anchor", "2 as windows", "3 as vector", "4 as dims")
    assert mined(frame) == by_hand(rows, lambda i: i % 10 == 0)
    assert mined(spark.createDataFrame([], SCHEMA)) == []
    assert mined(frame, F.lit(None).cast("boolean")) == []
    assert mined(frame.filter("vec_id = 0")) == []


def test_all_rows_of_one_label_or_equal(spark):
    assert mined(spark.createDataFrame([(k, 1, [1, 1]) for k in range(50)], SCHEMA)) == []
    rows = [(k, k % 2, [7, 1]) for k in range(40)] + [(100 + k, k % 2, [5, 1]) for k in range(40)]
    assert mined(spark.createDataFrame(rows, SCHEMA)) == by_hand(rows, lambda i: i % 10 == 0)


def test_scores_that_are_not_exact_stop_the_job(spark):
    with pytest.raises(Exception, match="too large"):
        mined(spark.createDataFrame([(0, 1, [1 << 30]), (1, 1, [1 << 30])], SCHEMA))


def test_usable(spark):
    nan, inf = float("nan"), float("inf")
    rows = [([1.0],), ([nan],), ([inf],), ([-inf, 1.0],), ([None],), (None,), ([],)]
    frame = spark.createDataFrame(rows, "v array<float>")
    assert [r[0] for r in frame.select(usable("v")).collect()] == [True, False, False, False, False, False, True]


def test_windows_that_are_refused(spark):
    frame = spark.createDataFrame([], SCHEMA)
    for wrong in ({"least": -1}, {"most": 100}, {"least": 50, "most": 40}, {"positives": 0}, {"negatives": 0}):
        with pytest.raises(ValueError):
            mine_negatives(frame, F.lit(True), **wrong)
