import hashlib
import random

import numpy as np

from shardstream.llm import fingerprints
from shardstream.llm.fingerprints import compare_with_next, fingerprint_texts, rolled, winnow
from shardstream.llm.queries import op9_winnowing
from tests.llm.data import documents, no_documents, odd_documents


def by_hand(text, k, window):
    """Places that winnowing chooses, window by window, with the hashes of the operator."""
    if not text:
        return {}
    k = min(k, len(text))
    hashes = [int(rolled(np.frombuffer(text[a : a + k].encode("utf-32-le"), np.uint32), k)[0]) >> 22 for a in range(len(text) - k + 1)]
    window, chosen = min(window, len(hashes)), {}
    for a in range(len(hashes) - window + 1):
        best = min(range(a, a + window), key=lambda p: (hashes[p], -p))
        chosen[best] = hashes[best]
    return chosen


def test_chosen_grams(monkeypatch):
    rng = random.Random(6)
    for block in (1 << 20, 32):
        monkeypatch.setattr(fingerprints, "BLOCK", block)
        for _ in range(60):
            text = "".join(rng.choice("ab é\U0001f600") for _ in range(rng.randint(0, 150)))
            k, window = rng.randint(1, 9), rng.randint(1, 20)
            places, hashes = winnow(text, k, window)
            assert dict(zip(places.tolist(), hashes.tolist(), strict=True)) == by_hand(text, k, window)
            assert len(places) == len(set(places.tolist()))


def test_a_shared_stretch_of_guaranteed_length_is_found():
    rng = random.Random(8)
    for _ in range(50):
        shared = "".join(rng.choices("abcdefgh ", k=8 + 16 - 1))
        one, two = ("".join(rng.choices("ijklmn ", k=rng.randint(0, 80))) for _ in range(2))
        (p, h), (q, g) = winnow(one + shared + two, 8, 16), winnow(two + shared + one, 8, 16)
        meets = {(a - len(one), b - len(two)) for a, x in zip(p, h, strict=True) for b, y in zip(q, g, strict=True) if x == y}
        assert any(a == b and 0 <= a <= len(shared) - 8 for a, b in meets)


def test_short_texts_share_hashes_with_their_edited_form(spark):
    rng = random.Random(9)
    texts = ["".join(rng.choices("abcdefghijklmnopqrstuvwxyz ", k=n)) for n in range(34, 192, 3)]
    assert all(r.near_edited > 0 for r in compare_with_next(documents(spark, texts)).collect())


def check(rows, docs):
    """Against the definition: by falling id, then falling text, nulls last; the first follows the last."""
    order = sorted(docs, key=lambda d: (d[0] is not None, d[0] or 0, d[1] or ""), reverse=True)
    want = []
    for k, (key, text) in enumerate(order):
        text, following = text or "", order[(k + 1) % len(order)][1] or ""
        third = len(text) // 3
        changed = text[: len(text) - third] + following[:third]
        sets = [set(winnow(t)[1].tolist()) for t in (text, changed, following)]
        near = [len(sets[0] & s) / len(sets[0] | s) if sets[0] | s else 1.0 for s in sets[1:]]
        want.append((key, len(text), hashlib.sha256(changed.encode()).hexdigest(), *near))
    got = [(r.doc_id, r.n_chars, r.edited_sha256, r.near_edited, r.near_next) for r in rows]
    assert sorted(got, key=repr) == sorted(want, key=repr)


def test_all_documents(spark, small):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{small}/documents.parquet").collect()]
    rows = op9_winnowing(spark, small).collect()
    check(rows, docs)
    texts = dict(docs)
    by_print = {}
    for r in rows:
        assert by_print.setdefault(texts[r.doc_id], r.fingerprint) == r.fingerprint
    assert len(set(by_print.values())) >= 0.99 * len(by_print)


def test_odd_rows(spark):
    docs = odd_documents(spark)
    check(compare_with_next(docs).collect(), [(r.doc_id, r.text) for r in docs.collect()])
    for few in (["only one text of some length"], [None], ["a", None], ["a" * 500, "b" * 300, ""]):
        check(compare_with_next(documents(spark, few)).collect(), list(enumerate(few)))
    nobody = documents(spark, ["x y z", "y", None], [None, None, None])
    check(compare_with_next(nobody).collect(), [(None, "x y z"), (None, "y"), (None, None)])
    assert compare_with_next(no_documents(spark)).count() == 0
    assert fingerprint_texts(no_documents(spark)).count() == 0
    assert fingerprint_texts(docs).count() == 10
