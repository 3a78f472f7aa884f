import pytest
from pyspark.sql import functions as F

from shardstream.llm import copies
from shardstream.llm.copies import LARGEST, exact_copies
from shardstream.llm.queries import op11_exact_dedup
from tests.llm.data import LONG, collected, documents, no_documents, odd_documents

COLUMNS = ("doc_id", "keep_id", "group_size", "kept")


def by_hand(rows, keep):
    """(id, keep_id, group_size, kept) of each (id, text)."""
    out = []
    for i, text in rows:
        ids = [k for k, t in rows if (t or "") == (text or "")]
        known = [k for k in ids if k is not None]
        best = keep(known) if known else None
        out.append((i, best, len(ids), i == best))
    return sorted(out, key=repr)


def texts(docs):
    return [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]


@pytest.mark.parametrize("keep", [min, max])
def test_equal_to_comparing_all(spark, keep):
    docs = documents(spark, ["a", "b", "a ", "a", "A", "", None, LONG, LONG, "ä", "ä", "b", "a"])
    result = exact_copies(docs, keep="smallest" if keep is min else LARGEST)
    assert collected(result, *COLUMNS) == by_hand(texts(docs), keep)


@pytest.mark.parametrize("fits", [True, False])
def test_bytes_are_compared_where_hashes_collide(spark, monkeypatch, fits):
    """With a hash of a text's length alone, most groups hold several texts."""
    monkeypatch.setattr(copies, "content_hash", lambda text: F.length(text).cast("string").cast("binary"))
    monkeypatch.setattr(copies, "fits_broadcast", lambda table: fits)
    docs = documents(spark, ["aa", "bb", "aa", "cc", "x", "y", "y", "four", "five", "five", "only one of this length"])
    assert collected(exact_copies(docs, keep=LARGEST), *COLUMNS) == by_hand(texts(docs), max)


def test_groups_over_and_under_the_share_that_is_broadcast(spark, monkeypatch):
    monkeypatch.setattr(copies, "HEAVY", 0.1)
    docs = documents(spark, ["hot"] * 40 + [f"t{k % 20}" for k in range(60)])
    assert collected(exact_copies(docs), *COLUMNS) == by_hand(texts(docs), min)


def test_odd_rows(spark):
    docs = odd_documents(spark).withColumn("kept", F.lit(7)).withColumn("keep_id", F.lit("k")).withColumn("_hash", F.lit(1))
    assert collected(exact_copies(docs, keep=LARGEST), *COLUMNS) == by_hand(texts(docs), max)
    result = exact_copies(no_documents(spark), also={"n": F.length("text")})
    assert result.columns == [*COLUMNS, "n"] and result.count() == 0


def test_no_text_is_lost_where_ids_are_missing(spark):
    docs = documents(spark, ["a", "a", "b", "b"], [None, None, None, 3])
    assert collected(exact_copies(docs), *COLUMNS) == sorted(
        [(None, None, 2, True), (None, None, 2, True), (None, 3, 2, False), (3, 3, 2, True)], key=repr
    )


def test_plan_is_native(spark, small):
    plan = op11_exact_dedup(spark, small)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan


def test_unknown_choice(spark):
    with pytest.raises(ValueError):
        exact_copies(no_documents(spark), keep="any")
