"""Tables with the cases every operator must take: nulls, empty and long texts, repeated rows, clashing columns."""

from __future__ import annotations

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"
LONG = "word another third " * 3000


def documents(spark, texts, ids=None):
    ids = list(range(len(texts))) if ids is None else ids
    rows = [(i, t, "en", "s", None if t is None else len(t)) for i, t in zip(ids, texts, strict=True)]
    return spark.createDataFrame(rows, SCHEMA)


def odd_documents(spark):
    """Nulls in each column, empty and long texts, a row that repeats, an id that repeats, and columns named as results are."""
    rows = [
        (0, "plain words here", "en", "s", 16),
        (0, "plain words here", "en", "s", 16),
        (1, None, None, None, None),
        (2, "", "en", "s", 0),
        (None, "no id here", "en", "s", 10),
        (None, None, "en", "s", None),
        (3, LONG, "en", "s", len(LONG)),
        (3, "another text of the same id", "en", "s", 27),
        (4, " \n\t ", "en", "s", 4),
        (5, "ünï¢ødé 日本語 \U0001f600", "de", "s", 15),
    ]
    frame = spark.createDataFrame(rows, SCHEMA)
    for clash in ("id", "score", "n_words", "spans", "key", "length", "piece", "slice", "label", "gumbel", "redacted"):
        frame = frame.selectExpr("*", f"'x' as {clash}")
    return frame


def no_documents(spark):
    return spark.createDataFrame([], SCHEMA)


def collected(frame, *columns):
    return sorted((tuple(r[c] for c in columns) for r in frame.collect()), key=repr)
