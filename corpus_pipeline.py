"""A corpus pipeline of the operators in ``shardstream.llm``: stages over a folder of tables.

Each stage gets all documents that the one before it kept, and ``labels`` from the folder where it learns. All but the
last return the columns of ``documents``; columns and rows may hold nulls, and rows may repeat, as the operators'
docstrings say. A stage's rows are written and read again before the next one begins, which then removes what the
stages before it pinned for themselves.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

import public_tokenizers
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import shardstream
from shardstream.llm.common import drop_pins, noted_pins, pin, read_table, small_batches
from shardstream.llm.jaccard import jaccard_groups
from shardstream.llm.packing import pack_documents
from shardstream.llm.pii import redact
from shardstream.llm.quality import resample
from shardstream.llm.toxicity import score_toxicity

# Workers get the few functions they run with the job.
cloudpickle.register_pickle_by_value(shardstream)


Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

#: Folders pinned by stages that have been called.
_FORMER: list[str] = []


def in_turn(stage: Stage) -> Stage:
    """A stage that first removes what former stages have pinned, but what its documents are read from."""

    @wraps(stage)
    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        _FORMER[:] = drop_pins(spark, _FORMER, docs)
        with noted_pins() as pinned:
            kept = stage(spark, docs, sf_dir)
        _FORMER.extend(pinned)
        return kept

    return run_stage


@in_turn
def good_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that importance resampling takes: as many as reach the cut fitted on the labels."""
    with small_batches(spark):
        return pin(resample(docs, read_table(spark, sf_dir, "labels"), with_columns=True), "good")


@in_turn
def civil_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that are not predicted toxic; rows with null texts and rows that repeat an id are scored like others."""
    with small_batches(spark):
        scored = score_toxicity(docs, read_table(spark, sf_dir, "labels"))
        return pin(scored.filter("predicted = 0").select(*docs.columns), "civil")


@in_turn
def distinct_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: the one with the smallest id.

    Rows with a null id are in no group and stay. Of rows that repeat an id one stays, that with the smallest text.
    """
    groups = pin(jaccard_groups(docs), "groups")
    dropped = pin(groups.filter("doc_id <> component_id").select("doc_id").distinct(), "dropped")
    kept = docs.join(dropped, "doc_id", "left_anti")
    repeated = groups.filter("doc_id is not null").groupBy("doc_id").agg(F.count("*").alias("n")).filter("n > 1")
    if repeated.isEmpty():
        return kept.select(*docs.columns)
    repeated = pin(repeated.select("doc_id"), "repeated")
    others = [c for c in docs.columns if c != "doc_id"]
    row = F.struct(*(["text"] if "text" in others else []), *(c for c in others if c != "text"))
    single = kept.join(repeated, "doc_id", "left_semi").groupBy("doc_id").agg(F.min(row).alias("row"))
    single = single.select("doc_id", "row.*").select(*docs.columns)
    return kept.join(repeated, "doc_id", "left_anti").select(*docs.columns).unionByName(single)


@in_turn
def private_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents with personal data replaced by its kind; all rows stay, null and repeated ones too."""
    return redact(docs)


@in_turn
def packed_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The place of every piece of every document in sequences of 4096 tokens."""
    return pack_documents(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [
    ("quality", good_documents),
    ("toxicity", civil_documents),
    ("near_copies", distinct_documents),
    ("personal_data", private_documents),
    ("packing", packed_documents),
]

#: The stages learn models, look for groups and pack; SQL cannot express them.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in turn over ``documents``; each stage's rows are written and read again by the next one."""
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = pin(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
