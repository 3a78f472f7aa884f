import re
from pathlib import Path

import __spark_entry__ as entry_point
import corpus_pipeline
from shardstream.llm import packing, quality
from shardstream.llm.common import BATCH_CONF, TEXTS_AT_ONCE, noted_pins
from tests.llm.data import odd_documents
from tests.llm.test_jaccard import by_hand
from tests.llm.test_pii import by_hand as private_by_hand

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def test_every_operator_has_one_query():
    names = [n for n in entry_point.queries() if re.match(r"op\d+_", n)]
    assert sorted(int(n[2:].split("_")[0]) for n in names) == list(range(1, 14))
    assert "pipeline" in entry_point.queries()


def test_stages(spark):
    folder = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    labels = {r.doc_id: r for r in spark.read.parquet(f"{folder}/labels.parquet").collect()}
    before, kept = docs, {}
    for name, stage in corpus_pipeline.STAGES:
        after = corpus_pipeline.pin(stage(spark, before, folder), "stage")
        if name != "packing":
            assert after.columns == COLUMNS
            rows = {r.doc_id: r for r in after.collect()}
            assert rows.keys() <= kept.get("last", {r.doc_id: r for r in docs.collect()}).keys()
            kept[name] = kept["last"] = rows
            before = after
        else:
            assert {r.doc_id for r in after.select("doc_id").collect()} == kept["last"].keys()
    good = {i for i, r in labels.items() if r.quality == 1}
    assert good <= kept["quality"].keys() and not {i for i, r in labels.items() if r.quality == 0} & kept["quality"].keys()
    clean = {i for i in good if labels[i].toxic == 0}
    assert len(clean & kept["toxicity"].keys()) >= 0.99 * len(clean)
    groups = by_hand([(r.doc_id, r.text) for r in kept["toxicity"].values()])
    assert kept["near_copies"].keys() == {c for _, _, c in groups}
    assert not any(private_by_hand(r.text) for r in kept["personal_data"].values())


def test_pins_go_when_the_next_stage_begins(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet").limit(50)
    with noted_pins() as pinned:
        kept = corpus_pipeline.private_documents(spark, docs, small)
        assert pinned and all(Path(p).exists() for p in pinned)
        # What the documents themselves are read from stays.
        corpus_pipeline.private_documents(spark, kept, small)
        there = [p for p in pinned if Path(p).exists()]
        assert set(kept.inputFiles()) and all(any(p in f for p in there) for f in kept.inputFiles())
        written = corpus_pipeline.pin(kept, "written")
        mine = [p for p in pinned if Path(p).exists() and not any(p in f for f in written.inputFiles())]
        corpus_pipeline.packed_documents(spark, written, small)
        assert not any(Path(p).exists() for p in mine)
        assert written.count() == 50


def test_texts_go_to_python_in_small_batches(spark, small, monkeypatch):
    pinned, before = {}, spark.conf.get(BATCH_CONF)

    def noted(table, purpose, pin=corpus_pipeline.pin):
        plan = table._jdf.queryExecution().optimizedPlan().toString()
        pinned[purpose] = int(spark.conf.get(BATCH_CONF)), "MapInArrow" in plan
        return pin(table, purpose)

    for module in (corpus_pipeline, packing, quality):
        monkeypatch.setattr(module, "pin", noted)
    corpus_pipeline.run(spark, small).count()
    assert spark.conf.get(BATCH_CONF) == before
    assert {"weights", "good", "civil", "pieces"} <= {what for what, (_, python) in pinned.items() if python}
    # What follows the pieces moves no texts.
    assert {what for what, (most, python) in pinned.items() if python and most > TEXTS_AT_ONCE} == {"stage-packing"}


def test_rows_that_repeat_and_nulls(spark, small):
    docs = odd_documents(spark).unionByName(odd_documents(spark))
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = corpus_pipeline.pin(stage(spark, docs, small), "stage")
    assert sorted(r.doc_id for r in docs.collect() if r.doc_id is not None) == [0, 1, 2, 3, 4, 5]
    assert corpus_pipeline.packed_documents(spark, docs, small).count() >= 6


def test_no_documents(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        docs = corpus_pipeline.pin(stage(spark, docs, small), "stage")
    assert docs.count() == 0
