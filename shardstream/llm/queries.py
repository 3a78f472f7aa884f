"""The registered queries of the operators, each over its whole table and with the columns its users agreed on."""

from __future__ import annotations

import string

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shardstream.llm.common import read_table
from shardstream.llm.copies import LARGEST, exact_copies
from shardstream.llm.embeddings import near_copies
from shardstream.llm.fingerprints import compare_with_next
from shardstream.llm.jaccard import jaccard_groups
from shardstream.llm.licenses import scan_licenses
from shardstream.llm.merkle import build_manifest, leaf_digest
from shardstream.llm.negatives import mine_negatives, usable
from shardstream.llm.packing import pack_documents
from shardstream.llm.pieces import decode_ids, encode_texts
from shardstream.llm.pii import FORMS, find_spans, written
from shardstream.llm.quality import resample
from shardstream.llm.toxicity import score_toxicity
from shardstream.llm.urls import judge_pages


def joined_labels(matches: Column) -> Column:
    return F.array_join(F.array_sort(F.array_distinct(F.transform(matches, lambda m: m.label))), ",")


def op1_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labels of license wordings in every document; ``score`` is 1 where a template is accepted, 0.5 where only a
    phrase stands, else 0. ``places`` has all matches."""
    base = F.filter("matches", lambda m: m.base)
    starts = F.transform(base, lambda m: m.first_word)
    return scan_licenses(read_table(spark, sf_dir, "documents")).select(
        "doc_id",
        "n_words",
        F.size(base).cast("long").alias("n_base"),
        F.array_min(starts).alias("first_word"),
        F.array_max(starts).alias("last_word"),
        joined_labels(base).alias("base_labels"),
        joined_labels(F.col("matches")).alias("labels"),
        F.when(F.size(base) < F.size("matches"), 1.0).when(F.size(base) > 0, 0.5).otherwise(0.0).alias("score"),
        F.array_join(F.transform("matches", lambda m: F.concat_ws(":", m.label, m.first_word, m.end_word)), ",").alias(
            "places"
        ),
    )


def op9_winnowing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of every document and its edited text as lists of place:hash, and how near they are."""

    def written(grams: str) -> Column:
        return F.array_join(F.transform(grams, lambda g: F.concat_ws(":", g.place, F.lower(F.hex(g.hash)))), ",")

    return compare_with_next(read_table(spark, sf_dir, "documents")).select(
        "doc_id",
        "n_chars",
        "edited_sha256",
        written("grams").alias("fingerprint"),
        written("edited_grams").alias("edited_fingerprint"),
        "near_edited",
        "near_next",
    )


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of every document, learned from the labels that are not held out."""
    scored = score_toxicity(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))
    return scored.select("doc_id", "held_out", "score", "predicted", "n_words", "n_hits")


def op4_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Weight of every document and whether it is sampled, as many as reach the cut that the labels give."""
    return resample(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))


def op3_link_graph_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Verdict on every page by rule, else by the trust and distrust of its host."""
    return judge_pages(read_table(spark, sf_dir, "pages"))


def op5_near_embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links and group of every vector by cosine of 0.95 or more."""
    return near_copies(read_table(spark, sf_dir, "embeddings"))


def op6_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Group of every document by Jaccard similarity of five-word shingles of 0.8 or more."""
    return jaccard_groups(read_table(spark, sf_dir, "documents"))


def op7_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data in every document, by form and by trusted contexts."""

    def number(kind: str) -> Column:
        return F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return find_spans(read_table(spark, sf_dir, "documents")).select(
        "doc_id", *map(number, FORMS), F.sha2(written("base"), 256).alias("base_sha256"), written("spans").alias("spans")
    )


def op8_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Place of every piece of every document in sequences of 4096 tokens."""
    return pack_documents(read_table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


def op10_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digests of the pieces of every document and of the text decoded from them, and whether that is the document's."""
    model = public_tokenizers.path("piece_bpe_32k.model")
    decoded = decode_ids(encode_texts(read_table(spark, sf_dir, "documents"), model), model)
    digest = F.sha2("decoded", 256)
    return decoded.select(
        "doc_id",
        "n_chunks",
        "n_ids",
        "ids_crc32",
        digest.alias("decoded_sha256"),
        (digest == F.col("text_sha256")).alias("round_trip"),
    )


def op11_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Which document of equal text stays, of every document: the one with the largest id."""
    text = F.sha2(F.coalesce("text", F.lit("")), 256)
    return exact_copies(read_table(spark, sf_dir, "documents"), keep=LARGEST, also={"text_sha256": text})


def op12_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Leaf, roots and proof of every document, and the root its proof leads to once some texts have been changed."""
    lowered = F.translate("text", string.ascii_uppercase, string.ascii_lowercase)
    values = ["doc_id", "source", "lang", "n_chars"]
    changed = F.crc32(F.col("doc_id").cast("string")) % 5 == 0
    claimed = F.when(changed, leaf_digest([*values, lowered]))
    docs = read_table(spark, sf_dir, "documents")
    manifest = build_manifest(docs, "source", "doc_id", leaf_digest([*values, "text"]), claimed)
    root = F.lit(manifest.root()).cast("string")
    return manifest.check().select(
        F.col("id").alias("doc_id"),
        "leaf",
        "subroot",
        root.alias("root"),
        "proof_sha256",
        "folded_root",
        (F.col("folded_root") == root).alias("verified"),
    )


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hard negatives of every hundredth embedding, by inner products of whole numbers."""
    rows = read_table(spark, sf_dir, "embeddings").filter(usable("embedding") & F.col("label").isNotNull())
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    whole = F.transform("embedding", lambda x: F.floor(x.cast("double") * 256))
    rows = rows.select("vec_id", moved.alias("label"), whole.alias("embedding"))
    return mine_negatives(rows, F.col("vec_id") % 100 == 0)


QUERIES = {
    "op11_exact_dedup": op11_exact_dedup,
    "op12_merkle_manifest": op12_merkle_manifest,
    "op13_hard_negatives": op13_hard_negatives,
    "op7_personal_data": op7_personal_data,
    "op10_sentencepiece": op10_sentencepiece,
    "op5_near_embeddings": op5_near_embeddings,
    "op6_jaccard_join": op6_jaccard_join,
    "op2_toxicity": op2_toxicity,
    "op4_importance_resampling": op4_importance_resampling,
    "op3_link_graph_filter": op3_link_graph_filter,
    "op8_best_fit_packing": op8_best_fit_packing,
    "op1_license_scan": op1_license_scan,
    "op9_winnowing": op9_winnowing,
}
