"""One query per operator, over its whole table, and SQL where it can state the result."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import corpus_pipeline
from lakestrata.llm import decontamination, hard_negatives, jaccard_join, license_scan, lm_scoring, merkle_manifest, packing, quality_rules, substring_dedup, token_counts, token_ids, topk_search, url_filter
from lakestrata.llm.common import lower_ascii, table, tokenizer_file


RULES = [  # fixed values
    ("allow", "org/"),
    ("block", "example.org/es/"),
    ("block", "example.org/en/1"),
    ("allow", "com/fr/"),
    ("block", "com/de/"),
]


def op1_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judge(table(spark, sf_dir, "pages"), RULES).select("page_id", "host", "path", "rule", "verdict")


def op2_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts before and after an edit of every document: its middle tenth is replaced by its first."""
    docs = table(spark, sf_dir, "documents")
    size = F.char_length("text")
    cut = F.floor(size / 10).cast("int")
    edits = docs.where(size > 0).select(
        "doc_id",
        F.lit(0).alias("seq"),
        F.floor(size / 2).cast("int").alias("at"),
        cut.alias("length"),
        F.col("text").substr(F.lit(1), cut).alias("insert"),
    )
    return token_counts.recount(docs, edits, tokenizer_file())


def op3_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.matches(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op4_token_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_ids.round_trip(table(spark, sf_dir, "documents"), tokenizer_file())


def op5_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.scan(table(spark, sf_dir, "documents"))


def op6_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    training = F.crc32(F.col("doc_id").cast("string")) % 10 != 0
    return lm_scoring.score(table(spark, sf_dir, "documents"), training)


def op7_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    linked = jaccard_join.linked_components(table(spark, sf_dir, "documents"))
    return linked.select(F.col("id").alias("doc_id"), "n_shingles", "component_id")


def op8_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = substring_dedup.deduplicated(table(spark, sf_dir, "documents"))
    return cut.select("doc_id", "n_words", "n_removed", "kept_sha256")


def op9_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.packed(table(spark, sf_dir, "documents"), tokenizer_file(), with_ids=False)


def op10_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.judge(table(spark, sf_dir, "documents"), ["doc_id"]).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"
    )


def op11_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    columns = ["doc_id", "source", "lang", "n_chars", "text"]
    tampered = F.crc32(F.col("doc_id").cast("string")) % 5 == 0
    rows = merkle_manifest.manifest(
        table(spark, sf_dir, "documents"), columns, {"text": lower_ascii(F.col("text"))}, tampered
    )
    return rows.select("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified")


def op12_topk_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk_search.top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives.mined(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0, label=label)


QUERIES = {
    "op1_url_filter": op1_url_filter,
    "op2_token_counts": op2_token_counts,
    "op3_decontamination": op3_decontamination,
    "op4_token_ids": op4_token_ids,
    "op5_license_scan": op5_license_scan,
    "op6_lm_scoring": op6_lm_scoring,
    "op7_jaccard_join": op7_jaccard_join,
    "op8_substring_dedup": op8_substring_dedup,
    "op9_packing": op9_packing,
    "op10_quality_rules": op10_quality_rules,
    "op11_merkle_manifest": op11_merkle_manifest,
    "op12_topk_search": op12_topk_search,
    "op13_hard_negatives": op13_hard_negatives,
    "pipeline": corpus_pipeline.run,
}

ORACLES: dict[str, str] = {
    "op5_license_scan": license_scan.oracle(),
    "op11_merkle_manifest": merkle_manifest.oracle(),
    "op12_topk_search": topk_search.ORACLE,
    "op13_hard_negatives": hard_negatives.ORACLE,
}
