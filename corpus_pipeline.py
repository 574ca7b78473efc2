"""A training corpus in five stages, each written to the shared folder and read by the next."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from lakestrata.llm import decontamination, jaccard_join, packing, quality_rules, substring_dedup
from lakestrata.llm.common import stored, table, tokenizer_file


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality_rules.filtered(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return jaccard_join.representatives(docs)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return substring_dedup.shortened(docs)


def benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontamination.decontaminated(docs, table(spark, sf_dir, "benchmark"))


def packed_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.packed(docs, tokenizer_file(), with_ids=False)


STAGES = [
    ("quality_rules", quality),
    ("jaccard_join", near_duplicates),
    ("substring_dedup", repeated_passages),
    ("decontamination", benchmark_leaks),
    ("packing", packed_sequences),
]

# Token ids and the curve have no SQL form; the near-duplicate stage is tested against plain Python in tests/llm.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
