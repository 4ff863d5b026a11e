"""Corpus pipeline: five of the operators in a row, each on all that the one before it kept.

Every stage's result is written as Parquet in the shared folder and read again as the next one's documents, so a lost
executor costs a stage's own tasks at most.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from wagelens.llm import decontamination, jaccard_join, packing, quality_rules, suffix_dedup
from wagelens.llm.shared import written


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the base rule or the threshold table rejects go."""
    return quality_rules.keep_good(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates stays."""
    return jaccard_join.keep_one(docs)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Later copies of passages of 50 words and more are cut out of the texts."""
    return suffix_dedup.drop_repeats(docs)


def benchmark_hits(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark phrase go."""
    return decontamination.drop_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents in sequences of at most 2048 ids."""
    return packing.pack(docs)


STAGES = [
    ("quality_rules", quality),
    ("ngram_jaccard_join", near_duplicates),
    ("suffix_array_dedup", repeated_passages),
    ("benchmark_decontamination", benchmark_hits),
    ("packing", packed),
]

#: The stages are iterative or hash text by tokenizer ids; SQL can't express them (tests compare with brute force).
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages applied to the documents of ``sf_dir``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
