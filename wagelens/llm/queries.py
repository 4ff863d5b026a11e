"""Queries ``opN_<name>`` of the subpackage, each over its whole table with production parameters, and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from wagelens.llm import (
    decontamination, embedding_whitening, jaccard_join, language_id, packing, quality_rules, quote_links, source_divergence, substring_dedup,
    suffix_dedup, template_extraction, url_filters, warc_zstd,
)


def _read(spark: SparkSession, sf_dir: str, table: str, *columns: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet").select(*columns)


def op1_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.report(_read(spark, sf_dir, "documents", "doc_id", "text"),
                                  _read(spark, sf_dir, "benchmark", "item_id", "text"))


def op2_warc_zstd(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc_zstd.round_trip(_read(spark, sf_dir, "pages", "page_id", "url", "html"))


def op3_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_id.identify(_read(spark, sf_dir, "documents", "doc_id", "text", "lang"))


def op4_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.judge(_read(spark, sf_dir, "documents", "doc_id", "text"))


def op5_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.remove_repeats(_read(spark, sf_dir, "documents", "doc_id", "text"))


def op6_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.linked(_read(spark, sf_dir, "documents", "doc_id", "text"))


def op6_jaccard_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.counted(_read(spark, sf_dir, "documents", "doc_id", "text"))


def op7_quote_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quote_links.link(_read(spark, sf_dir, "conversations", "conv_id", "turn", "role", "text"))


def op8_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filters.judge(_read(spark, sf_dir, "pages", "page_id", "url"),
                             _read(spark, sf_dir, "labels", "doc_id", "quality", "toxic"))


def op9_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(_read(spark, sf_dir, "documents", "doc_id", "text"))


def op10_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.report(_read(spark, sf_dir, "documents", "doc_id", "text"))


def op11_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_whitening.whiten(_read(spark, sf_dir, "embeddings", "vec_id", "embedding"))


def op12_template_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return template_extraction.extract(_read(spark, sf_dir, "pages", "page_id", "url", "html"))


def op13_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return source_divergence.audit(_read(spark, sf_dir, "documents", "text", "lang", "source"))


QUERIES = {
    "op1_decontamination": op1_decontamination,
    "op2_warc_zstd": op2_warc_zstd,
    "op3_language_id": op3_language_id,
    "op4_quality_rules": op4_quality_rules,
    "op5_substring_dedup": op5_substring_dedup,
    "op6_jaccard_join": op6_jaccard_join,
    "op6_jaccard_links": op6_jaccard_links,
    "op7_quote_links": op7_quote_links,
    "op8_url_filters": op8_url_filters,
    "op9_packing": op9_packing,
    "op10_suffix_dedup": op10_suffix_dedup,
    "op11_embedding_whitening": op11_embedding_whitening,
    "op12_template_extraction": op12_template_extraction,
    "op13_source_divergence": op13_source_divergence,
}
