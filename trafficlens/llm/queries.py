"""Registered queries of the pipeline operators and their DuckDB SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from trafficlens.llm.bpe import round_trip
from trafficlens.llm.chat_format import preference_format, preference_sql
from trafficlens.llm.embedding_join import embedding_join
from trafficlens.llm.hard_negatives import hard_negatives, hard_negatives_sql
from trafficlens.llm.html_extract import html_extract
from trafficlens.llm.language_id import language_id
from trafficlens.llm.ngram_join import ngram_join
from trafficlens.llm.packing import near_copy_packing
from trafficlens.llm.quality_classifier import quality_scores
from trafficlens.llm.quality_rules import quality_rules, quality_rules_sql
from trafficlens.llm.source_divergence import source_divergence, source_divergence_sql
from trafficlens.llm.substring_dedup import substring_dedup, substring_dedup_sql
from trafficlens.llm.tables import read_table
from trafficlens.llm.warc import warc_round_trip, warc_sql

Query = Callable[[SparkSession, str], DataFrame]


def op1_embedding_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_join(read_table(spark, sf_dir, "embeddings", "vec_id", "embedding"))


def op2_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules(read_table(spark, sf_dir, "documents", "doc_id", "text"))


def op3_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join(read_table(spark, sf_dir, "documents", "doc_id", "text"))


def op4_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return round_trip(read_table(spark, sf_dir, "documents", "doc_id", "text"), tokenizer_path())


def op5_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc_round_trip(read_table(spark, sf_dir, "pages", "page_id", "url", "html"))


def op6_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_id(read_table(spark, sf_dir, "documents", "doc_id", "text", "lang"))


def op7_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_copy_packing(read_table(spark, sf_dir, "documents", "doc_id", "text", "source"))


def op8_html_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_extract(read_table(spark, sf_dir, "pages", "page_id", "url", "html"))


def op9_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_scores(read_table(spark, sf_dir, "documents", "doc_id", "text"),
                          read_table(spark, sf_dir, "labels", "doc_id", "quality"))


def op10_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    return preference_format(read_table(spark, sf_dir, "conversations", "conv_id", "turn", "role", "text"))


def op11_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return source_divergence(read_table(spark, sf_dir, "documents", "lang", "source", "text"))


def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hard_negatives(read_table(spark, sf_dir, "embeddings", "vec_id", "embedding", "label"))


def op13_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup(read_table(spark, sf_dir, "documents", "doc_id", "text"))


def tokenizer_path() -> str:
    """The tokenizer file the queries use (read on the driver only)."""
    import public_tokenizers
    return public_tokenizers.path("byte_bpe_50k.json")


def queries() -> dict[str, Query]:
    return {
        "op1_embedding_join": op1_embedding_join,
        "op2_quality_rules": op2_quality_rules,
        "op3_ngram_join": op3_ngram_join,
        "op4_bpe": op4_bpe,
        "op5_warc": op5_warc,
        "op6_language_id": op6_language_id,
        "op7_best_fit_packing": op7_best_fit_packing,
        "op8_html_extract": op8_html_extract,
        "op9_quality_classifier": op9_quality_classifier,
        "op10_chat_format": op10_chat_format,
        "op11_source_divergence": op11_source_divergence,
        "op12_hard_negatives": op12_hard_negatives,
        "op13_substring_dedup": op13_substring_dedup,
    }


def oracle_sql() -> dict[str, str]:
    return {
        "op2_quality_rules": quality_rules_sql(),
        "op5_warc": warc_sql(),
        "op10_chat_format": preference_sql(),
        "op11_source_divergence": source_divergence_sql(),
        "op12_hard_negatives": hard_negatives_sql(),
        "op13_substring_dedup": substring_dedup_sql(),
    }
