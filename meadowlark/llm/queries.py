"""The corpus queries and, where SQL can express them, their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from meadowlark.llm import chat_format, decontaminate, hard_negatives, html_text, importance, lang_id, media_sniff, mixing, ngram_join, oracles, pii, pipeline, suffix_dedup, token_counts, warc_revisit
from meadowlark.llm.common import table

Query = Callable[[SparkSession, str], DataFrame]


def op1_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.near_duplicates(table(spark, sf_dir, "documents"))


def op2_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.repeated_passages(table(spark, sf_dir, "documents"))


def op3_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.token_counts(table(spark, sf_dir, "documents"))


def op4_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.leaks_digest(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op5_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mixing_digest(table(spark, sf_dir, "documents"))


def op6_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat_format.chat_digest(table(spark, sf_dir, "conversations"))


def op7_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lang_id.language_digest(table(spark, sf_dir, "documents"))


def op8_warc_revisits(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc_revisit.revisit_digest(table(spark, sf_dir, "pages"))


def op9_media_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return media_sniff.media_digest(table(spark, sf_dir, "documents"))


def op10_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.pii_digest(table(spark, sf_dir, "documents"))


def op11_importance(spark: SparkSession, sf_dir: str) -> DataFrame:
    return importance.importance_digest(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hard_negatives.negatives_digest(table(spark, sf_dir, "embeddings"))


def op13_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.pages_digest(table(spark, sf_dir, "pages"))


def queries() -> dict[str, Query]:
    return {
        "op1_ngram_join": op1_ngram_join,
        "op2_suffix_dedup": op2_suffix_dedup,
        "op3_token_counts": op3_token_counts,
        "op4_decontaminate": op4_decontaminate,
        "op5_mix_sources": op5_mix_sources,
        "op6_chat_format": op6_chat_format,
        "op7_language_id": op7_language_id,
        "op8_warc_revisits": op8_warc_revisits,
        "op9_media_columns": op9_media_columns,
        "op10_pii": op10_pii,
        "op11_importance": op11_importance,
        "op12_hard_negatives": op12_hard_negatives,
        "op13_html_text": op13_html_text,
        "pipeline": pipeline.run,
    }


def oracle_sql() -> dict[str, str]:
    return dict(oracles.SQL)
