"""The operators of this folder as queries over the given tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from carryall.llm import (
    alignment,
    attention_lm,
    conversation_repair,
    decontaminate,
    embeddings,
    hilbert,
    language,
    packing,
    quality,
    residual_packing,
    simhash,
    substring,
    token_store,
)

Query = Callable[[SparkSession, str], DataFrame]


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(_table(spark, sf_dir, "documents"))


def op2_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring.repeats_with_paths(_table(spark, sf_dir, "documents"))


def op3_hilbert_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hilbert.shards(_table(spark, sf_dir, "documents"))


def op4_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_store.stored_tokens(_table(spark, sf_dir, "documents"))


def op5_projection_forest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embeddings.near_vectors(_table(spark, sf_dir, "embeddings"))


def op6_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality_scores(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op7_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contamination(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op8_attention_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return attention_lm.language_model_scores(_table(spark, sf_dir, "documents"))


def op9_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.languages(_table(spark, sf_dir, "documents"))


def op10_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(_table(spark, sf_dir, "documents"))


def op11_residual_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return residual_packing.pack(_table(spark, sf_dir, "documents"))


def op12_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment.link_counts(_table(spark, sf_dir, "documents"))


def op13_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversation_repair.repaired_after_damage(_table(spark, sf_dir, "conversations"))


QUERIES: dict[str, Query] = {
    f.__name__: f
    for f in (
        op1_simhash,
        op2_substring_dedup,
        op3_hilbert_shards,
        op4_token_files,
        op5_projection_forest,
        op6_quality,
        op7_decontamination,
        op8_attention_scores,
        op9_language,
        op10_packing,
        op11_residual_packing,
        op12_token_alignment,
        op13_conversation_repair,
    )
}

ORACLE_SQL: dict[str, str] = {}
