"""The registered queries of this folder, each over its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridpulse.llm import (
    conversation_repair,
    decontamination,
    fingerprints,
    language_model,
    licenses,
    mixing,
    near_dedup,
    packing,
    quality,
    secrets,
    substring_dedup,
    suffix_dedup,
    token_alignment,
)


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix(_table(spark, sf_dir, "documents"))
    taken = (F.col("size") * F.col("copies")).alias("taken")
    return mixed.select("doc_id", "source", "size", "source_size", "target", taken, "rate", "copies")


def op2_link_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.scan(_table(spark, sf_dir, "documents"))


def op3_pitman_yor(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_model.scores(_table(spark, sf_dir, "documents"))


def op4_benchmark_leaks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.leaks(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op5_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents have no paths; their source, language and id stand for directories and a file name."""
    path = F.concat_ws("/", F.coalesce("source", F.lit("-")), F.coalesce("lang", F.lit("-")), F.col("doc_id").cast("string"))
    docs = _table(spark, sf_dir, "documents").withColumn("path", path)
    return licenses.licenses(docs, licenses.fitted(docs))


def op6_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    return fingerprints.compared_with_next(docs, fingerprints.lexicon(docs))


def op7_suffix_arrays(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.deduplicated(_table(spark, sf_dir, "documents"))


def op8_repeated_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.deduplicated(_table(spark, sf_dir, "documents"))


def op9_quality_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    return quality.quality_scores(docs, quality.fit(docs, _table(spark, sf_dir, "labels")))


def op10_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_duplicates(_table(spark, sf_dir, "documents"))


def op11_align_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_alignment.alignment(_table(spark, sf_dir, "documents"))


def op12_pack_sequences(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.packed(_table(spark, sf_dir, "documents"))


def op13_repair_conversations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversation_repair.damaged_and_repaired(_table(spark, sf_dir, "conversations"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_mix_sources": op1_mix_sources,
        "op2_link_secrets": op2_link_secrets,
        "op3_pitman_yor": op3_pitman_yor,
        "op4_benchmark_leaks": op4_benchmark_leaks,
        "op5_licenses": op5_licenses,
        "op6_fingerprints": op6_fingerprints,
        "op7_suffix_arrays": op7_suffix_arrays,
        "op8_repeated_windows": op8_repeated_windows,
        "op9_quality_scores": op9_quality_scores,
        "op10_near_duplicates": op10_near_duplicates,
        "op11_align_tokens": op11_align_tokens,
        "op12_pack_sequences": op12_pack_sequences,
        "op13_repair_conversations": op13_repair_conversations,
    }


def oracle_sql() -> dict[str, str]:
    return {}
