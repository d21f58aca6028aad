"""From raw documents to a training mix: five stages, each over all that the one before it kept.

1. quality: documents that the compression classifier rejects go;
2. near_dedup: of each group of near-duplicates (five-word shingles, similarity 0.8) the document with the smallest id stays;
3. decontamination: documents that leak benchmark items go;
4. secrets: secrets and linked parts of credentials are masked, no document goes;
5. mixing: sources are mixed to their target weights, each document as often as it is taken (`copy` numbers the repeats).

A stage is a function of (spark, docs, sf_dir); its result is stored in the shared folder and read again by the next.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from gridpulse.llm import decontamination, mixing, near_dedup, quality, secrets
from gridpulse.workspace import store

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

DOCUMENTS, LABELS, BENCHMARK = "documents", "labels", "benchmark"


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality.good_documents(docs, quality.fit(docs, _table(spark, sf_dir, LABELS)))


def one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return near_dedup.without_near_duplicates(docs)


def without_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontamination.clean_documents(docs, _table(spark, sf_dir, BENCHMARK))


def without_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return secrets.redact(docs)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mixed_documents(docs)


STAGES: list[tuple[str, Stage]] = [
    ("quality", good_quality),
    ("near_dedup", one_of_each),
    ("decontamination", without_leaks),
    ("secrets", without_secrets),
    ("mixing", mixed),
]

#: A trained classifier and seeded rounding are not expressible in SQL; tests compare with plain Python instead.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages applied to the table of documents."""
    docs = _table(spark, sf_dir, DOCUMENTS)
    for name, stage in STAGES[:-1]:
        docs = store(stage(spark, docs, sf_dir), f"pipeline_{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
