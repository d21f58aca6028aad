"""Distinct texts, stored once and laid out so that later steps can join to them without moving them.

Operators that meet the same text several times (find candidates, look closer, cut) first store every distinct text: copies
are dropped inside each task, the rest is dealt by a 128-bit hash and stored in a table bucketed by that hash.
A hot text, even one with a third of all rows, sends one row per map task.  Who has which text stays in a narrow table, so nothing is lost.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridpulse.workspace import new_path

KEYS = ["key1", "key2"]


def text_keys(text: Column) -> list[Column]:
    """128 bits that stand for a text; null counts as empty."""
    text = F.coalesce(text, F.lit(""))
    return [F.xxhash64(text).alias("key1"), F.xxhash64(F.lit("text"), text).alias("key2")]


def _first_seen(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows whose keys the task has not met before."""
    seen = set()
    for batch in batches:
        keep = []
        for pair in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            keep.append(pair not in seen)
            seen.add(pair)
        yield batch.filter(pa.array(keep, pa.bool_()))


def store_bucketed(df: DataFrame, keys: list[str], buckets: int, name: str) -> DataFrame:
    """A stored table bucketed by `keys`; `df` should come out of `repartition(buckets, *keys)`, for one file per bucket."""
    table = f"gridpulse_{name}_{uuid.uuid4().hex}"
    writer = df.write.option("path", new_path(df.sparkSession, name)).option("compression", "zstd")
    writer.bucketBy(buckets, *keys).saveAsTable(table, format="parquet")
    return df.sparkSession.table(table)


def store_distinct(docs: DataFrame) -> DataFrame:
    """A stored table (key1, key2, text, id) of the distinct texts, bucketed by both keys; null is stored as an empty text.

    `id` is a number that no other text has.
    """
    schema = "key1 long, key2 long, text string"
    buckets = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    keyed = docs.select(*text_keys(F.col("text")), F.coalesce("text", F.lit("")).alias("text"))
    dealt = keyed.mapInArrow(_first_seen, schema).repartition(buckets, *KEYS).mapInArrow(_first_seen, schema)
    return store_bucketed(dealt.withColumn("id", F.monotonically_increasing_id()), KEYS, buckets, "texts")


def with_texts(texts: DataFrame, by_id: DataFrame, how: str = "inner") -> DataFrame:
    """The stored texts with what `by_id` says about them; `by_id` (one row per id) is dealt to the texts, which stay in place."""
    keyed = by_id.join(texts.select(F.col("id").alias("text_id"), *KEYS), by_id["id"] == F.col("text_id")).drop("text_id", "id")
    return texts.join(keyed.hint("shuffle_hash"), KEYS, how)


def owners(docs: DataFrame) -> DataFrame:
    """(key1, key2, first_id, copies): how many documents have a text, and the smallest doc_id; null only if all are."""
    return docs.select(*text_keys(F.col("text")), "doc_id").groupBy(*KEYS).agg(F.min("doc_id").alias("first_id"), F.count("*").alias("copies"))
