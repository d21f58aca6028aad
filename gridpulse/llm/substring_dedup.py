"""Substring dedup by one doubling over words.

Level one looks at windows of half the length, and only at sampled ones (see `passages`).  Those that occur in one text alone end
there.  Where they are repeated, level two looks at all windows of twice that length, the full one; these are compared exactly, by 64-bit
hashes, and every word of one that also starts in a document with a smaller id goes.  Candidates that survive no level cost nothing further.
There are these two levels whatever the length; shorter lengths are not looped over, and nothing is lost by it, as equal windows have equal anchors.

Scale: every distinct text is stored once and joined in place (see `texts`).  What is shuffled are sampled windows, one in about `length / 4`
words, and the full windows of repeated stretches.  Counts are summed before the shuffle; joins on a hot window are
plain equi-joins whose large partitions Spark can split.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridpulse.llm.passages import WORDS, Passages, anchor_table, grouped, window_table
from gridpulse.llm.texts import KEYS, owners, store_distinct, text_keys, with_texts
from gridpulse.llm.words import cover
from gridpulse.workspace import store

LENGTH = 50
_NO_ID = (1 << 63) - 1
_NOTHING = hashlib.sha256(b"").hexdigest()


def _cut(texts: DataFrame, length: int) -> DataFrame:
    """(key1, key2, n_words, n_removed, kept_sha256) of texts with the starts of their repeated windows."""

    def batches(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in rows:
            out = []
            for text, starts in zip(batch.column(2).to_pylist(), batch.column(3)):
                kept = text.encode().split()
                n = len(kept)
                if starts.is_valid:
                    gone = cover(np.asarray(starts.values), length, n)
                    kept = [w for w, g in zip(kept, gone) if not g]
                out.append((n, n - len(kept), hashlib.sha256(b" ".join(kept)).hexdigest()))
            columns = [pa.array(c, t) for c, t in zip(zip(*out), (pa.int64(), pa.int64(), pa.string()))] if out else [pa.array([], t) for t in (pa.int64(), pa.int64(), pa.string())]
            yield pa.RecordBatch.from_arrays([*batch.columns[:2], *columns], [*KEYS, "n_words", "n_removed", "kept_sha256"])

    return texts.select(*KEYS, "text", "starts").mapInArrow(batches, "key1 long, key2 long, n_words long, n_removed long, kept_sha256 string")


def repeated_starts(texts: DataFrame, who: DataFrame, kind: Passages) -> DataFrame:
    """(id, start): the windows of each distinct text that also start in a text whose first document has a smaller id."""
    grams = anchor_table(texts, kind)
    shared = grams.groupBy("gram").agg(F.count("*").alias("texts")).where("texts > 1").select("gram")
    candidates = grouped(grams.join(shared, "gram").select("id", "gram"), "gram", "grams")
    windows = store(window_table(with_texts(texts, candidates), kind), "windows")
    first = texts.select("id", *KEYS).join(who, KEYS).select("id", F.coalesce("first_id", F.lit(_NO_ID)).alias("first_id"))
    owned = windows.join(first, "id")
    earliest = owned.groupBy("hash").agg(F.min("first_id").alias("earliest"), F.max("first_id").alias("latest"))
    earliest = earliest.where("earliest < latest").drop("latest")
    return owned.join(earliest, "hash").where("earliest < first_id").select("id", "start")


def deduplicated(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """One row per document: doc_id, n_words, n_removed, kept_sha256.

    Windows are judged on the input.  A text's later copies lose all words if they have a window at all; rows that share the smallest id
    are not later than each other.  A null id is later than any other and never makes another document lose words.  Null texts have no words.
    """
    kind = Passages(*WORDS, length)
    texts = store_distinct(docs)
    who = store(owners(docs), "owners")
    starts = grouped(repeated_starts(texts, who, kind), "start", "starts")
    results = store(_cut(with_texts(texts, starts, "left"), length).join(who, KEYS), "cut")
    later = (F.coalesce("doc_id", F.lit(_NO_ID)) > F.coalesce("first_id", F.lit(_NO_ID))) & (F.col("n_words") >= length)
    rows = docs.select("doc_id", *text_keys(F.col("text"))).join(results, KEYS)
    return rows.select(
        "doc_id",
        "n_words",
        F.when(later, F.col("n_words")).otherwise(F.col("n_removed")).alias("n_removed"),
        F.when(later, F.lit(_NOTHING)).otherwise(F.col("kept_sha256")).alias("kept_sha256"),
    )
