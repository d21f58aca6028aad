"""Dedup of repeated byte strings by fingerprints of sampled suffixes, kept in merged levels.

This stands in for a logarithmic family of suffix arrays.  Texts arrive in `BATCHES` batches, four at every size.  A batch's table holds its sampled
suffixes (the anchors of `passages`: every string of `length` bytes has one) as fingerprints of their first `length / 2` bytes, one row per
fingerprint with the number of suffixes, bucketed; it has neither positions nor suffix order nor match lengths.  The new table is joined with every
level of the index by Spark's sort-merge join, without an exchange, as both sides are bucketed alike.  Fingerprints on both sides, or twice in
the batch, are candidates, the same as one count by fingerprint would give.  Then the table becomes a level; levels of equal size merge, which with four
batches happens once.  The matches themselves are found by what follows.

Strings with one anchor start one after the other: its territory.  Territories that are alike as a whole are settled by one hash, which is
most of a long match.  Where an anchor's surroundings differ, each kind of surroundings is compared once: in pieces first, by what the strings of a
piece share and by what they cover together, then, where only the former is repeated, string by string.
Every byte of a string that starts anywhere else, too, goes.

Scale: suffixes are sampled at one byte in about `length / 4`; hot strings are one index row whatever their number.  Texts are stored
once and joined in place (see `texts`).
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridpulse.llm.passages import BYTES, Passages, anchor_table, grouped, piece_table, run_arrays, run_windows, territory_table
from gridpulse.llm.texts import KEYS, owners, store_bucketed, store_distinct, text_keys, with_texts
from gridpulse.llm.words import cover
from gridpulse.workspace import store

LENGTH = 400
BATCHES = 4


class SuffixIndex:
    """Levels of fingerprints of suffixes: (rank, table of (gram, n)); rank r holds 2**r batches."""

    def __init__(self, buckets: int):
        self.buckets = buckets
        self.levels: list[tuple[int, DataFrame]] = []

    def _array(self, counts: DataFrame) -> DataFrame:
        dealt = counts.repartition(self.buckets, "gram")  # counted per batch of texts before, so a hot gram is few rows
        return store_bucketed(dealt.groupBy("gram").agg(F.sum("n").alias("n")), ["gram"], self.buckets, "suffixes")

    def add(self, anchors: DataFrame) -> DataFrame:
        """Take in a batch of anchors (gram, n); return the grams (`gram`) that it repeats, in itself or in earlier batches.

        Equal levels are merged when the next batch arrives, so the last one costs no merge.
        """
        while len(self.levels) > 1 and self.levels[-1][0] == self.levels[-2][0]:
            rank, a = self.levels.pop()
            _, b = self.levels.pop()
            merged = a.unionByName(b)
            self.levels.append((rank + 1, self._array(merged)))
        array = self._array(anchors)
        found = array.where("n > 1").select("gram")
        for _, level in self.levels:
            found = found.unionByName(array.join(level.hint("merge"), "gram", "left_semi").select("gram"))
        self.levels.append((0, array))
        return found


def _cut(texts: DataFrame, length: int) -> DataFrame:
    """(key1, key2, n_bytes, n_removed, n_spans, kept_sha256) of texts with the runs of their repeated strings."""

    def batches(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in rows:
            out = []
            for text, starts in zip(batch.column(2).cast(pa.large_binary()).to_pylist(), batch.column(3)):
                removed = spans = 0
                kept = text
                if starts.is_valid:
                    first, n = run_arrays(starts)
                    gone = cover(first, n - 1 + length, len(text))
                    removed, spans = int(gone.sum()), int((np.diff(np.r_[False, gone].astype(np.int8)) == 1).sum())
                    kept = np.frombuffer(text, np.uint8)[~gone].tobytes()
                out.append((len(text), removed, spans, hashlib.sha256(kept).hexdigest()))
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.string())
            columns = [pa.array(c, t) for c, t in zip(zip(*out) if out else [[]] * 4, kinds)]
            yield pa.RecordBatch.from_arrays([*batch.columns[:2], *columns], [*KEYS, "n_bytes", "n_removed", "n_spans", "kept_sha256"])

    return texts.select(*KEYS, "text", "runs").mapInArrow(batches, "key1 long, key2 long, n_bytes long, n_removed long, n_spans long, kept_sha256 string")


def repeated_runs(texts: DataFrame, kind: Passages, batches: int = BATCHES) -> DataFrame:
    """(id, start, n): runs of strings of each distinct text that also start elsewhere in the distinct texts."""
    anchors = store(anchor_table(texts, kind).withColumn("batch", F.pmod(F.xxhash64("id"), F.lit(batches)).cast("int")), "anchors")
    index = SuffixIndex(int(texts.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    found = [index.add(anchors.where(F.col("batch") == b).select("gram", "n")) for b in range(batches)]
    matches = found[0]
    for more in found[1:]:
        matches = matches.unionByName(more)
    matches = store(matches.distinct(), "matches")
    candidates = grouped(anchors.join(matches, "gram").select("id", "gram"), "gram", "grams")
    places = store(territory_table(with_texts(texts, candidates), kind), "territories")
    classes = places.groupBy("gram", "hash").agg(F.count("*").alias("alike"), F.min(F.struct("id", "start", "n", "at")).alias("one"))
    classes = store(classes, "territory_classes")
    settled = places.join(classes.where("alike > 1").select("hash", "gram"), ["hash", "gram"]).select("id", "start", "n")
    unsettled = classes.where("alike = 1").select("gram").distinct()
    compared = classes.join(unsettled, "gram").select("one.*").withColumn("run", F.struct("start", "n", "at"))
    pieces = store(piece_table(with_texts(texts, grouped(compared, "run", "runs")), kind), "pieces")
    kinds = pieces.groupBy("hash", "whole").agg(F.count("*").alias("alike"), F.min(F.struct("id", "start", "n")).alias("one"))
    kinds = store(kinds, "piece_kinds")
    pieces = pieces.join(kinds.where("alike > 1").select("hash", "whole"), ["hash", "whole"]).select("id", "start", "n")
    differing = kinds.groupBy("hash").agg(F.count("*").alias("kinds"), F.min("alike").alias("least")).where("kinds > 1 and least = 1")
    close = kinds.join(differing.select("hash"), "hash").select("one.*").withColumn("run", F.struct("start", "n"))
    windows = store(run_windows(with_texts(texts, grouped(close, "run", "runs")), kind), "strings")
    twice = windows.groupBy("hash").agg(F.count("*").alias("m")).where("m > 1").select("hash")
    return settled.unionByName(pieces).unionByName(windows.join(twice, "hash").select("id", "start", F.lit(1).alias("n")))


def deduplicated(docs: DataFrame, length: int = LENGTH, batches: int = BATCHES) -> DataFrame:
    """One row per document: doc_id, n_bytes, n_removed, n_spans, kept_sha256.

    Strings are judged on the input.  Texts of `length` bytes or more that several rows share lose every byte, whatever the ids;
    null texts are empty.
    """
    kind = Passages(*BYTES, length)
    texts = store_distinct(docs)
    runs = grouped(repeated_runs(texts, kind, batches).withColumn("run", F.struct("start", "n")), "run", "runs")
    results = store(_cut(with_texts(texts, runs, "left"), length).join(owners(docs), KEYS), "cut")
    gone = (F.col("copies") > 1) & (F.col("n_bytes") >= length)
    results = results.select(
        *KEYS,
        "n_bytes",
        F.when(gone, F.col("n_bytes")).otherwise(F.col("n_removed")).alias("n_removed"),
        F.when(gone, F.lit(1).cast("long")).otherwise(F.col("n_spans")).alias("n_spans"),
        F.when(gone, F.lit(hashlib.sha256(b"").hexdigest())).otherwise(F.col("kept_sha256")).alias("kept_sha256"),
    )
    return docs.select("doc_id", *text_keys(F.col("text"))).join(results, KEYS).drop(*KEYS)
