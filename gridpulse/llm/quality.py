"""Compression classifier: two zstandard dictionaries, one from good and one from bad text.

A text that resembles the good examples shrinks more with the good dictionary than with the
bad one.  The difference of the two compressed sizes, divided by their sum, is the evidence; a
logistic curve fitted on labelled texts that went into neither dictionary turns it into
a probability.  Whole texts are compressed, one at a time, inside Arrow batches; nothing is shuffled.

The model is fitted on a bounded sample: per label at most `SAMPLE_ROWS` labelled texts, and of these the first that
fit into `SAMPLE_BYTES`, chosen by a hash of the document's id, hence the same at every run and in every order of the rows.  Its size and the dictionaries' do not grow with
the corpus, so both travel to the executors with the function.  In the curve each label weighs as it does
among all labelled texts, so a score means the same whether or not the sample holds them all.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gridpulse.workspace import store

SAMPLE_ROWS = 2000
SAMPLE_BYTES = 16 << 20
DICTIONARY_BYTES = 110 << 10
#: A text gives at most so small a part of its label's and half's bytes to the sample, so these are at least so many texts.
TEXTS = 16
LEVEL = 9
THRESHOLD = 0.3
#: Steps of Newton's method for the two-weight logistic curve; it settles in fewer.
STEPS = 30


@dataclass(frozen=True)
class Model:
    """Dictionaries, and the weights of (1, size difference, log10 of the compressed share)."""

    good: bytes
    bad: bytes
    weights: tuple[float, ...]
    centre: tuple[float, ...]
    spread: tuple[float, ...]


def _evidence(texts: list[bytes], good: bytes, bad: bytes) -> np.ndarray:
    """Per text: normalised size difference (bad - good) and log10 of the smaller compressed share."""
    pair = []
    for content in (good, bad):
        dictionary = zstandard.ZstdCompressionDict(content or b" " * 8)
        dictionary.precompute_compress(level=LEVEL)
        pair.append(zstandard.ZstdCompressor(dict_data=dictionary))
    out = np.zeros((len(texts), 2))
    for i, text in enumerate(texts):
        if text:
            g, b = (len(c.compress(text)) for c in pair)
            out[i] = (b - g) / (b + g), np.log10(min(g, b) / (len(text) + 16))
    return out


def _dictionary(texts: list[bytes]) -> bytes:
    """A trained dictionary; where there is too little text to train one, the text itself."""
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, texts).as_bytes()
    except zstandard.ZstdError:
        return b"\n".join(texts)[:DICTIONARY_BYTES]


def _logistic(x: np.ndarray, y: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Ridge-penalised logistic weights by Newton's method; each row counts as often as `counts` says."""
    x = np.column_stack([np.ones(len(x)), x])
    w = np.zeros(x.shape[1])
    for _ in range(STEPS):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        hessian = (x * (counts * p * (1 - p))[:, None]).T @ x + np.diag([1e-6] + [1e-2] * (x.shape[1] - 1))
        w = w + np.linalg.solve(hessian, x.T @ (counts * (y - p)) - np.r_[0, 1e-2 * w[1:]])
    return w


def learnable(doc_id) -> F.Column:
    """Rows that may be learned from: crc32 of the id as text is no multiple of five."""
    return F.coalesce(F.crc32(F.encode(doc_id.cast("string"), "utf-8")) % 5 != 0, F.lit(False))


def _first_seen(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The first row of each (quality, turn) in the task."""
    seen = set()
    for batch in batches:
        keep = []
        for pair in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            keep.append(pair not in seen)
            seen.add(pair)
        yield batch.filter(pa.array(keep, pa.bool_()))


def _sampled(docs: DataFrame, ids: DataFrame) -> tuple[dict[int, int], list[tuple[int, int, bytes]]]:
    """How many of `ids` (doc_id, quality, turn) have a text, by quality, and (quality, turn, text) of those to learn from, by turn.

    Of different texts of one id that with the smallest hash counts, once.  In the order of turns, the first that fit into a quarter of SAMPLE_BYTES
    are learned from, for each label and half; a text gives no more than its first 1 / TEXTS of that.
    """
    room = SAMPLE_BYTES // 4
    share = room // TEXTS
    texts = docs.select("doc_id", F.encode(F.coalesce("text", F.lit("")), "utf-8").alias("raw"))
    hashed = texts.join(F.broadcast(ids), "doc_id").select("doc_id", "quality", "turn", F.xxhash64("raw").alias("hash"), F.least(F.octet_length("raw"), F.lit(share)).cast("long").alias("size"))
    # of equal hashes the longer size is reckoned with
    one = hashed.groupBy("doc_id", "quality", "turn", "hash").agg(F.max("size").alias("size"))
    least = one.groupBy("doc_id", "quality", "turn").agg(F.min_by(F.struct("hash", "size"), "hash").alias("text"))
    before = Window.partitionBy("quality", F.col("turn") % 2).orderBy("turn").rowsBetween(Window.unboundedPreceding, 0)
    marked = store(least.select("doc_id", "quality", "turn", "text.hash", F.sum("text.size").over(before).alias("upto")), "quality_sample")
    found = dict(marked.groupBy("quality").count().collect())
    kept = marked.where(F.col("upto") <= room).select("doc_id", "quality", "turn", "hash")
    cut = texts.join(F.broadcast(kept), "doc_id").where(F.xxhash64("raw") == F.col("hash")).select("quality", "turn", F.substring("raw", 1, share).alias("raw"))
    # rows that repeat a text are dropped inside each task first
    once = cut.mapInArrow(_first_seen, "quality int, turn int, raw binary").groupBy("quality", "turn").agg(F.min("raw").alias("raw"))
    return found, sorted((r.quality, r.turn, bytes(r.raw)) for r in once.collect())


def fit(docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS) -> Model:
    """Learn from labelled documents; an id labelled more than once counts as bad if any label says so.

    Unlabelled, null-labelled and held-out ids are ignored.  With no labelled text at all, every score is 0.5.
    """
    graded = (
        labels.where(F.col("quality").isin(0, 1) & learnable(F.col("doc_id")))
        .groupBy("doc_id")
        .agg(F.min("quality").cast("int").alias("quality"))
    )
    everyone = dict(graded.groupBy("quality").count().collect())
    turn = Window.partitionBy("quality").orderBy(F.xxhash64("doc_id"), "doc_id")
    chosen = graded.withColumn("turn", F.row_number().over(turn)).where(F.col("turn") <= sample_rows)
    found, texts = _sampled(docs, store(chosen.select("doc_id", "quality", "turn"), "quality_ids"))
    order: dict[tuple[int, int], list[bytes]] = {(q, h): [] for q in (0, 1) for h in (0, 1)}
    for quality, turn_, raw in texts:
        order[quality, turn_ % 2].append(raw)
    good, bad = _dictionary(order[1, 0]), _dictionary(order[0, 0])
    held = order[0, 1] + order[1, 1]
    y = np.r_[np.zeros(len(order[0, 1])), np.ones(len(order[1, 1]))]
    # a label's texts in the table: all its ids, as far as the chosen ones were found
    present = [everyone.get(q, 0) * found.get(q, 0) / max(1, min(everyone.get(q, 0), sample_rows)) for q in (0, 1)]
    counts = np.concatenate([np.full(len(order[q, 1]), present[q] / max(1, len(order[q, 1]))) for q in (0, 1)])
    if not len(y):
        return Model(good, bad, (0.0, 0.0, 0.0), (0.0, 0.0), (1.0, 1.0))
    x = _evidence(held, good, bad)
    centre, spread = x.mean(0), x.std(0) + 1e-9
    return Model(good, bad, tuple(_logistic((x - centre) / spread, y, counts / counts.mean())), tuple(centre), tuple(spread))


def score(docs: DataFrame, model: Model, column: str = "quality_score") -> DataFrame:
    """`docs` with a score from 0 to 1 in `column` (replaced if it exists).

    Null and empty texts have no evidence either way and get the curve's value at zero.
    """
    docs = docs.drop(column)
    schema = T.StructType([*docs.schema.fields, T.StructField(column, T.DoubleType())])

    def batches(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in rows:
            at = batch.schema.get_field_index("text")
            texts = batch.column(at).cast(pa.large_binary()).fill_null(b"").to_pylist()
            x = (_evidence(texts, model.good, model.bad) - model.centre) / model.spread
            z = model.weights[0] + x @ np.array(model.weights[1:])
            p = 1 / (1 + np.exp(-np.clip(z, -30, 30)))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(p)], [*batch.schema.names, column])

    return docs.mapInArrow(batches, schema)


def good_documents(docs: DataFrame, model: Model, threshold: float = THRESHOLD) -> DataFrame:
    """The documents whose score reaches the threshold, columns unchanged."""
    columns = docs.columns
    return score(docs, model, "_quality_score").where(F.col("_quality_score") >= threshold).select(*columns)


def quality_scores(docs: DataFrame, model: Model, threshold: float = THRESHOLD) -> DataFrame:
    """One row per document: doc_id, held_out, score, predicted.  A null id is held out."""
    scored = score(docs.select("doc_id", "text"), model, "score")
    return scored.select(
        "doc_id",
        (~learnable(F.col("doc_id"))).alias("held_out"),
        "score",
        (F.col("score") >= threshold).cast("int").alias("predicted"),
    )
