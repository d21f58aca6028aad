"""Document fingerprints by I-Match.

Very frequent terms say little and very rare ones are often noise, so only terms within a band
of inverse document frequency count: the lexicon.  A document's distinct lexicon terms are sorted and hashed;
equal hashes mean equal selections.  Because one changed term changes the hash, the selection is hashed again for
`SUBSETS` random subsets of the lexicon: a changed term spoils only the subsets that hold it.  The
subsets come in `len(SHARES)` sizes, so that short and long texts both have subsets that catch one or a few of their terms.

The likeness of two fingerprints is the share of equal hashes among the subsets in which at least one
of the two has a term.  For small subsets this estimates the Jaccard similarity of the selections.

Scale: document frequencies are counted over all documents with map-side sums.  A term in the lexicon is in at least
`MIN_SHARE` of the documents, so the lexicon has at most (mean distinct terms of a document) / MIN_SHARE terms, however
large the corpus: that bound lets it travel to every task.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridpulse.llm.words import LOWER, mix, slices, word_hashes, words
from gridpulse.workspace import store

#: The band of document frequency, as shares of all documents; log(1 / share) is the inverse document frequency.
MIN_SHARE, MAX_SHARE = 1e-3, 0.2
#: Each share of the lexicon is drawn as often as this.
SHARES = (1 / 4, 1 / 16, 1 / 64, 1 / 256)
DRAWS = 8
SUBSETS = DRAWS * len(SHARES)
#: Marks fingerprints of texts without lexicon terms, whose hash is that of all their terms.
_OTHER = np.uint64(0x5851F42D4C957F2D)


def _terms(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(text, term hash) of the distinct words of each text, sorted; A-Z lower-cased."""
    lowered = LOWER[data]
    begin, end, bounds = words(lowered, offsets)
    hashes = word_hashes(lowered, begin, end)
    text = np.repeat(np.arange(len(offsets) - 1), np.diff(bounds))
    order = np.lexsort((hashes, text))
    text, hashes = text[order], hashes[order]
    new = np.ones(len(text), bool)
    new[1:] = (np.diff(text) != 0) | (hashes[1:] != hashes[:-1])
    return text[new], hashes[new]


class Lexicon:
    """The terms that count, and which random subsets hold each of them."""

    def __init__(self, terms: np.ndarray):
        self.terms = np.sort(terms.astype(np.uint64))
        member = np.empty((len(self.terms), SUBSETS), bool)
        for k in range(SUBSETS):
            draw = mix(self.terms ^ mix(np.uint64([k + 1]))) >> np.uint64(11)
            member[:, k] = draw < np.uint64(SHARES[k // DRAWS] * (1 << 53))
        self.member = member

    def prints(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Hashes of every text of a slice: column 0 of the whole selection, then one per subset (0: no term)."""
        n = len(offsets) - 1
        text, term = _terms(data, offsets)
        out = np.zeros((n, 1 + SUBSETS), np.uint64)
        value = mix(term)
        everything = np.zeros(n, np.uint64)
        np.add.at(everything, text, value)
        if len(self.terms):
            at = np.minimum(np.searchsorted(self.terms, term), len(self.terms) - 1)
            known = self.terms[at] == term
            text, at, value = text[known], at[known], value[known]
            heads = np.flatnonzero(np.r_[True, np.diff(text) != 0]) if len(text) else np.empty(0, int)
            if len(heads):
                owner = text[heads]
                out[owner, 0] = np.add.reduceat(value, heads)
                held = self.member[at]
                for k in range(SUBSETS):
                    out[owner, k + 1] = np.add.reduceat(np.where(held[:, k], value, np.uint64(0)), heads)
        bare = ~out.any(axis=1)
        out[bare, 0] = mix(everything[bare] ^ _OTHER)
        return out


def likeness(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Row by row: the share of equal hashes among subsets in which either has a term; without any, whether all is equal."""
    same, informative = a[:, 1:] == b[:, 1:], (a[:, 1:] != 0) | (b[:, 1:] != 0)
    n = informative.sum(axis=1)
    return np.where(n > 0, (same & informative).sum(axis=1) / np.maximum(n, 1), (a[:, 0] == b[:, 0]).astype(float))


def text_of(prints: np.ndarray) -> list[str]:
    """A fingerprint as text: 16 hex digits of the whole selection, then 8 per subset."""
    whole = prints[:, 0].astype(">u8")
    subsets = (prints[:, 1:] >> np.uint64(32)).astype(">u4")
    subsets[(subsets == 0) & (prints[:, 1:] != 0)] = 1
    return [w.tobytes().hex() + s.tobytes().hex() for w, s in zip(whole, subsets)]


def lexicon(docs: DataFrame, min_share: float = MIN_SHARE, max_share: float = MAX_SHARE) -> Lexicon:
    """Terms that occur in between min_share and max_share of the documents (and in two at least)."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            terms = [_terms(data, offsets)[1] for _, data, offsets in slices(batch.column(0))]
            term, n = np.unique(np.concatenate(terms) if terms else np.empty(0, np.uint64), return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(term.view(np.int64)), pa.array(n)], ["term", "n"])

    total = docs.count()
    counted = docs.select("text").mapInArrow(count, "term long, n long").groupBy("term").agg(F.sum("n").alias("n"))
    band = counted.where(F.col("n").between(max(2.0, min_share * total), max(2.0, max_share * total)))
    held = store(band.select("term"), "lexicon").toArrow()["term"]
    return Lexicon(held.combine_chunks().to_numpy(zero_copy_only=False).view(np.uint64))


def fingerprints(docs: DataFrame, words_: Lexicon) -> DataFrame:
    """(doc_id, fingerprint) per document.  Null and empty texts share the fingerprint of no terms."""
    schema = f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, fingerprint string"

    def batches(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in rows:
            prints = [p for _, data, offsets in slices(batch.column(1)) for p in text_of(words_.prints(data, offsets))]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(prints, pa.string())], ["doc_id", "fingerprint"])

    return docs.select("doc_id", "text").mapInArrow(batches, schema)


# --- a document, its edited text and the next document -----------------------------------------------------------

_NEIGHBOURS = (
    "n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
    "near_edited double, near_next double, part int, place int, edge binary"
)


def _edit(text: str, following: str) -> str:
    """The last half of the text's code points replaced by the first as many of the following one."""
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


def _compare(words_: Lexicon, ids: pa.Array, texts: list[str], followers: list[str], next_prints: np.ndarray, prints: np.ndarray) -> pa.RecordBatch:
    edited = [_edit(t, f).encode() for t, f in zip(texts, followers)]
    changed = np.concatenate([words_.prints(d, o) for _, d, o in slices(pa.array(edited, pa.large_binary()))])
    n = len(texts)
    columns = [
        ids, pa.array([len(t) for t in texts], pa.int64()), pa.array([hashlib.sha256(e).hexdigest() for e in edited]),
        pa.array(text_of(prints)), pa.array(text_of(changed)), pa.array(likeness(prints, changed)), pa.array(likeness(prints, next_prints)),
        pa.nulls(n, pa.int32()), pa.nulls(n, pa.int32()), pa.nulls(n, pa.binary()),
    ]
    return pa.RecordBatch.from_arrays(columns, _names())


def _names() -> list[str]:
    return ["doc_id", *(c.split()[0] for c in _NEIGHBOURS.split(", "))]


def _edge(part: int, place: int, doc_id: object, text: str, kind: pa.DataType) -> pa.RecordBatch:
    """First (place 0) or last (place 1) document of a partition, for the neighbouring partitions."""
    columns = [pa.array([doc_id], kind), *(pa.nulls(1, t) for t in (pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()))]
    columns += [pa.array([part], pa.int32()), pa.array([place], pa.int32()), pa.array([zstandard.compress(text.encode())], pa.binary())]
    return pa.RecordBatch.from_arrays(columns, _names())


def compared_with_next(docs: DataFrame, words_: Lexicon) -> DataFrame:
    """Fingerprints of every document and of its edited text, and their likeness to each other and to the next document's.

    Documents are ordered by ascending doc_id, null last (ties: by a hash of the text); the first one follows the last.
    The texts travel once, compressed, to partitions by ranges of doc_id; each task compares neighbours, and hands
    its first and last document on, so that a second, small step compares the neighbours across partitions.  A lone document follows itself.
    """
    kind = docs.schema["doc_id"].dataType.simpleString()

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        press = zstandard.ZstdCompressor(level=3)
        for batch in batches:
            packed = [press.compress(t) for t in batch.column(3).cast(pa.large_binary()).fill_null(b"").to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(packed, pa.binary())], ["doc_id", "tie", "row", "packed"])

    keyed = docs.select("doc_id", F.xxhash64("text").alias("tie"), F.monotonically_increasing_id().alias("row"), "text")
    packed = keyed.mapInArrow(pack, f"doc_id {kind}, tie long, row long, packed binary")
    order = [F.col("doc_id").asc_nulls_last(), F.col("tie"), F.col("row")]
    laid = packed.repartitionByRange(*order).sortWithinPartitions(*order).select("doc_id", "packed", F.spark_partition_id().alias("part"))

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpack = zstandard.ZstdDecompressor()
        last = None  # (id, text, prints) of the row before
        part = None
        for batch in batches:
            if not batch.num_rows:
                continue
            size = 0
            begin = 0
            held = batch.column(1).to_pylist()
            for i in range(batch.num_rows):
                size += len(held[i])
                if size < 1 << 19 and i + 1 < batch.num_rows:
                    continue
                ids = batch.column(0).slice(begin, i + 1 - begin)
                texts = [unpack.decompress(p).decode() for p in held[begin : i + 1]]
                begin, size = i + 1, 0
                prints = np.concatenate([words_.prints(d, o) for _, d, o in slices(pa.array([t.encode() for t in texts], pa.large_binary()))])
                if last is None:
                    part = batch.column(2)[0].as_py()
                    id_type = ids.type
                    yield _edge(part, 0, ids[0].as_py(), texts[0], id_type)
                    all_ids, all_texts, all_prints = ids, texts, prints
                else:
                    all_ids = pa.concat_arrays([pa.array([last[0]], ids.type), ids])
                    all_texts, all_prints = [last[1], *texts], np.concatenate([last[2], prints])
                if len(all_texts) > 1:
                    yield _compare(words_, all_ids.slice(0, len(all_texts) - 1), all_texts[:-1], all_texts[1:], all_prints[1:], all_prints[:-1])
                last = (all_ids[-1].as_py(), all_texts[-1], all_prints[-1:])
        if last is not None:
            yield _edge(part, 1, last[0], last[1], id_type)

    compared = store(laid.mapInArrow(compare, f"doc_id {kind}, {_NEIGHBOURS}"), "fingerprints_compared")
    edges = compared.where("part is not null")
    # one row per partition: which partition's first document follows its last one
    parts = sorted(r.part for r in edges.where("place = 1").select("part").collect())
    follows = [(p, parts[(i + 1) % len(parts)]) for i, p in enumerate(parts)]
    spark = docs.sparkSession
    follow = F.broadcast(spark.createDataFrame(follows, "part int, next int"))
    tails = edges.where("place = 1").join(follow, "part").select("doc_id", "edge", F.col("next").alias("next_part"))
    heads = edges.where("place = 0").select(F.col("part").alias("next_part"), F.col("edge").alias("next_edge"))
    across = tails.join(heads, "next_part").select("doc_id", "edge", "next_edge")

    def close(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpack = zstandard.ZstdDecompressor()
        for batch in batches:
            for i in range(batch.num_rows):
                text, following = (unpack.decompress(batch.column(c)[i].as_py()).decode() for c in (1, 2))
                both = np.concatenate([words_.prints(d, o) for _, d, o in slices(pa.array([text.encode(), following.encode()], pa.large_binary()))])
                yield _compare(words_, batch.column(0).slice(i, 1), [text], [following], both[1:], both[:1])

    rest = across.mapInArrow(close, f"doc_id {kind}, {_NEIGHBOURS}")
    return compared.where("part is null").unionByName(rest).drop("part", "place", "edge")
