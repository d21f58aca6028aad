"""Token alignment of two tokenizers, computed once per distinct text.

1. **Exact deduplication.** Texts are shuffled as whole texts, copies merge (partly before the shuffle) into one row with their number.
2. **Alignment.** Every distinct text is tokenized by both tokenizers and aligned once.  Bytes where tokens of both end cut it into groups; a link is a pair
   of tokens whose bytes overlap, that is, a stretch between neighbouring token ends of either kind.
3. **Pair counts.** Links of a pair of ids are counted with the copies of their text: inside *blocks* of about `BLOCK_BYTES` of texts first, then by Spark over
   all blocks.  A pair occurs at most once per block after that, so a pair that is in every text is no hot key.
4. **Measures.** Each block asks for the counts of its pairs; they go to the block's texts, and the texts' measures to the documents.  A text that more than one in
   `HOT_SHARE` documents have is joined by broadcast (there are at most `HOT_SHARE` of them), all others by their hash.

A text that is null or empty, or that one of the tokenizers does not give back byte by byte, has no tokens: its numbers are 0 and its groups ''.  Repeated
rows and rows without doc_id keep their own rows.  Other columns are ignored.  Empty tables give empty tables.  Very long texts are blocks of their own.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from hashlib import sha256
from typing import Any

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridpulse.llm.memory import given_back
from gridpulse.llm.texts import KEYS, text_keys
from gridpulse.llm.tokens import JOINED, Remembered, chunks, kept, public_path, safe_ends, tokenizer
from gridpulse.workspace import store

#: Bytes of texts (in characters) whose pairs are counted together.
BLOCK_BYTES = 1 << 22

#: A text of more than 1 / HOT_SHARE of the documents is joined by broadcast.
HOT_SHARE = 1000

#: Chunks that cannot be read as one text are halved until they are so few, and then read one by one.
ALONE = 32

#: A pair of ids (a, b) is the number a * PAIR + b.
PAIR = 1 << 20

MEASURES = ("n_a", "n_b", "n_groups", "n_links")
_SUMS = ("n_best", "count_sum")


# -- tokens with their bytes ---------------------------------------------------------


def _byte_level() -> dict[str, int]:
    """The printable characters that stand for bytes in byte-level vocabularies: printable ones for themselves, others from 256 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(others)}


@dataclass(frozen=True)
class Vocabulary:
    """A tokenizer and the bytes of its ids; `encode` takes many texts, each to be read with a space in front."""

    encode: Callable[[list[str]], list[list[int]]]
    bytes: list[bytes]

    def joined(self, ids: list[int]) -> bytes:
        return b"".join(map(self.bytes.__getitem__, ids))


def _byte_level_file(path: str) -> tuple[Any, list[bytes]]:
    made, of = tokenizer(path, plain_specials=True), _byte_level()
    entries = [made.id_to_token(k) or "" for k in range(made.get_vocab_size())]
    return made, [bytes(of[c] for c in e) if all(c in of for c in e) else e.encode() for e in entries]


def byte_level(path: str) -> Vocabulary:
    """A byte-level tokenizer of the `tokenizers` library."""
    made, raw = kept("byte level", path, _byte_level_file)
    return Vocabulary(lambda texts: [e.ids for e in made.encode_batch_fast([" " + t for t in texts], add_special_tokens=False)], raw)


def _pieces_file(path: str) -> tuple[Any, list[bytes]]:
    from sentencepiece import SentencePieceProcessor

    made = SentencePieceProcessor(model_file=path)
    n = made.get_piece_size()
    return made, [bytes([int(made.id_to_piece(k)[3:5], 16)]) if made.is_byte(k) else made.id_to_piece(k).replace("▁", " ").encode() for k in range(n)]


def pieces(path: str) -> Vocabulary:
    """A sentencepiece model, which puts the space in front itself."""
    made, raw = kept("pieces", path, _pieces_file)
    return Vocabulary(lambda texts: made.encode(texts, num_threads=1), raw)


class _Digits:
    """Decimal numbers with a separator behind them, as rows of bytes; unused bytes are 0."""

    def __init__(self, n: int) -> None:
        width = len(str(n))
        self.table = np.zeros((n, width + 1), np.uint8)
        numbers = np.arange(n).astype(f"S{width}")
        self.table[:, :width] = numbers.view(np.uint8).reshape(n, width)

    def written(self, ids: np.ndarray, separators: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """All bytes in a row, and how many each number takes."""
        rows = self.table[ids]
        rows[:, -1] = separators
        used = rows != 0
        return rows[used], used.sum(axis=1)


#: What is known of a chunk: how many tokens of the first kind it has, the pairs of its links, its groups; None if it does not come back.
_Chunk = tuple[int, bytes, bytes] | None


class Aligner:
    """Texts to measures, pairs and groups; chunks are tokenized and aligned once."""

    def __init__(self, path_a: str, path_b: str) -> None:
        self.a, self.b = byte_level(path_a), pieces(path_b)
        self.lengths = [np.array([len(x) for x in v.bytes]) for v in (self.a, self.b)]
        self.digits = _Digits(max(len(self.a.bytes), len(self.b.bytes)))
        self.remembered = Remembered(lambda new: zip(new, self._aligned(new)), JOINED)

    def texts(self, texts: list[str]) -> Iterator[tuple[tuple[int, ...], np.ndarray, str] | None]:
        """For each text its numbers, the pairs of its links and the hash of its groups, or None if it has no tokens."""
        cut = [chunks(t) if t else [] for t in texts]
        known = self.remembered.of(set().union(*cut))
        for own in cut:
            found = [known[c] for c in own]
            if not found or None in found:
                yield None
                continue
            tokens_a, parts, texts_of = zip(*found)
            n_a, pairs, groups = sum(tokens_a), np.frombuffer(b"".join(parts), np.int64), b"".join(texts_of)
            n_groups = groups.count(b";")
            tokens = groups.count(b",") + 2 * n_groups  # one separator behind each token; a group ends one of either kind
            yield (n_a, tokens - n_a, n_groups, len(pairs)), pairs, sha256(groups[:-1]).hexdigest()

    def _tokens(self, texts: list[str]) -> list[list[int]] | None:
        """Ids of one text by both tokenizers, if both give it back."""
        ids = [v.encode(texts)[0] for v in (self.a, self.b)]
        want = (" " + texts[0]).encode()
        return ids if all(v.joined(own) == want for v, own in zip((self.a, self.b), ids)) else None

    def _aligned(self, new: list[str]) -> list[_Chunk]:
        """All new chunks laid end to end and aligned at once: both tokenizers end a token at every chunk's end."""
        out: list[_Chunk] = [None] * len(new)
        joint = self._tokens([" ".join(new)]) if safe_ends(new) else None
        if joint is not None:
            some, flat = list(range(len(new))), [np.array(x) for x in joint]
        elif len(new) > ALONE:  # what keeps them apart may be one chunk
            return self._aligned(new[: len(new) // 2]) + self._aligned(new[len(new) // 2 :])
        else:
            each = [self._tokens([c]) for c in new]
            some = [k for k, ids in enumerate(each) if ids is not None]
            if not some:
                return out
            flat = [np.concatenate([each[k][side] for k in some]) for side in (0, 1)]
        ends_a, ends_b = (np.cumsum(n[f]) for n, f in zip(self.lengths, flat))
        bounds = np.cumsum([1 + (len(c) if c.isascii() else len(c.encode())) for c in map(new.__getitem__, some)])
        common = np.intersect1d(ends_a, ends_b, assume_unique=True)
        cuts = np.union1d(ends_a, ends_b)
        pairs = flat[0][np.searchsorted(ends_a, cuts)] * PAIR + flat[1][np.searchsorted(ends_b, cuts)]
        text, at = self._groups(flat, ends_a, ends_b, common)
        last_a, last_b, last_cut = (np.searchsorted(x, bounds, side="right") for x in (ends_a, ends_b, cuts))
        text_end = at[last_a + last_b - 1].tolist()  # a chunk's tokens of both kinds come together
        tokens_a, raw, links = np.diff(last_a, prepend=0).tolist(), text.tobytes(), pairs.astype(np.int64).tobytes()
        first = text_first = 0
        for chunk, n_a, cut, end in zip(some, tokens_a, last_cut.tolist(), text_end):
            out[chunk] = (n_a, links[8 * first : 8 * cut], raw[text_first:end])
            first, text_first = cut, end
        return out

    def _groups(self, flat: list[np.ndarray], ends_a: np.ndarray, ends_b: np.ndarray, common: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """`a1,a2|b1;` of every group, and where each token's text ends."""
        group_a, group_b = np.searchsorted(common, ends_a), np.searchsorted(common, ends_b)
        order = np.empty(len(ends_a) + len(ends_b), np.int64)
        place_a = np.arange(len(ends_a)) + np.searchsorted(group_b, group_a)
        place_b = np.arange(len(ends_b)) + np.searchsorted(group_a, group_b, side="right")
        separators = np.empty(len(order), np.uint8)
        order[place_a], order[place_b] = flat
        separators[place_a] = np.where(np.isin(ends_a, common, assume_unique=True), ord("|"), ord(","))
        separators[place_b] = np.where(np.isin(ends_b, common, assume_unique=True), ord(";"), ord(","))
        text, used = self.digits.written(order, separators)
        return text, np.cumsum(used)


# -- links of a text, kept small -----------------------------------------------------


def _packed(pairs: np.ndarray, times: np.ndarray) -> bytes:
    """Ascending pairs and how often each occurs."""
    return zstandard.compress(np.concatenate([np.diff(pairs, prepend=0), times]).astype("<i8").reshape(-1, 1).view(np.uint8).T.tobytes(), 1)


def _unpacked(links: bytes) -> tuple[np.ndarray, np.ndarray]:
    planes = np.frombuffer(zstandard.decompress(links), np.uint8).reshape(8, -1)
    both = np.ascontiguousarray(planes.T).view("<i8").ravel()
    half = len(both) // 2
    return np.cumsum(both[:half]), both[half:]


# -- the job -------------------------------------------------------------------------


_ALIGNED = "block long, key1 long, key2 long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, links binary, pairs array<long>, counts array<long>"


def _blocks(path_a: str, path_b: str, block_bytes: int):
    """Distinct texts with their copies become, per block, a row for each text and one with the block's pairs and counts."""

    def align(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner, block = Aligner(path_a, path_b), TaskContext.get().partitionId() << 33
        held: list[tuple] = []
        size = 0
        for batch in batches:
            for row in zip(*[batch.column(c) for c in ("text", *KEYS, "copies")]):
                held.append(tuple(x.as_py() for x in row))
                size += len(held[-1][0])
                if size >= block_bytes:
                    yield _block(aligner, block, held)
                    held, size, block = [], 0, block + 1
        if held:
            yield _block(aligner, block, held)

    return align


def _block(aligner: Aligner, block: int, held: list[tuple]) -> pa.RecordBatch:
    found = [(h, f) for h, f in zip(held, aligner.texts([h[0] for h in held])) if f is not None]
    rows, seen, weights = [], [np.empty(0, np.int64)], [np.empty(0, np.int64)]
    for (_, key1, key2, copies), (numbers, pairs, digest) in found:
        distinct, times = np.unique(pairs, return_counts=True)
        rows.append((key1, key2, *numbers, digest, _packed(distinct, times)))
        seen.append(distinct)
        weights.append(times * copies)
    pairs, place = np.unique(np.concatenate(seen), return_inverse=True)
    counts = np.zeros(len(pairs), np.int64)
    np.add.at(counts, place, np.concatenate(weights))
    rows.append((None,) * 8)
    kinds = [pa.int64()] * 6 + [pa.string(), pa.binary()]
    names = [*KEYS, *MEASURES, "groups_sha256", "links"]
    columns = {n: pa.array([r[k] for r in rows], kind) for k, (n, kind) in enumerate(zip(names, kinds))}
    lists = {n: pa.array([None] * (len(rows) - 1) + [x], pa.list_(pa.int64())) for n, x in (("pairs", pairs), ("counts", counts))}
    return pa.RecordBatch.from_pydict({"block": pa.array([block] * len(rows), pa.int64())} | columns | lists)


def _summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Texts of one block after another, each led by the block's pairs with their corpus-wide counts."""
    pairs = counts = best = np.empty(0, np.int64)
    for batch in batches:
        rows, sums = [], []
        asked, links = batch.column("asked"), batch.column("links")
        for k in range(batch.num_rows):
            if asked[k].is_valid:
                entries = asked[k].values
                pairs, counts, best = (entries.field(c).to_numpy(zero_copy_only=False) for c in ("pair", "n", "best"))
                order = np.argsort(pairs)
                pairs, counts, best = pairs[order], counts[order], best[order]
            else:
                own, times = _unpacked(links[k].as_py())
                at = np.searchsorted(pairs, own)
                rows.append(k)
                sums.append((int(times[best[at]].sum()), int((times * counts[at]).sum())))
        given = batch.select([*KEYS, *MEASURES, "groups_sha256"]).take(pa.array(rows, pa.int64()))
        columns = {n: given.column(n) for n in given.schema.names}
        yield pa.RecordBatch.from_pydict(columns | {n: pa.array([s[k] for s in sums], pa.int64()) for k, n in enumerate(_SUMS)})


def pair_counts(aligned: DataFrame) -> DataFrame:
    """(pair, n, best): links of every pair of ids, and whether no other first id has more links with the second one."""
    entries = aligned.where(F.col("pairs").isNotNull()).select(F.explode(F.arrays_zip("pairs", "counts")).alias("e"))
    counted = store(entries.groupBy(F.col("e.pairs").alias("pair")).agg(F.sum("e.counts").alias("n")), "pair_counts")
    of_b = F.col("pair") % PAIR
    most = counted.groupBy(of_b.alias("b")).agg(F.max("n").alias("most"))  # at most one row per id of the second vocabulary
    return counted.join(F.broadcast(most), of_b == F.col("b")).select("pair", "n", (F.col("n") == F.col("most")).alias("best"))


def aligned_texts(docs: DataFrame, path_a: str, path_b: str, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """The stored alignments of all distinct texts, and a row of pair counts per block."""
    copies = docs.where("text <> ''").groupBy("text").agg(F.count("*").alias("copies"))
    keyed = copies.select("text", *text_keys(F.col("text")), "copies")
    return store(keyed.mapInArrow(given_back(_blocks(path_a, path_b, block_bytes)), _ALIGNED), "aligned")


def text_measures(aligned: DataFrame) -> DataFrame:
    """One row per distinct text that has tokens: its hash, measures and the hash of its groups."""
    asked = aligned.where(F.col("pairs").isNotNull()).select("block", F.explode("pairs").alias("pair")).join(pair_counts(aligned), "pair")
    heads = asked.groupBy("block").agg(F.collect_list(F.struct("pair", "n", "best")).alias("asked"))
    texts = aligned.where(F.col("key1").isNotNull()).drop("pairs", "counts")
    led = texts.unionByName(heads, allowMissingColumns=True).repartition("block").sortWithinPartitions("block", F.col("asked").isNull())
    columns = ", ".join(f"{c} long" for c in (*KEYS, *MEASURES)) + ", groups_sha256 string, " + ", ".join(f"{c} long" for c in _SUMS)
    return led.select("asked", *KEYS, *MEASURES, "groups_sha256", "links").mapInArrow(given_back(_summed), columns)


def alignment(docs: DataFrame, path_a: str | None = None, path_b: str | None = None, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """One row per document: doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum (all long) and groups_sha256.

    n_best: links whose pair has the most links of all pairs with its second id, ties included; count_sum: the pair counts of all links.
    """
    aligned = aligned_texts(docs, path_a or public_path("byte_bpe_50k.json"), path_b or public_path("piece_bpe_32k.model"), block_bytes)
    measures = store(text_measures(aligned), "text_measures")
    keyed = docs.select("doc_id", *text_keys(F.col("text")))
    often = keyed.groupBy(*KEYS).agg(F.count("*").alias("copies"))
    limit = keyed.count() // HOT_SHARE
    hot = store(often.where(F.col("copies") > max(limit, 1)).select(*KEYS).join(measures, KEYS), "hot_measures")
    rare = keyed.join(F.broadcast(hot.select(*KEYS)), KEYS, "left_anti").join(measures, KEYS, "left")
    full = keyed.join(F.broadcast(hot), KEYS).unionByName(rare)
    numbers = [F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in (*MEASURES, *_SUMS)]
    return full.select("doc_id", *numbers, F.coalesce("groups_sha256", F.lit("")).alias("groups_sha256"))
