"""Benchmark decontamination by greedy string tiling.

A test item and a document are compared as token sequences (runs of letters, digits and non-ASCII
characters; A-Z lower-cased).  Seeds, runs of `MIN_MATCH` tokens that both share, are found by their
Karp-Rabin hashes.  Tiling then marks the longest match of unmarked tokens, again and again, until none of
`MIN_MATCH` tokens is left.  Tiles may stand in any order in the document, so reordered passages count;
an item is leaked where its tiles cover `MIN_COVERAGE` of its tokens.

Scale: the items are a query set held against all documents, in blocks of at most about `BLOCK_CHARS`
characters.  A block travels to the executors with the function, so documents are neither shuffled nor paired:
one pass over the documents per block.  Only (document, item) pairs whose shared seeds can reach the coverage are tiled.

Items of fewer than `MIN_MATCH` tokens have no seed and are never reported.  Null texts count as empty.
Items with a null id are searched like all others and reported with a null item_id; each of their distinct texts is one item.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridpulse.llm.words import LOWER, WORDS_BASE, slices, windows, word_hashes, words

MIN_MATCH = 4
MIN_COVERAGE = 0.5
BLOCK_CHARS = 4_000_000
#: Bits of the first, cheap test whether a document's hash can be a seed.
FILTER_BITS = 22

#: What separates tokens: all ASCII but letters and digits.
SEPARATOR = np.ones(256, bool)
SEPARATOR[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = False

LEAKS = "item_id long, item_tokens long, covered_tokens long, coverage double, n_tiles long, longest_tile long"


def tokens(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Token hashes of a slice, and where each text's begin."""
    lowered = LOWER[data]
    begin, end, bounds = words(lowered, offsets, SEPARATOR)
    return word_hashes(lowered, begin, end), bounds


def tile(pairs_item: np.ndarray, pairs_doc: np.ndarray, min_match: int) -> list[tuple[int, int, int]]:
    """Greedy tiles (item start, document start, length) from all pairs of positions that share a seed.

    Seeds in a row on one diagonal are one match.  The longest match goes first, ties by position; one that has lost
    tokens to earlier tiles returns to the queue as what is left of it.
    """
    diagonal = pairs_doc - pairs_item
    order = np.lexsort((pairs_item, diagonal))
    item, diagonal = pairs_item[order], diagonal[order]
    breaks = np.flatnonzero((np.diff(diagonal) != 0) | (np.diff(item) != 1)) + 1
    first, last = np.r_[0, breaks], np.r_[breaks, len(item)] - 1
    queue = [(-int(item[b] - item[a]) - min_match, int(item[a]), int(diagonal[a] + item[a])) for a, b in zip(first, last)]
    heapq.heapify(queue)
    used_item: set[int] = set()
    used_doc: set[int] = set()
    tiles = []
    while queue:
        negative, at_item, at_doc = heapq.heappop(queue)
        length = -negative
        free = [at_item + k not in used_item and at_doc + k not in used_doc for k in range(length)]
        if all(free):
            tiles.append((at_item, at_doc, length))
            used_item.update(range(at_item, at_item + length))
            used_doc.update(range(at_doc, at_doc + length))
            continue
        k = 0
        while k < length:
            run = k
            while run < length and free[run]:
                run += 1
            if run - k >= min_match:
                heapq.heappush(queue, (-(run - k), at_item + k, at_doc + k))
            k = run + 1
    return tiles


class _Items:
    """The seeds of one block of test items, ready to be looked up."""

    def __init__(self, ids: list[int | None], texts: list[bytes], min_match: int):
        data = np.frombuffer(b"".join(texts), np.uint8)
        offsets = np.cumsum([0, *map(len, texts)])
        hashes, bounds = tokens(data, offsets)
        starts, seeds = windows(hashes, WORDS_BASE, bounds, min_match)
        order = np.argsort(seeds, kind="stable")
        self.ids, self.sizes = ids, np.diff(bounds)
        self.seeds, self.at = seeds[order], starts[order]
        self.owner = np.searchsorted(bounds, self.at, side="right") - 1
        self.at = self.at - bounds[self.owner]
        self.maybe = np.zeros(1 << FILTER_BITS, bool)
        self.maybe[self.seeds >> np.uint64(64 - FILTER_BITS)] = True

    def find(self, hashes: np.ndarray, bounds: np.ndarray, min_match: int, coverage: float) -> Iterator[tuple]:
        """(text, item, tokens, covered, tiles, longest) of all leaks in a slice."""
        starts, seeds = windows(hashes, WORDS_BASE, bounds, min_match)
        hit = np.flatnonzero(self.maybe[seeds >> np.uint64(64 - FILTER_BITS)])
        low, high = np.searchsorted(self.seeds, seeds[hit]), np.searchsorted(self.seeds, seeds[hit], side="right")
        hit, low, high = hit[high > low], low[high > low], high[high > low]
        if not len(hit):
            return
        text = np.searchsorted(bounds, starts[hit], side="right") - 1
        edges = np.r_[0, np.flatnonzero(np.diff(text)) + 1, len(hit)]
        for a, b in zip(edges[:-1], edges[1:]):
            seen: dict[int, tuple[list, list]] = {}
            for at, l, h in zip(starts[hit[a:b]], low[a:b], high[a:b]):
                for k in range(l, h):
                    item, doc = seen.setdefault(int(self.owner[k]), ([], []))
                    item.append(int(self.at[k]))
                    doc.append(int(at))
            for owner, (item, doc) in seen.items():
                size = int(self.sizes[owner])
                reach = len({p + j for p in set(item) for j in range(min_match)})
                if reach < coverage * size:
                    continue
                tiles = tile(np.array(item), np.array(doc), min_match)
                covered = sum(t[2] for t in tiles)
                if covered >= coverage * size:
                    yield int(text[a]), self.ids[owner], size, covered, len(tiles), max(t[2] for t in tiles)


def _blocks(benchmark: DataFrame, min_match: int) -> Iterator[_Items]:
    """The items in blocks by a hash of their content, each about BLOCK_CHARS long; equal rows are one item."""
    items = benchmark.where(F.col("text").isNotNull()).select("item_id", "text").distinct()
    total = items.agg(F.sum(F.length("text"))).first()[0] or 0
    n = math.ceil(total / BLOCK_CHARS)
    for k in range(n):
        rows = items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(n)) == k).orderBy("item_id", "text").collect()
        if rows:
            yield _Items([r.item_id for r in rows], [r.text.encode() for r in rows], min_match)


def leaks(docs: DataFrame, benchmark: DataFrame, min_match: int = MIN_MATCH, coverage: float = MIN_COVERAGE) -> DataFrame:
    """One row per document and test item it leaks: doc_id and the columns of LEAKS.

    Clean documents have no row.  A repeated document is reported as often as it occurs; without items the result is empty.
    """
    docs = docs.select("doc_id", "text")
    spark = docs.sparkSession
    schema = f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, {LEAKS}"
    found = spark.createDataFrame([], schema)
    for block in _blocks(benchmark, min_match):

        def search(batches: Iterator[pa.RecordBatch], block=block) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                rows = []
                for first, data, offsets in slices(batch.column(1)):
                    for text, *leak in block.find(*tokens(data, offsets), min_match, coverage):
                        rows.append((first + text, *leak))
                if rows:
                    at, item, size, covered, n, longest = map(list, zip(*rows))
                    share = [c / s for c, s in zip(covered, size)]
                    columns = [batch.column(0).take(pa.array(at)), *(pa.array(c, t) for c, t in ((item, pa.int64()), (size, pa.int64()), (covered, pa.int64()), (share, pa.float64()), (n, pa.int64()), (longest, pa.int64())))]
                    yield pa.RecordBatch.from_arrays(columns, ["doc_id", "item_id", "item_tokens", "covered_tokens", "coverage", "n_tiles", "longest_tile"])

        found = found.unionByName(docs.mapInArrow(search, schema))
    return found


def clean_documents(docs: DataFrame, benchmark: DataFrame, min_match: int = MIN_MATCH, coverage: float = MIN_COVERAGE) -> DataFrame:
    """The documents that leak no item, columns unchanged: one filter per block of items, without a shuffle."""
    at = docs.columns.index("text")
    for block in _blocks(benchmark, min_match):

        def keep(batches: Iterator[pa.RecordBatch], block=block) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                clean = np.ones(batch.num_rows, bool)
                for first, data, offsets in slices(batch.column(at)):
                    for text, *_ in block.find(*tokens(data, offsets), min_match, coverage):
                        clean[first + text] = False
                yield batch.filter(pa.array(clean))

        docs = docs.mapInArrow(keep, docs.schema)
    return docs
