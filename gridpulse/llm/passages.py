"""Long repeated passages: sampled anchors first, all windows only where the anchors repeat.

A *window* is `length` values in a row (bytes or words), a *gram* half as many.  Of the grams in a window the one with
the smallest hash is its anchor.  The choice depends on the window's content alone, so two equal windows have equal anchors: a window
can only be repeated if its anchor is.  About one gram in `length / 4` is an anchor.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridpulse.llm.words import BYTES_BASE, WORDS_BASE, byte_values, ranges, slices, span_hashes, word_hashes, words

#: Pieces that a territory is cut into before its windows are compared.
PIECES = 8

_LOW = np.uint64(0xFFFFFFFF)
_HIGH = np.uint64(32)


def of_bytes(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    return byte_values(data), offsets


def of_words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    begin, end, bounds = words(data, offsets)
    return word_hashes(data, begin, end), bounds


@dataclass(frozen=True)
class Passages:
    """How texts become values, the base their hashes use, and the window length."""

    values: Callable
    base: int
    length: int

    @property
    def half(self) -> int:
        return self.length // 2

    def _grams(self, values: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Hashes of all grams, starts of all windows that lie within one text, and the position of each one's anchor."""
        n = len(values)
        starts = np.arange(max(0, n - self.half + 1))
        hashes = span_hashes(values, self.base, starts, starts + self.half)
        text_end = np.repeat(bounds[1:], np.diff(bounds))
        inside = np.flatnonzero(text_end[: max(0, n - self.length + 1)] >= np.arange(max(0, n - self.length + 1)) + self.length)
        if not len(inside):
            return hashes, inside, inside
        # the smallest hash, leftmost among equals, of every `count` grams in a row
        count, width = self.length - self.half + 1, 1
        least = (hashes >> _HIGH << _HIGH) | starts.astype(np.uint64)
        while width * 2 <= count:
            least = np.minimum(least[:-width], least[width:])
            width *= 2
        if width < count:
            rest = count - width
            least = np.minimum(least[:-rest], least[rest:])
        return hashes, inside, (least[inside] & _LOW).astype(np.int64)

    def anchors(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(text, gram hash) of every anchor of a slice."""
        values, bounds = self.values(data, offsets)
        hashes, _, anchor = self._grams(values, bounds)
        chosen = np.zeros(len(values), bool)
        chosen[anchor] = True
        at = np.flatnonzero(chosen)
        return np.searchsorted(bounds, at, side="right") - 1, hashes[at]

    def windows(self, data: np.ndarray, offsets: np.ndarray, repeated: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(text, start in the text, hash) of the windows whose anchor is among the text's repeated grams."""
        values, bounds = self.values(data, offsets)
        hashes, starts, anchor = self._grams(values, bounds)
        repeats = np.zeros(len(values), bool)
        for k, (a, b) in enumerate(zip(bounds[:-1], bounds[1:])):
            repeats[a : min(b, len(hashes))] = np.isin(hashes[a:b], repeated[k])
        starts = starts[repeats[anchor]]
        owner = np.searchsorted(bounds, starts, side="right") - 1
        return owner, starts - bounds[owner], span_hashes(values, self.base, starts, starts + self.length)


    def territories(self, data: np.ndarray, offsets: np.ndarray, repeated: list[np.ndarray]) -> tuple[np.ndarray, ...]:
        """(text, first start, starts, anchor, gram, hash) of each run of windows with one repeated anchor; the hash is of all they cover."""
        values, bounds = self.values(data, offsets)
        hashes, starts, anchor = self._grams(values, bounds)
        repeats = np.zeros(len(values), bool)
        for k, (a, b) in enumerate(zip(bounds[:-1], bounds[1:])):
            repeats[a : min(b, len(hashes))] = np.isin(hashes[a:b], repeated[k])
        heads = np.flatnonzero(np.r_[True, (np.diff(anchor) != 0) | (np.diff(starts) != 1)]) if len(starts) else np.empty(0, np.int64)
        n = np.diff(np.r_[heads, len(starts)])
        heads, n = heads[repeats[anchor[heads]]], n[repeats[anchor[heads]]]
        first = starts[heads]
        owner = np.searchsorted(bounds, first, side="right") - 1
        whole = span_hashes(values, self.base, first, first + n - 1 + self.length)
        return owner, first - bounds[owner], n, anchor[heads] - bounds[owner], hashes[anchor[heads]], whole

    def pieces(self, data: np.ndarray, offsets: np.ndarray, runs: list[tuple]) -> tuple[np.ndarray, ...]:
        """(text, first start, starts, hash, whole) of territories cut into pieces; the hashes are of what every window of a piece
        covers, and of what they cover together.

        Pieces are cut at fixed distances from the anchor, so equal windows are in pieces of equal hash.
        """
        values, bounds = self.values(data, offsets)
        first, n, at = (np.concatenate([r[k] + (a if k != 1 else 0) for r, a in zip(runs, bounds)]) for k in range(3))
        width = (self.length - self.half) // PIECES + 1
        out = []
        for k in range(PIECES):
            low, high = np.maximum(first, at - (k + 1) * width + 1), np.minimum(first + n - 1, at - k * width)
            some = low <= high
            common = at[some] - k * width
            out.append((low[some], high[some] - low[some] + 1, span_hashes(values, self.base, common, common + self.length - width + 1)))
        start, n, value = map(np.concatenate, zip(*out))
        owner = np.searchsorted(bounds, start, side="right") - 1
        return owner, start - bounds[owner], n, value, span_hashes(values, self.base, start, start + n - 1 + self.length)

    def windows_in(self, data: np.ndarray, offsets: np.ndarray, runs: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(text, start, hash) of the windows in given runs (first starts, numbers of starts) of each text."""
        values, bounds = self.values(data, offsets)
        first = np.concatenate([s + a for (s, _), a in zip(runs, bounds)])
        n = np.concatenate([n for _, n in runs])
        starts = np.repeat(first, n) + ranges(n)
        owner = np.searchsorted(bounds, starts, side="right") - 1
        return owner, starts - bounds[owner], span_hashes(values, self.base, starts, starts + self.length)


BYTES, WORDS = (of_bytes, BYTES_BASE), (of_words, WORDS_BASE)


def anchor_table(texts: DataFrame, kind: Passages) -> DataFrame:
    """(gram, id, n): the anchors of each text, with how often the text has each; `texts` has text and id."""

    def batches(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in rows:
            for first, data, offsets in slices(batch.column(0)):
                text, gram = kind.anchors(data, offsets)
                order = np.lexsort((gram, text))
                text, gram = text[order], gram[order]
                heads = np.flatnonzero(np.r_[True, (np.diff(text) != 0) | (gram[1:] != gram[:-1])]) if len(text) else np.empty(0, np.int64)
                n = np.diff(np.r_[heads, len(text)])
                ids = batch.column(1).take(pa.array(first + text[heads]))
                yield pa.RecordBatch.from_arrays([pa.array(gram[heads].view(np.int64)), ids, pa.array(n, pa.int32())], ["gram", "id", "n"])

    return texts.select("text", "id").mapInArrow(batches, "gram long, id long, n int")


def window_table(texts: DataFrame, kind: Passages) -> DataFrame:
    """(hash, id, start) of the windows that may be repeated; `texts` has text, id and grams, its repeated ones."""

    def batches(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in rows:
            grams = [np.asarray(g.as_py(), np.int64).view(np.uint64) for g in batch.column(2)]
            for first, data, offsets in slices(batch.column(0)):
                text, start, value = kind.windows(data, offsets, grams[first : first + len(offsets) - 1])
                ids = batch.column(1).take(pa.array(first + text))
                yield pa.RecordBatch.from_arrays([pa.array(value.view(np.int64)), ids, pa.array(start, pa.int32())], ["hash", "id", "start"])

    return texts.select("text", "id", "grams").mapInArrow(batches, "hash long, id long, start int")


def territory_table(texts: DataFrame, kind: Passages) -> DataFrame:
    """(gram, hash, id, start, n, at): the territories of repeated anchors; `texts` has text, id and grams."""

    def batches(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in rows:
            grams = [np.asarray(g.values, np.int64).view(np.uint64) for g in batch.column(2)]
            for first, data, offsets in slices(batch.column(0)):
                text, start, n, at, gram, whole = kind.territories(data, offsets, grams[first : first + len(offsets) - 1])
                ids = batch.column(1).take(pa.array(first + text))
                columns = [pa.array(gram.view(np.int64)), pa.array(whole.view(np.int64)), ids, *(pa.array(c, pa.int32()) for c in (start, n, at))]
                yield pa.RecordBatch.from_arrays(columns, ["gram", "hash", "id", "start", "n", "at"])

    return texts.select("text", "id", "grams").mapInArrow(batches, "gram long, hash long, id long, start int, n int, at int")


def piece_table(texts: DataFrame, kind: Passages) -> DataFrame:
    """(hash, whole, id, start, n): pieces of territories; `texts` has text, id and runs, an array of (start, n, at)."""

    def batches(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in rows:
            runs = [(*run_arrays(r), np.asarray(r.values.field("at"), np.int64)) for r in batch.column(2)]
            for first, data, offsets in slices(batch.column(0)):
                text, start, n, value, whole = kind.pieces(data, offsets, runs[first : first + len(offsets) - 1])
                ids = batch.column(1).take(pa.array(first + text))
                columns = [pa.array(value.view(np.int64)), pa.array(whole.view(np.int64)), ids, pa.array(start, pa.int32()), pa.array(n, pa.int32())]
                yield pa.RecordBatch.from_arrays(columns, ["hash", "whole", "id", "start", "n"])

    return texts.select("text", "id", "runs").mapInArrow(batches, "hash long, whole long, id long, start int, n int")


def run_windows(texts: DataFrame, kind: Passages) -> DataFrame:
    """(hash, id, start) of the windows in given runs; `texts` has text, id and runs, an array of (start, n)."""

    def batches(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in rows:
            runs = [run_arrays(r) for r in batch.column(2)]
            for first, data, offsets in slices(batch.column(0)):
                text, start, value = kind.windows_in(data, offsets, runs[first : first + len(offsets) - 1])
                ids = batch.column(1).take(pa.array(first + text))
                yield pa.RecordBatch.from_arrays([pa.array(value.view(np.int64)), ids, pa.array(start, pa.int32())], ["hash", "id", "start"])

    return texts.select("text", "id", "runs").mapInArrow(batches, "hash long, id long, start int")


def run_arrays(runs: pa.ListScalar) -> tuple[np.ndarray, np.ndarray]:
    """First starts and numbers of starts of a list of runs."""
    return np.asarray(runs.values.field("start"), np.int64), np.asarray(runs.values.field("n"), np.int64)


def grouped(pairs: DataFrame, column: str, name: str) -> DataFrame:
    """(id, name): all values of a text in one array, bounded by the text's length."""
    return pairs.groupBy("id").agg(F.collect_list(column).alias(name))
