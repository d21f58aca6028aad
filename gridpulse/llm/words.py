"""Bytes, words and hashes of Arrow text columns, computed for many texts at once.

All functions work on *slices*: some texts laid end to end in one byte array, with the
offsets at which each begins.  A slice holds about `SLICE_BYTES` (or one longer text), so the
working arrays of a task stay small whatever the batch that Spark hands over.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

SLICE_BYTES = 1 << 19

#: The white space between words: space, and the control characters 9 to 13.
SPACE = np.zeros(256, bool)
SPACE[[9, 10, 11, 12, 13, 32]] = True

#: A-Z become a-z, all other bytes stay.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

_MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)


class _Powers(dict):
    """A cache of powers by base; it travels empty."""

    def __reduce__(self):
        return _Powers, ()


_powers = _Powers()


def mix(x: np.ndarray) -> np.ndarray:
    """Scramble 64-bit integers one to one (the splitmix64 finaliser)."""
    x = x + _MULTIPLIER
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_BYTE = mix(np.arange(256, dtype=np.uint64))
#: Two odd bases, of byte strings and of word sequences.
BYTES_BASE, WORDS_BASE = 0xD1342543DE82EF95, 0xA0761D6478BD642F


def _powers_of(base: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """base**0 … base**n modulo 2**64, and the same of its inverse."""
    have = _powers.get(base)
    if have is None or len(have[0]) <= n:
        size = 1 << max(16, (n + 1).bit_length())
        both = []
        for b in (base, pow(base, -1, 1 << 64)):
            steps = np.full(size, b, np.uint64)
            steps[0] = 1
            both.append(np.multiply.accumulate(steps))
        _powers[base] = have = (both[0], both[1])
    return have


def span_hashes(values: np.ndarray, base: int, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    """64-bit hashes of values[begin:end] for many spans: equal spans, equal hashes."""
    power, inverse = _powers_of(base, len(values))
    prefix = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values * power[: len(values)], out=prefix[1:])
    return mix((prefix[end] - prefix[begin]) * inverse[begin] + (end - begin).astype(np.uint64))


def byte_values(data: np.ndarray) -> np.ndarray:
    return _BYTE[data]


def slices(column: pa.Array | pa.ChunkedArray) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(first row, bytes, offsets) of consecutive rows; a null text is an empty one."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_binary()).fill_null(b"")
    if not len(column):
        return
    _, at, data = column.buffers()
    offsets = np.frombuffer(at, np.int64)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(data, np.uint8) if data is not None else np.empty(0, np.uint8)
    row = 0
    while row < len(column):
        stop = int(np.searchsorted(offsets, offsets[row] + SLICE_BYTES, side="right")) - 1
        stop = min(max(stop, row + 1), len(column))
        yield row, data[offsets[row] : offsets[stop]], offsets[row : stop + 1] - offsets[row]
        row = stop


def words(data: np.ndarray, offsets: np.ndarray, space: np.ndarray = SPACE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Begin and end (exclusive) of every word, and the offsets at which each text's words begin."""
    gap = space[data]
    first, last = ~gap, ~gap
    first[1:] &= gap[:-1]
    last[:-1] &= gap[1:]
    heads = offsets[:-1][offsets[:-1] < len(data)]
    tails = offsets[1:][offsets[1:] > 0] - 1
    first[heads] = ~gap[heads]
    last[tails] = ~gap[tails]
    begin, end = np.flatnonzero(first), np.flatnonzero(last) + 1
    return begin, end, np.searchsorted(begin, offsets)


def word_hashes(data: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    return span_hashes(byte_values(data), BYTES_BASE, begin, end)


def windows(values: np.ndarray, base: int, bounds: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Starts and hashes of all runs of `length` values that lie within one text (bounds: n + 1 offsets)."""
    starts = np.arange(max(0, len(values) - length + 1))
    text_end = np.repeat(bounds[1:], np.diff(bounds))
    starts = starts[text_end[: len(starts)] >= starts + length]
    return starts, span_hashes(values, base, starts, starts + length)


def cover(starts: np.ndarray, length: int | np.ndarray, n: int) -> np.ndarray:
    """Which of n positions lie in a run of `length` (one for all, or one each) from one of the starts."""
    edge = np.zeros(n + 1, np.int32)
    np.add.at(edge, starts, 1)
    np.add.at(edge, np.minimum(starts + length, n), -1)
    return np.cumsum(edge[:n]) > 0


def ranges(counts: np.ndarray) -> np.ndarray:
    """0 … counts[0]-1, 0 … counts[1]-1, and so on."""
    total = int(counts.sum())
    return np.arange(total) - np.repeat(np.cumsum(counts) - counts, counts)
