"""Documents packed into few sequences of bounded length, by linear grouping and best fit.

1. **Pieces.** Spark tokenizes every document (its ids, then an end id) and cuts those that are longer than a sequence.
2. **Histogram.** What the plan needs is how many pieces have each length: one number per length, at most `capacity` of them, however large
   the corpus is.
3. **Linear grouping.** Lengths above `capacity / LARGE` are split into `GROUPS` groups of equal cardinality, each rounded up to its longest.
   For so few sizes the best mix of configurations (what one sequence holds) is a linear program, solved by column generation: each
   column is the best configuration at the present prices.  Whole numbers of each configuration are kept.
4. **Substitution.** Slots of a group are taken by its actual pieces, longest first; what the rounding and the fractions leave over goes on to
5. **Best fit.** Remaining pieces, longest first, go where the least room is left that still holds them.

Pieces of equal length are interchangeable, so plan, substitution and best fit treat runs of sequences that are filled alike: an entry of the plan says that
pieces number r, r + 1, … of a length take one offset in sequences s, s + 1, … .  The plan's size depends on the number of
distinct lengths, not on that of documents.  Every piece finds its entry by its length and its number among the pieces of that length, which comes
from the number inside its task and the counts of earlier tasks; so a length that a third of all documents share is not a hot key.

Null texts are empty: their only token is the end id.  Rows are packed one by one, also repeated ones and those without doc_id.  Other columns are ignored.
An empty table gives an empty table.  Very long texts give many pieces.  Which of the pieces of one length goes where is arbitrary.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, insort
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gridpulse.llm.memory import given_back
from gridpulse.llm.tokens import ids_of_words, public_path
from gridpulse.workspace import store

CAPACITY, END_ID = 4096, 1

#: A length is large above capacity / LARGE; large ones are rounded in so many groups.
LARGE, GROUPS = 3, 256

#: Texts that are tokenized together, in characters.
TOGETHER = 1 << 21


# -- pieces --------------------------------------------------------------------------


def _tokenized(column: pa.Array, encode) -> Iterator[bytes]:
    """Ids of every text of a column, a bounded number of characters at a time."""
    held, size = [], 0
    for text in column:
        held.append(text.as_py() or "")
        size += len(held[-1])
        if size >= TOGETHER:
            yield from encode(held)
            held, size = [], 0
    yield from encode(held)


def pieces(docs: DataFrame, tokenizer_path: str, capacity: int = CAPACITY, end_id: int = END_ID, keep_ids: bool = False) -> DataFrame:
    """A stored table: doc_id, piece, start, length, ids_crc32, (ids,) and where its number among pieces of its length comes from (`_part`, `_nth`)."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    ids_column = ", ids array<int>" if keep_ids else ""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, end = ids_of_words(tokenizer_path), np.array([end_id], "<u4").tobytes()
        part, met = TaskContext.get().partitionId(), defaultdict(int)
        for batch in batches:
            rows: list[tuple] = []
            for row, ids in enumerate(_tokenized(batch.column("text"), encode)):
                ids += end
                for piece, at in enumerate(range(0, len(ids), 4 * capacity)):
                    own = ids[at : at + 4 * capacity]
                    rows.append((row, piece, piece * capacity, len(own) // 4, zlib.crc32(own), met[len(own)], own))
                    met[len(own)] += 1
            columns = [pa.array([r[k] for r in rows], pa.int32() if k == 1 else pa.int64()) for k in range(6)]
            out = {"doc_id": batch.column("doc_id").take(columns[0]), "piece": columns[1], "start": columns[2], "length": columns[3], "ids_crc32": columns[4]}
            out |= {"_part": pa.array([part] * len(rows), pa.int32()), "_nth": columns[5]}
            if keep_ids:
                out["ids"] = pa.array([np.frombuffer(r[6], "<i4") for r in rows], pa.list_(pa.int32()))
            yield pa.RecordBatch.from_pydict(out)

    schema = f"doc_id {kind}, piece int, start long, length long, ids_crc32 long, _part int, _nth long{ids_column}"
    return store(docs.select("doc_id", "text").mapInArrow(given_back(cut), schema), "pieces")


# -- the plan ------------------------------------------------------------------------


@dataclass
class Plan:
    """Entries: pieces `rank` … `rank + count - 1` of a length take `offset` in sequences `first` … `first + count - 1`."""

    capacity: int
    entries: list[tuple[int, int, int, int, int]] = field(default_factory=list)  # length, rank, count, first, offset
    sequences: int = 0
    used: dict[int, int] = field(default_factory=lambda: defaultdict(int))  # length: ranks given away
    open: dict[int, list[tuple[int, int]]] = field(default_factory=lambda: defaultdict(list))  # room: runs (first, count)
    rooms: list[int] = field(default_factory=list)  # rooms that have runs, ascending

    def new(self, count: int) -> tuple[int, int]:
        """A run of empty sequences."""
        run = (self.sequences, count)
        self.sequences += count
        return run

    def put(self, length: int, run: tuple[int, int], offset: int) -> None:
        """A piece of the length into every sequence of the run."""
        self.entries.append((length, self.used[length], run[1], run[0], offset))
        self.used[length] += run[1]

    def leave(self, room: int, run: tuple[int, int]) -> None:
        if room and run[1]:
            if not self.open[room]:
                insort(self.rooms, room)
            self.open[room].append(run)

    def best_fit(self, length: int, count: int) -> None:
        """So many pieces of the length, each where the least room is left."""
        while count:
            k = bisect_left(self.rooms, length)
            if k == len(self.rooms):
                each = self.capacity // length
                for slots, run in ((each, count // each), (count % each, 1 if count % each else 0)):
                    if run:
                        opened = self.new(run)
                        for slot in range(slots):
                            self.put(length, opened, slot * length)
                        self.leave(self.capacity - slots * length, opened)
                return
            room = self.rooms[k]
            first, size = self.open[room].pop()
            if not self.open[room]:
                self.rooms.pop(k)
            taken = min(size, count)
            self.put(length, (first, taken), self.capacity - room)
            self.leave(room - length, (first, taken))
            self.leave(room, (first + taken, size - taken))
            count -= taken


def _groups(histogram: dict[int, int], above: int, n: int) -> list[list[tuple[int, int]]]:
    """Lengths above a bound, longest first, in n groups of equally many pieces: lists of (length, pieces); a length may be in two groups."""
    large = [(length, histogram[length]) for length in sorted(histogram, reverse=True) if length > above]
    total = sum(c for _, c in large)
    out: list[list[tuple[int, int]]] = []
    seen = 0
    for length, count in large:
        while count:
            k = seen * n // total if total > n else seen
            end = -(-(k + 1) * total // n) if total > n else seen + 1
            if len(out) <= k:
                out += [[] for _ in range(k + 1 - len(out))]
            taken = min(count, max(end - seen, 1))
            out[k].append((length, taken))
            seen += taken
            count -= taken
    merged: list[list[tuple[int, int]]] = []
    for group in filter(None, out):  # groups that are rounded to one length are one size
        if merged and merged[-1][0][0] == group[0][0]:
            merged[-1] += group
        else:
            merged.append(group)
    return merged


def _best_configuration(sizes: np.ndarray, prices: np.ndarray, capacity: int) -> tuple[float, np.ndarray]:
    """The multiset of sizes that fits into the capacity and is worth most."""
    most = capacity // int(sizes.min())
    value, choice = np.zeros(capacity + 1), []
    for _ in range(most):  # one more item at most
        better, which = value.copy(), np.full(capacity + 1, -1)
        for k, size in enumerate(sizes):
            worth = np.concatenate([np.full(size, -1.0), value[: capacity + 1 - size] + prices[k]])
            more = worth > better + 1e-12
            better[more], which[more] = worth[more], k
        choice.append(which)
        value = better
    found, room = np.zeros(len(sizes)), capacity
    for which in reversed(choice):
        if which[room] >= 0:
            found[which[room]] += 1
            room -= sizes[which[room]]
    return float(value[capacity]), found


def configurations(sizes: list[int], demand: list[int], capacity: int, rounds: int = 2000) -> list[tuple[np.ndarray, float]]:
    """The linear program of least sequences that cover the demand: configurations (items of each size) and how often each is used.

    Column generation by the revised simplex method from one configuration per size.  Every basis is feasible, so ending early costs
    sequences, never correctness.
    """
    n, size = len(sizes), np.array(sizes)
    columns = np.diag([float(capacity // s) for s in sizes])
    inverse = np.diag(1 / np.diag(columns))
    for _ in range(rounds):
        prices = inverse.sum(axis=0)
        worth, column = _best_configuration(size, np.maximum(prices, 0), capacity)
        column = np.where(prices > 0, column, 0)
        if worth <= 1 + 1e-7:
            break
        amounts, direction = inverse @ np.array(demand, float), inverse @ column
        usable = direction > 1e-9
        if not usable.any():
            break
        ratios = np.where(usable, amounts / np.where(usable, direction, 1), np.inf)
        leaving = int(np.argmin(ratios))
        columns[:, leaving] = column
        inverse = np.linalg.inv(columns)
    amounts = np.linalg.solve(columns, np.array(demand, float))
    return [(columns[:, k].astype(int), float(amounts[k])) for k in range(n) if amounts[k] > 1e-9]


def plan(histogram: dict[int, int], capacity: int = CAPACITY, large: int = LARGE, groups: int = GROUPS) -> Plan:
    """Where pieces of each length go; the histogram has at most `capacity` lengths."""
    made = Plan(capacity)
    grouped = _groups(histogram, capacity // large, groups)
    left = [list(reversed(g)) for g in grouped]  # longest last

    def take(k: int, most: int) -> tuple[int, int]:
        length, count = left[k].pop()
        taken = min(count, most)
        if count > taken:
            left[k].append((length, count - taken))
        return length, taken

    if grouped:
        mix = configurations([g[0][0] for g in grouped], [sum(c for _, c in g) for g in grouped], capacity)
        for items, amount in mix:
            runs = [(made.new(int(amount + 1e-9)), 0)]  # runs of sequences that are filled alike, and how far
            for k in np.repeat(np.arange(len(items)), items):
                filled = []
                for (first, count), offset in runs:
                    while count and left[k]:
                        length, taken = take(k, count)
                        made.put(length, (first, taken), offset)
                        filled.append(((first, taken), offset + length))
                        first, count = first + taken, count - taken
                    if count:
                        filled.append(((first, count), offset))
                runs = filled
            for run, offset in runs:
                made.leave(capacity - offset, run)
    rest = {length: count - made.used[length] for length, count in histogram.items()}
    for length in sorted(rest, reverse=True):
        made.best_fit(length, rest[length])
    return made


# -- placing -------------------------------------------------------------------------


def packed(
    docs: DataFrame, tokenizer_path: str | None = None, capacity: int = CAPACITY, end_id: int = END_ID, keep_ids: bool = False
) -> DataFrame:
    """Every piece with its sequence: doc_id, piece, start, length, ids_crc32, sequence_id, offset, and ids if they are kept."""
    cut = pieces(docs, tokenizer_path or public_path("word_bpe_49k.json"), capacity, end_id, keep_ids)
    counts = store(cut.groupBy("length", "_part").agg(F.count("*").alias("n")), "piece_counts")
    histogram = {r["length"]: r["n"] for r in counts.groupBy("length").agg(F.sum("n").alias("n")).collect()}  # at most `capacity` rows
    made = plan(histogram, capacity)
    earlier = Window.partitionBy("length").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    before = counts.select("length", "_part", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("_before"))
    ranked = cut.join(before, ["length", "_part"]).withColumn("_rank", F.col("_before") + F.col("_nth"))
    return _placed(ranked, made)


def _placed(ranked: DataFrame, made: Plan) -> DataFrame:
    """Looks entries up; the plan, bounded by the number of lengths, travels to the tasks."""
    entries = np.array(sorted(made.entries), np.int64).reshape(-1, 5)
    sent = ranked.sparkSession.sparkContext.broadcast(entries)
    given = [c for c in ("doc_id", "piece", "start", "length", "ids_crc32", "ids") if c in ranked.columns]

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = sent.value
        starts = np.rec.fromarrays([table[:, 0], table[:, 1]])
        for batch in batches:
            wanted = np.rec.fromarrays([batch.column(c).to_numpy() for c in ("length", "_rank")])
            k = np.searchsorted(starts, wanted, side="right") - 1
            sequence = table[k, 3] + wanted.f1 - table[k, 1]
            columns = {c: batch.column(c) for c in given}
            yield pa.RecordBatch.from_pydict(columns | {"sequence_id": pa.array(sequence), "offset": pa.array(table[k, 4])})

    kept = ", ".join(f"{c} {ranked.schema[c].dataType.simpleString()}" for c in given)
    return ranked.select(*given, "_rank").mapInArrow(place, f"{kept}, sequence_id long, offset long")
