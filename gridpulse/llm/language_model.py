"""Hierarchical Pitman-Yor language model, sampled by Gibbs in parallel.

The next word's restaurant is that of the whole word before; its parent that of this word's last two bytes; theirs that of the last byte alone;
above it one of all words, and there all words are alike.  (The endings tell language and part of speech where a pair of words is new.)
A word's customers sit at tables; every table sends one customer to the parent restaurant.
Gibbs sweeps take the customers of a dish out of their restaurant and seat them again, one by one while they are few and in runs of a sixteenth of those
seated when many, by the Chinese restaurant rule: an old table as it has customers less the discount, a new one as the parent likes the dish.
Probabilities are averaged over the sweeps after the first.

How it is dealt out: a dish lives with its word.  All restaurants' dishes of one word share a bucket, so customers sent to a parent stay in the
task.  What restaurants need to know of other words are table totals.  Those of the endings are at most 65,793 numbers, summed after each sweep and
sent to the next.  Those of whole words grow with the corpus and stay distributed: shards of contexts add up what the buckets report, and answer every
bucket for the contexts that it has.  A context, however hot, is one number per bucket there.
Each sweep's seats and totals are written tables, so a lost executor repeats one sweep of its buckets; sweeps are seeded.

Texts are read once, into chunks of about `CHUNK_TOKENS` tokens stored in the shared folder.  A chunk asks the buckets for each of its distinct (word,
word before) pairs once, and is answered in the same order.  No token is shuffled alone, and no word's tokens meet in one task; its distinct contexts do.

A context is 32 bits of the word's hash and its ending; two words of one ending share a restaurant once in four billion pairs.
"""

from __future__ import annotations

import math
import pickle
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from gridpulse.llm.memory import give_back, given_back
from gridpulse.llm.texts import store_bucketed
from gridpulse.llm.words import LOWER, mix, slices, word_hashes, words
from gridpulse.workspace import new_path, store

CHUNK_TOKENS = 1 << 21
#: Characters of text per bucket of words: the memory of a task, whatever the corpus.
BUCKET_CHARS = 8_000_000
SWEEPS, BURN_IN = 4, 1
#: Strength of every restaurant; discounts are estimated.
THETA = 1.0
#: Restaurants of the levels above the word's own: two bytes, one byte, none.
ENDINGS = (1 << 16, 1 << 8, 1)
LEVELS = 1 + len(ENDINGS)
END = mix(np.uint64([0xE0D]))[0]
#: The context of a text's first word; its ending is 0.
START = np.uint64(0xFFFFFFFF0000)
#: Instead of a shard: a bucket's seats, its totals by ending; instead of a bucket: who has which contexts of a shard.
SEATS, TOTALS, PLAN = -1, -2, -1
PARTS = "bucket int, shard int, payload binary"
SMOOTHING = 0.1


def _steps(x: np.ndarray) -> np.ndarray:
    """Differences of neighbours, which pack better than ascending numbers; `np.cumsum` undoes it."""
    return np.diff(x, prepend=x.dtype.type(0))


def _pack(**values) -> bytes:
    """Values for one row.  Numbers are laid out byte by byte, first bytes first, as their high bytes are much alike."""
    flat = {}
    for name, x in values.items():
        planes = isinstance(x, np.ndarray) and x.ndim == 1 and x.dtype.itemsize > 1
        flat[name] = (x.dtype.str, x.view(np.uint8).reshape(len(x), x.dtype.itemsize).T.tobytes()) if planes else x
    return zstandard.compress(pickle.dumps(flat, protocol=5), 1)


def _unpack(packed: bytes) -> dict:
    values = pickle.loads(zstandard.decompress(packed))
    for name, x in values.items():
        if isinstance(x, tuple):
            kind = np.dtype(x[0])
            values[name] = np.frombuffer(x[1], np.uint8).reshape(kind.itemsize, -1).T.copy().view(kind).ravel()
    return values


def _rounded(x: np.ndarray) -> np.ndarray:
    """Numbers with 16 bits behind the first, which pack better."""
    return ((x.astype(np.float32).view(np.int32) + 64) & ~127).view(np.float32)


def learnable(doc_id) -> F.Column:
    """Documents that the model learns from: crc32 of the id as text is no multiple of ten; null ids are held out."""
    return F.coalesce(F.crc32(F.encode(doc_id.cast("string"), "utf-8")) % 10 != 0, F.lit(False))


# --- texts to chunks ---------------------------------------------------------------------------------------------


def _tokens(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, word hash, context) of all tokens of a slice: A-Z lower-cased words, then the end."""
    lowered = LOWER[data]
    begin, end, bounds = words(lowered, offsets)
    n = len(offsets) - 1
    hashes = word_hashes(lowered, begin, end)
    ending = lowered[end - 1].astype(np.uint64) if len(end) else np.empty(0, np.uint64)
    long = end - begin > 1
    ending[long] |= lowered[end[long] - 2].astype(np.uint64) << np.uint64(8)
    word = np.full(len(begin) + n, END, np.uint64)
    context = np.full(len(begin) + n, START, np.uint64)
    at = np.arange(len(begin)) + np.repeat(np.arange(n), np.diff(bounds))
    word[at] = hashes
    context[at + 1] = (hashes >> np.uint64(32) << np.uint64(16)) | ending
    return np.repeat(np.arange(n), np.diff(bounds) + 1), word, context


def _numbered(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct values, and of each value its number among them, in half the memory."""
    distinct, which = np.unique(values, return_inverse=True)
    return distinct, which.astype(np.int32)


def _chunk_rows(chunk: int, ids: list, held: np.ndarray, pieces: list[tuple], buckets: int) -> pa.RecordBatch:
    """Rows of one chunk: its requests by bucket, and (bucket -1) its documents and which of them have which dish how often.

    `pieces` (documents, words, contexts) is emptied: a chunk's numbers are held once, and no longer than they are needed.
    """
    doc, word, context = map(np.concatenate, zip(*pieces))
    pieces.clear()
    known, which = _numbered(word)
    del word
    # a context follows from the word before, so only distinct words' contexts are sorted
    first = context == START
    of_word = np.zeros(len(known), np.uint64)
    of_word[which[:-1][~first[1:]]] = context[1:][~first[1:]]
    contexts, place = np.unique(np.r_[of_word, START], return_inverse=True)
    del context, of_word
    dish = np.roll(place.astype(np.int64)[which], 1)
    dish[first] = place[-1]
    dish += which.astype(np.int64) * len(contexts)
    del which, first
    dishes, dish = _numbered(dish)
    keys = (dish.astype(np.uint64) << np.uint64(24)) | doc
    del dish
    keys.sort()
    doc = (keys & np.uint64(0xFFFFFF)).astype(np.uint32)
    keys >>= np.uint64(24)
    heads = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]])
    tokens = np.diff(np.r_[heads, len(keys)]).astype(np.int32)
    del keys
    learned = np.add.reduceat((~held[doc]).astype(np.int32), heads)
    dish_word, dish_context = dishes // len(contexts), dishes % len(contexts)
    # the words are sorted by hash, so those of a bucket stand together
    bucket = ((known >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32)).astype(np.int64)[dish_word]
    edges = np.r_[0, np.flatnonzero(np.diff(bucket)) + 1, len(bucket)]
    out_bucket, payload = [-1], [_pack(ids=ids, held=held, tokens=tokens, doc=doc)]
    for a, b in zip(edges[:-1], edges[1:]):
        own, index = np.unique(dish_word[a:b], return_inverse=True)
        near, place = np.unique(dish_context[a:b], return_inverse=True)
        out_bucket.append(int(bucket[a]))
        asked = {"contexts": _steps(contexts[near]), "context": place.astype(np.int32), "learned": learned[a:b]}
        payload.append(_pack(words=_steps(known[own]), counts=np.bincount(index).astype(np.int32), **asked))
    return pa.RecordBatch.from_arrays([pa.array([chunk] * len(payload), pa.int64()), pa.array(out_bucket, pa.int32()), pa.array(payload, pa.binary())], ["chunk", "bucket", "payload"])


def chunks(docs: DataFrame, buckets: int) -> DataFrame:
    """(chunk, bucket, payload) of documents (doc_id, text, held)."""

    def batches(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, seq = TaskContext.get().partitionId(), 0
        ids, held, pieces, waiting = [], [], [], 0
        for batch in rows:
            all_ids, all_held = batch.column(0).to_pylist(), batch.column(2).to_pylist()
            for first, data, offsets in slices(batch.column(1)):
                doc, word, context = _tokens(data, offsets)
                n = len(offsets) - 1
                pieces.append(((doc + len(ids)).astype(np.uint32), word, context))
                ids += all_ids[first : first + n]
                held += all_held[first : first + n]
                waiting += len(word)
                if waiting >= CHUNK_TOKENS:
                    yield _chunk_rows(part << 32 | seq, ids, np.array(held), pieces, buckets)
                    ids, held, waiting, seq = [], [], 0, seq + 1
        if ids:
            yield _chunk_rows(part << 32 | seq, ids, np.array(held), pieces, buckets)

    return docs.select("doc_id", "text", "held").mapInArrow(given_back(batches), "chunk long, bucket int, payload binary")


def _store_chunks(rows: DataFrame) -> tuple[DataFrame, DataFrame, str]:
    """The chunks' documents and their requests, stored in one pass, and the folder of the requests alone."""
    path = new_path(rows.sparkSession, "lm_chunks")
    marked = rows.withColumn("part", F.when(F.col("bucket") < 0, "documents").otherwise("requests"))
    marked.write.partitionBy("part").parquet(path)
    stored = rows.sparkSession.read.schema(marked.schema).parquet(path)
    parts = [stored.where(F.col("part") == k).drop("part") for k in ("documents", "requests")]
    return *parts, f"{path}/part=requests"


def _delete(spark: SparkSession, path: str) -> None:
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)


# --- buckets of words ---------------------------------------------------------------------------------------------


def _merge(table: pa.Table) -> pa.Table:
    """All chunks' requests of one bucket as one table of dishes, and for each chunk which dishes it asked for."""
    asked = [(c, _unpack(p)) for c, p in sorted(zip(table["chunk"].to_pylist(), table["payload"].to_pylist()))]
    word = np.concatenate([np.repeat(np.cumsum(a["words"]), a["counts"]) for _, a in asked])
    known, which = np.unique(word, return_inverse=True)
    contexts, place = np.unique(np.concatenate([np.cumsum(a["contexts"]) for _, a in asked]), return_inverse=True)
    before = np.cumsum([0, *(len(a["contexts"]) for _, a in asked)])
    context = np.concatenate([place[a["context"] + first] for (_, a), first in zip(asked, before)])
    learned = np.concatenate([a["learned"] for _, a in asked])
    dishes, index = np.unique(which * len(contexts) + context, return_inverse=True)
    count = np.bincount(index, weights=learned).astype(np.int64)
    sizes = np.cumsum([len(a["context"]) for _, a in asked])[:-1]
    answers = {str(c): _steps(i.astype(np.int32)) for (c, _), i in zip(asked, np.split(index, sizes))}
    packed = _pack(word=_steps((dishes // len(contexts)).astype(np.int32)), context=(dishes % len(contexts)).astype(np.int32), count=count, contexts=_steps(contexts))
    return pa.table({"bucket": table["bucket"][:1], "dishes": pa.array([packed], pa.binary()), "asked": pa.array([_pack(**answers)], pa.binary())})


def seat(customers: np.ndarray, others: np.ndarray, parent: np.ndarray, discount: float, rng: np.random.Generator) -> np.ndarray:
    """Tables of each dish after its customers were seated anew; others: the restaurant's tables of other dishes, parent: the
    parent's probability of the dish."""
    tables = np.minimum(customers, 1)
    active = np.flatnonzero(customers > 1)
    seated = 1
    while len(active):
        run = max(1, seated // 16)
        t = tables[active]
        new = (THETA + discount * (others[active] + t)) * parent[active]
        chance = new / (new + seated - discount * t)
        if run == 1:
            tables[active] = t + (rng.random(len(active)) < chance)
        else:
            tables[active] = t + rng.binomial(np.minimum(run, customers[active] - seated), chance)
        seated += run
        active = active[customers[active] > seated]
    return tables


class Dishes:
    """The dishes of one bucket at all levels: (word, word before), (word, two bytes), (word, one byte), (word)."""

    def __init__(self, bucket: int, packed: bytes):
        d = _unpack(packed)
        word = np.cumsum(d["word"])
        self.bucket, self.contexts = bucket, np.cumsum(d["contexts"])
        ending = (self.contexts & np.uint64(0xFFFF)).astype(np.int64)
        self.place = [d["context"]]
        self.up, keys = [], word << 16 | ending[d["context"]]
        for bits in (16, 8, 0):
            dishes, up = np.unique(keys, return_inverse=True)
            self.up.append(up)
            self.place.append((dishes & ((1 << bits) - 1)).astype(np.int32))
            narrower = max(bits - 8, 0)
            keys = (dishes >> bits) << narrower | (dishes & ((1 << narrower) - 1))
        self.n_words = len(self.place[-1])
        self.customers = [d["count"], None, None, None]
        self.tables = [np.minimum(d["count"], 1), None, None, None]
        for level in range(1, LEVELS):
            self._send(level)
            self.tables[level] = np.minimum(self.customers[level], 1)
        self.word_of = self.up[2][self.up[1][self.up[0]]]
        self.of_word = np.bincount(self.word_of, weights=d["count"], minlength=self.n_words).astype(np.int64)

    def _send(self, level: int) -> None:
        self.customers[level] = np.bincount(self.up[level - 1], weights=self.tables[level - 1], minlength=len(self.place[level])).astype(np.int64)

    def seated(self, tables: list[np.ndarray]) -> Dishes:
        """The same dishes with the tables of an earlier sweep."""
        self.tables = tables
        for level in range(1, LEVELS):
            self._send(level)
        return self

    def by_context(self, values: np.ndarray) -> np.ndarray:
        return np.bincount(self.place[0], weights=values, minlength=len(self.contexts)).astype(np.int64)

    def totals(self) -> dict:
        """What all buckets must know: tables by ending and level, customers of the two-byte endings, known words, tokens, once and twice seen dishes."""
        by_place = [np.bincount(p, weights=t, minlength=n) for p, t, n in zip(self.place[1:], self.tables[1:], ENDINGS)]
        seen = [[float((c == k).sum()) for k in (1, 2)] for c in self.customers]
        return {
            "tables": by_place, "customers": np.bincount(self.place[1], weights=self.customers[1], minlength=ENDINGS[0]),
            "words": float((self.of_word > 0).sum()), "tokens": float(self.customers[0].sum()), "seen": np.array(seen),
        }

    def likes(self, model: dict) -> list[np.ndarray]:
        """Probabilities of every dish, by level, given the totals."""
        p = np.full(self.n_words, 1.0 / (model["words"] + 1))
        out: list[np.ndarray] = [None] * LEVELS
        for level in reversed(range(LEVELS)):
            p = p[self.up[level]] if level < LEVELS - 1 else p
            d, at = model["discounts"][level], self.place[level]
            kept = self.customers[level] - d * self.tables[level] + (THETA + d * model["tables"][level][at]) * p
            p = out[level] = kept / (THETA + model["present"][level][at])
        return out

    def sweep(self, model: dict, number: int) -> None:
        """Seat every dish of the bucket again, lowest restaurants first."""
        rng = np.random.default_rng([number, self.bucket])
        likes = self.likes(model)
        above = [p[up] for p, up in zip(likes[1:], self.up)] + [np.full(self.n_words, 1.0 / (model["words"] + 1))]
        for level in range(LEVELS):
            if level:
                self._send(level)
            others = model["tables"][level][self.place[level]] - self.tables[level]
            self.tables[level] = seat(self.customers[level], np.maximum(others, 0), above[level], model["discounts"][level], rng)


# --- totals ---------------------------------------------------------------------------------------------------------


def _total_rows(totals: dict) -> pa.RecordBatch:
    """Totals as rows (level, place, tables, customers) without zeros; level 0 has the scalars in `tables`."""
    scalars = np.r_[totals["words"], totals["tokens"], totals["seen"].ravel()]
    parts = []
    for level, tables in enumerate([scalars, *totals["tables"]]):
        customers = totals["customers"] if level == 1 else np.zeros(len(tables))
        at = np.flatnonzero((tables != 0) | (customers != 0))
        parts.append((np.full(len(at), level, np.int32), at.astype(np.int32), tables[at].astype(np.float64), customers[at].astype(np.float64)))
    return pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in zip(*parts)], ["level", "place", "tables", "customers"])


def _model(level: np.ndarray, place: np.ndarray, tables: np.ndarray, customers: np.ndarray, discounts: np.ndarray | None) -> dict:
    """Summed totals of all buckets as what a sweep needs; those of whole words (level 0) differ by bucket and are missing here."""

    def vector(k: int, n: int, values: np.ndarray) -> np.ndarray:
        return np.bincount(place[level == k], weights=values[level == k], minlength=n)

    by_place = [vector(k, n, tables) for k, n in enumerate(ENDINGS, 1)]
    present = [vector(1, ENDINGS[0], customers), by_place[0].reshape(-1, 256).sum(axis=0), by_place[1].sum(keepdims=True)]
    words_, tokens, *seen = vector(0, 2 + 2 * LEVELS, tables)
    if discounts is None:
        once, twice = np.array(seen).reshape(LEVELS, 2).T
        discounts = np.clip(once / np.maximum(once + 2 * twice, 1), 0.05, 0.95)
    return {"tables": [None, *by_place], "present": [None, *present], "words": words_, "discounts": discounts, "tokens": tokens}


def _local(model: dict, tables: np.ndarray, present: np.ndarray) -> dict:
    """The model with the totals of one bucket's contexts."""
    return {**model, "tables": [tables, *model["tables"][1:]], "present": [present, *model["present"][1:]]}


def _summed(parts: DataFrame, discounts: np.ndarray | None) -> dict:
    """The totals of all buckets by ending, of which there are at most 65,793, summed by Spark."""

    def batches(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in rows:
            for packed in batch.column(0).to_pylist():
                yield _total_rows(_unpack(packed))

    rows = parts.where(F.col("shard") == TOTALS).select("payload").mapInArrow(batches, "level int, place int, tables double, customers double")
    summed = rows.groupBy("level", "place").agg(F.sum("tables").alias("tables"), F.sum("customers").alias("customers")).toArrow()
    return _model(*(summed[c].to_numpy() for c in ("level", "place", "tables", "customers")), discounts)


def _table(rows: list[tuple[int, int, bytes]]) -> pa.Table:
    bucket, shard, payload = zip(*rows) if rows else ((), (), ())
    return pa.table({"bucket": pa.array(bucket, pa.int32()), "shard": pa.array(shard, pa.int32()), "payload": pa.array(payload, pa.binary())})


def _reports(dishes: Dishes, number: int, shards: int) -> list[tuple[int, int, bytes]]:
    """What a bucket writes after a sweep: its seats, its totals by ending, and for each shard the tables in the contexts it has there."""
    rows = [(dishes.bucket, SEATS, _pack(number=number, **{f"tables{k}": t.astype(np.int32) for k, t in enumerate(dishes.tables)})), (dishes.bucket, TOTALS, _pack(**dishes.totals()))]
    shard = ((dishes.contexts >> np.uint64(16)) * np.uint64(shards) >> np.uint64(32)).astype(np.int64)
    edges = np.r_[0, np.flatnonzero(np.diff(shard)) + 1, len(shard)]
    tables, customers = dishes.by_context(dishes.tables[0]), dishes.by_context(dishes.customers[0])
    for a, b in zip(edges[:-1], edges[1:]):
        first = {"contexts": _steps(dishes.contexts[a:b]), "customers": customers[a:b]} if not number else {}
        rows.append((dishes.bucket, int(shard[a]), _pack(tables=tables[a:b], **first)))
    return rows


def _plan(table: pa.Table) -> pa.Table:
    """One shard's first round: which of its contexts each bucket has, and every bucket's answers, customers among them."""
    shard = table["shard"][0].as_py()
    own = sorted((b, _unpack(p)) for b, p in zip(table["bucket"].to_pylist(), table["payload"].to_pylist()))
    contexts, index = np.unique(np.concatenate([np.cumsum(r["contexts"]) for _, r in own]), return_inverse=True)
    parts = np.split(index, np.cumsum([len(r["contexts"]) for _, r in own])[:-1])
    tables, customers = (np.bincount(index, weights=np.concatenate([r[k] for _, r in own])).astype(np.int64) for k in ("tables", "customers"))
    rows = [(PLAN, shard, _pack(contexts=len(contexts), **{str(b): _steps(i.astype(np.int32)) for (b, _), i in zip(own, parts)}))]
    rows += [(b, shard, _pack(number=0, tables=tables[i], present=customers[i])) for (b, _), i in zip(own, parts)]
    return _table(rows)


def _shard_replies(number: int):
    """Later rounds: the summed tables of the shard's contexts, to every bucket those that it has."""

    def reply(table: pa.Table) -> pa.Table:
        shard = table["shard"][0].as_py()
        own = {b: _unpack(p) for b, p in zip(table["bucket"].to_pylist(), table["payload"].to_pylist())}
        plan = own.pop(PLAN)
        tables = np.zeros(plan.pop("contexts"), np.int64)
        parts = {int(b): np.cumsum(i) for b, i in plan.items()}
        for b, i in parts.items():
            tables[i] += own[b]["tables"]  # a bucket has a context once
        return _table([(b, shard, _pack(number=number, tables=tables[i])) for b, i in parts.items()])

    return reply


def _told(parts: pa.Table) -> tuple[np.ndarray, dict[int, np.ndarray], dict[int, list[np.ndarray]]]:
    """What a bucket is told: customers by context, tables by context and seats by sweep."""
    rows = sorted(((s, _unpack(p)) for s, p in zip(parts["shard"].to_pylist(), parts["payload"].to_pylist())), key=lambda r: (r[0], r[1]["number"]))
    seats = {r["number"]: [r[f"tables{k}"] for k in range(LEVELS)] for s, r in rows if s == SEATS}
    answers = [r for s, r in rows if s >= 0]
    tables = {k: np.concatenate([r["tables"] for r in answers if r["number"] == k]) for k in {r["number"] for r in answers}}
    return np.concatenate([r["present"] for r in answers if "present" in r]), tables, seats


def _first_reports(buckets: DataFrame, shards: int) -> DataFrame:
    def batches(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in rows:
            for bucket, packed in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                yield from _table(_reports(Dishes(bucket, packed), 0, shards)).to_batches()

    return buckets.select("bucket", "dishes").mapInArrow(batches, PARTS)


def _sweep(buckets: DataFrame, told: DataFrame, model: dict, number: int, shards: int) -> DataFrame:
    """Reports of all buckets after sweep `number` (from 1)."""

    def swept(dishes: pa.Table, parts: pa.Table) -> pa.Table:
        present, tables, seats = _told(parts)
        own = Dishes(dishes["bucket"][0].as_py(), dishes["dishes"][0].as_py()).seated(seats[number - 1])
        own.sweep(_local(model, tables[number - 1], present), number)
        return _table(_reports(own, number, shards))

    return buckets.select("bucket", "dishes").groupBy("bucket").cogroup(told.groupBy("bucket")).applyInArrow(swept, PARTS)


def _answers(buckets: DataFrame, told: DataFrame, history: list[dict]) -> DataFrame:
    """(chunk, bucket, payload): log10 of the averaged probability, and the word's count, of every dish that a chunk asked for."""

    def answer(dishes: pa.Table, parts: pa.Table) -> pa.Table:
        present, tables, seats = _told(parts)
        bucket = dishes["bucket"][0].as_py()
        own = Dishes(bucket, dishes["dishes"][0].as_py())
        kept = range(BURN_IN + 1, len(history))
        mean = sum(own.seated(seats[k]).likes(_local(history[k], tables[k], present))[0] for k in kept) / len(kept)
        log, count = _rounded(np.log10(mean)), own.of_word[own.word_of]
        asked = [(int(c), np.cumsum(i)) for c, i in _unpack(dishes["asked"][0].as_py()).items()]
        payload = [_pack(log=log[i], count=count[i]) for _, i in asked]
        return pa.table({"chunk": pa.array([c for c, _ in asked], pa.int64()), "bucket": pa.array([bucket] * len(asked), pa.int32()), "payload": pa.array(payload, pa.binary())})

    return buckets.groupBy("bucket").cogroup(told.groupBy("bucket")).applyInArrow(answer, "chunk long, bucket int, payload binary")


def scores(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score.

    Null texts count as empty: their only token is the end.  Words that no learnable document has share one
    unknown word's probability.  With nothing to learn from, all words are unknown.
    """
    kind = docs.schema["doc_id"].dataType
    schema = f"doc_id {kind.simpleString()}, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"
    marked = docs.select("doc_id", "text", (~learnable(F.col("doc_id"))).alias("held"))
    chars = docs.agg(F.sum(F.length("text"))).first()[0] or 0
    shards = max(1, math.ceil(chars / BUCKET_CHARS))
    stored, requests, requests_folder = _store_chunks(chunks(marked, shards))
    merged = requests.groupBy("bucket").applyInArrow(_merge, "bucket int, dishes binary, asked binary")
    # grouping has dealt the buckets to tasks as the table does, so each of its files is written by one task
    buckets = store_bucketed(merged, ["bucket"], int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), "lm_buckets")
    _delete(docs.sparkSession, requests_folder)  # all of them are in the buckets' table now
    if buckets.isEmpty():
        return docs.sparkSession.createDataFrame([], schema)
    reports = store(_first_reports(buckets, shards), "lm_reports")
    history = [_summed(reports, None)]
    replies = store(reports.where("shard >= 0").groupBy("shard").applyInArrow(_plan, PARTS), "lm_contexts")
    plan, customers = replies.where(F.col("bucket") == PLAN), replies.where(F.col("bucket") != PLAN)
    told = customers
    seen = []
    for number in range(1, SWEEPS + 1):
        seats = reports.where(F.col("shard") == SEATS)
        reports = store(_sweep(buckets, told.unionByName(seats), history[-1], number, shards), "lm_reports")
        history.append(_summed(reports, history[0]["discounts"]))
        tables = plan.unionByName(reports.where("shard >= 0"))
        tables = store(tables.groupBy("shard").applyInArrow(_shard_replies(number), PARTS), "lm_contexts")
        told = customers.unionByName(tables)
        if number > BURN_IN:
            seen += [tables, reports.where(F.col("shard") == SEATS)]
    tokens, types = float(history[0]["tokens"]), float(history[0]["words"])

    def score(chunk: pa.Table, replies: pa.Table) -> pa.Table:
        own = _unpack(chunk["payload"][0].as_py())
        parts = [_unpack(p) for _, p in sorted(zip(replies["bucket"].to_pylist(), replies["payload"].to_pylist()))]
        log, count = (np.repeat(np.concatenate([p[k] for p in parts]), own["tokens"]) for k in ("log", "count"))
        n = len(own["ids"])
        base = np.log10((count + SMOOTHING) / (tokens + SMOOTHING * (types + 1)))
        columns = {
            "doc_id": pa.array(own["ids"], docs_type), "held_out": pa.array(own["held"]),
            "n_tokens": pa.array(np.bincount(own["doc"], minlength=n)), "n_known": pa.array(np.bincount(own["doc"], weights=count > 0, minlength=n).astype(np.int64)),
            "train_tokens": pa.array(np.full(n, int(tokens))), "base_score": pa.array(np.bincount(own["doc"], weights=base, minlength=n)),
            "score": pa.array(np.bincount(own["doc"], weights=log.astype(np.float64), minlength=n)),
        }
        return pa.table(columns)

    docs_type = to_arrow_type(kind)
    own = stored.groupBy("chunk")
    answers = _answers(buckets, reduce(DataFrame.unionByName, seen, customers), history)
    return own.cogroup(answers.groupBy("chunk")).applyInArrow(score, schema)
