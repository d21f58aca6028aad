"""MinHash near-duplicates, verified with odd sketches and then on full sets.

Every distinct text gets `BANDS * ROWS` MinHash samples of its shingles.  Bands of samples make candidates; the same samples, folded into a
parity bitmap (an odd sketch), tell how similar two candidates are: the bits that differ count the samples that do.  At high
similarity few bits collide, so the estimate is sharp there and costs eight XORs.  Pairs that pass are confirmed by intersecting their full sets.

Linked are texts with Jaccard similarity of at least `SIMILARITY` percent; a group is whatever links connect.

* First, each text is confirmed with its most similar candidate among the heads (smallest ids) of its buckets: one pair
  per text, which joins most of a group, however large, without forming its pairs.
* Then buckets that still hold texts of several groups are compared within, in blocks of at most `BLOCK` texts: by sketches, then, for those that
  passed, by full sets; links that join nothing new are neither checked nor returned, so a bucket returns fewer links than it has texts.

No candidate is capped or dropped.  Two texts at the threshold share no band with probability (1 - 0.8^ROWS)^BANDS, below 1e-7; the sketch test
loses fewer than one in 1e8 of them.  Copies are one text from the start; texts without shingles are linked with nothing.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridpulse.llm.memory import given_back
from gridpulse.llm.texts import KEYS, owners, store_distinct, text_keys, with_texts
from gridpulse.llm.words import LOWER, WORDS_BASE, mix, ranges, slices, windows, word_hashes, words
from gridpulse.workspace import store

SIMILARITY = 80
BANDS, ROWS = 32, 4
SKETCH_BITS = 512
#: Bits that may differ: what 54 of the 128 samples at odds give, where the threshold makes 26 likely.
MOST_BITS = 88
BLOCK = 2048
#: Pairs of rows whose sketches are compared at once.
PAIRS = 1 << 16
SIZES = "n_shingles long"


def shingles(data: np.ndarray, offsets: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """(text, hash) of the distinct shingles of each text, sorted; texts of fewer words have one, of all their words."""
    lowered = LOWER[data]
    begin, end, bounds = words(lowered, offsets)
    values = word_hashes(lowered, begin, end)
    starts, hashes = windows(values, WORDS_BASE, bounds, size)
    text = np.searchsorted(bounds, starts, side="right") - 1
    counts = np.diff(bounds)
    for n in range(1, size):
        few = np.flatnonzero(counts == n)
        if len(few):
            at = bounds[few]
            total = values[at]
            for k in range(1, n):
                total = mix(total * np.uint64(3) + values[at + k])
            text, hashes = np.r_[text, few], np.r_[hashes, mix(total + np.uint64(n))]
    order = np.lexsort((hashes, text))
    text, hashes = text[order], hashes[order]
    new = np.ones(len(text), bool)
    new[1:] = (np.diff(text) != 0) | (hashes[1:] != hashes[:-1])
    return text[new], hashes[new]


def _signatures(text: np.ndarray, hashes: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Set sizes, band hashes (n, BANDS) and odd sketches (n, SKETCH_BITS / 64); rows of texts without shingles are zero."""
    sizes = np.bincount(text, minlength=n)
    full = np.flatnonzero(sizes)
    bands = np.zeros((n, BANDS), np.uint64)
    bits = np.zeros((n, SKETCH_BITS), bool)
    if len(full):
        heads = np.flatnonzero(np.r_[True, np.diff(text) != 0])
        multipliers = mix(np.arange(BANDS * ROWS, dtype=np.uint64)) | np.uint64(1)
        for k, a in enumerate(multipliers):
            least = mix(np.minimum.reduceat(hashes * a, heads) + np.uint64(k))
            bits[full, (least >> np.uint64(55)).astype(np.int64)] ^= True
            bands[full, k // ROWS] = mix(bands[full, k // ROWS] ^ least)
    return sizes, bands, np.packbits(bits, axis=1, bitorder="little").view(np.uint64)


def _lists(rows: np.ndarray) -> pa.Array:
    width = rows.shape[1]
    return pa.ListArray.from_arrays(pa.array(np.arange(0, rows.size + 1, width, dtype=np.int32)), pa.array(rows.ravel().view(np.int64)))


def signatures(texts: DataFrame, size: int) -> DataFrame:
    """(id, n_shingles, bands, sketch) of each text."""

    def batches(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in rows:
            for first, data, offsets in slices(batch.column(0)):
                n = len(offsets) - 1
                sizes, bands, sketch = _signatures(*shingles(data, offsets, size), n)
                ids = batch.column(1).slice(first, n)
                yield pa.RecordBatch.from_arrays([ids, pa.array(sizes), _lists(bands), _lists(sketch)], ["id", "n_shingles", "bands", "sketch"])

    return texts.select("text", "id").mapInArrow(given_back(batches), f"id long, {SIZES}, bands array<long>, sketch array<long>")


def _full_sets(texts: DataFrame, size: int) -> DataFrame:
    """(id, set): all shingle hashes of each text."""

    def batches(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in rows:
            for first, data, offsets in slices(batch.column(0)):
                n = len(offsets) - 1
                text, hashes = shingles(data, offsets, size)
                ends = np.searchsorted(text, np.arange(n + 1)).astype(np.int32)
                sets = pa.ListArray.from_arrays(pa.array(ends), pa.array(hashes.view(np.int64)))
                yield pa.RecordBatch.from_arrays([batch.column(1).slice(first, n), sets], ["id", "set"])

    return texts.select("text", "id").mapInArrow(given_back(batches), "id long, set array<long>")


def _bits_apart(a: Column, b: Column) -> Column:
    return sum((F.bit_count(F.get(a, F.lit(k)).bitwiseXOR(F.get(b, F.lit(k)))) for k in range(SKETCH_BITS // 64)), F.lit(0))


def components(links: DataFrame) -> DataFrame:
    """(id, label): the smallest id that links (a, b) connect each linked id with.

    Labels spread along links and jump along labels, so the rounds grow with the logarithm of a chain's length.
    """
    edges = store(links.select("a", "b").union(links.select("b", "a")).distinct(), "edges")
    labels = edges.groupBy(F.col("a").alias("id")).agg(F.min("b").alias("label")).select("id", F.least("id", "label").alias("label"))
    while True:
        near = edges.join(labels, edges["b"] == labels["id"]).groupBy("a").agg(F.min("label").alias("near"))
        spread = labels.join(near, F.col("id") == F.col("a")).select("id", F.least("label", "near").alias("label"), F.col("label").alias("old"))
        target = spread.select(F.col("id").alias("label"), F.col("label").alias("next"))
        jumped = store(spread.join(target, "label").select("id", F.col("next").alias("label"), (F.col("next") < F.col("old")).alias("changed")), "labels")
        labels = jumped.select("id", "label")
        if jumped.where("changed").isEmpty():
            return labels


def roots(links: DataFrame) -> DataFrame:
    """(id, label): where links (a, b), one for each a and each to a smaller id, lead in the end; ids without a link of their own are left out."""
    labels = links.select(F.col("a").alias("id"), F.col("b").alias("label"))
    while True:
        target = labels.toDF("label", "next")
        jumped = store(labels.join(target, "label", "left").select("id", F.coalesce("next", "label").alias("label"), F.col("next").isNotNull().alias("changed")), "labels")
        labels = jumped.select("id", "label")
        if jumped.where("changed").isEmpty():
            return labels


class _Groups:
    """Union-find over the labels of one block."""

    def __init__(self, labels: np.ndarray):
        self.parent = {int(x): int(x) for x in labels}

    def find(self, x: int) -> int:
        while self.parent[x] != x:
            self.parent[x] = x = self.parent[self.parent[x]]
        return x

    def join(self, x: int, y: int) -> bool:
        x, y = self.find(x), self.find(y)
        self.parent[y] = x
        return x != y


def _whole_groups(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.Table, np.ndarray]]:
    """Rows sorted by (key, i, j), several whole groups at a time, with the end of each row's group."""
    held: list[pa.Table] = []

    def heads(table: pa.Table) -> np.ndarray:
        new = np.zeros(table.num_rows, bool)
        for c in ("key", "i", "j"):
            values = table[c].to_numpy()
            new[1:] |= values[1:] != values[:-1]
        return np.flatnonzero(new)

    def with_ends(table: pa.Table) -> tuple[pa.Table, np.ndarray]:
        bounds = np.r_[0, heads(table), table.num_rows]
        return table, np.repeat(bounds[1:], np.diff(bounds))

    for batch in batches:
        if not batch.num_rows:
            continue
        table = pa.concat_tables([*held, pa.Table.from_batches([batch])])
        last = heads(table)[-1:]
        if len(last):
            yield with_ends(table.slice(0, int(last[0])).combine_chunks())
            table = table.slice(int(last[0]))
        held = [table]
    if held:
        yield with_ends(held[0].combine_chunks())


def _close_pairs(sketches: np.ndarray, sizes: np.ndarray, labels: np.ndarray, ends: np.ndarray, similarity: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs of rows of one group with different labels whose sketches and sizes allow a link, most similar first within a row."""
    partners = ends - np.arange(len(ends)) - 1
    before = np.r_[0, np.cumsum(partners)]
    row = 0
    while row < len(ends):
        stop = max(row + 1, int(np.searchsorted(before, before[row] + PAIRS, side="right")) - 1)
        n = partners[row:stop]
        a = np.repeat(np.arange(row, stop), n)
        b = a + 1 + ranges(n)
        fits = (labels[a] != labels[b]) & (100 * np.minimum(sizes[a], sizes[b]) >= similarity * np.maximum(sizes[a], sizes[b]))
        a, b = a[fits], b[fits]
        apart = np.bitwise_count(sketches[a] ^ sketches[b]).sum(axis=1, dtype=np.int64)
        near = np.flatnonzero(apart <= MOST_BITS)
        near = near[np.lexsort((apart[near], a[near]))]
        yield a[near], b[near]
        row = stop


def _rows(column: pa.ChunkedArray, width: int) -> np.ndarray:
    """A column of lists of `width` numbers."""
    return pc.list_flatten(column).to_numpy().astype(np.int64).view(np.uint64).reshape(-1, width)


def _comparable(table: pa.Table, ends: np.ndarray) -> tuple[np.ndarray, ...]:
    return _rows(table["sketch"], SKETCH_BITS // 64), table["n_shingles"].to_numpy(), table["label"].to_numpy(), ends


def _in_blocks(members: DataFrame) -> DataFrame:
    """Blocks of members one after the other."""
    return _blocks(members).repartition("key", "i", "j").sortWithinPartitions("key", "i", "j")


def _blocks(members: DataFrame) -> DataFrame:
    """Members of a bucket dealt to pairs of blocks (key, i, j), each block of about BLOCK texts or fewer; small buckets are one block."""
    sizes = members.groupBy("key").agg(F.count("*").alias("m"))
    n = F.ceil(F.col("m") / BLOCK).cast("int")
    own = F.pmod(F.xxhash64("id"), n).cast("int")
    dealt = members.join(sizes, "key").withColumns({"n": n, "own": own}).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("n") - 1)))
    return dealt.withColumns({"i": F.least("own", "other"), "j": F.greatest("own", "other")}).drop("m", "n", "own", "other")


def _suspects(members: DataFrame, similarity: int) -> DataFrame:
    """(key, id): members that may be linked with a text of another group in their bucket, by sketches."""

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table, ends in _whole_groups(batches):
            found = np.zeros(table.num_rows, bool)
            for a, b in _close_pairs(*_comparable(table, ends), similarity):
                found[a] = found[b] = True
            yield from table.select(["key", "id"]).filter(pa.array(found)).to_batches()

    return _in_blocks(members).mapInArrow(given_back(compare), "key long, id long").distinct()


def _joining_links(members: DataFrame, similarity: int) -> DataFrame:
    """(a, b): labels of groups that a confirmed link between texts of a bucket joins, none that the others imply.

    A pair that shares several buckets is confirmed in the first of them only.
    """

    def compare(table: pa.Table) -> pa.Table:
        table = table.combine_chunks()
        labels, own = table["label"].to_numpy(), table["pos"][0].as_py()
        bands, sets = _rows(table["bands"], BANDS), pc.list_flatten(table["set"]).to_numpy()
        at = np.r_[0, np.cumsum(pc.list_value_length(table["set"]).to_numpy())]
        groups, links = _Groups(labels), []
        for a, b in _close_pairs(*_comparable(table, np.full(len(labels), len(labels))), similarity):
            first = np.argmax(bands[a] == bands[b], axis=1) == own
            for i, j in zip(a[first].tolist(), b[first].tolist()):
                x, y = int(labels[i]), int(labels[j])
                if groups.find(x) == groups.find(y):
                    continue
                one, other = sets[at[i] : at[i + 1]], sets[at[j] : at[j + 1]]
                shared = len(np.intersect1d(one, other, assume_unique=True))
                if 100 * shared >= similarity * (len(one) + len(other) - shared) and groups.join(x, y):
                    links.append((x, y))
        return pa.table({"a": pa.array([x for x, _ in links], pa.int64()), "b": pa.array([y for _, y in links], pa.int64())})

    return _blocks(members).groupBy("key", "i", "j").applyInArrow(compare, "a long, b long")  # sets lie by key already: no exchange of their own


def linked_groups(texts: DataFrame, size: int, similarity: int) -> tuple[DataFrame, DataFrame]:
    """(id, n_shingles) of all distinct texts, and (id, label) of those in a group of several; others, and its smallest text, may be left out."""
    signed = store(signatures(texts, size), "signatures")
    full = signed.where("n_shingles > 0")
    banded = full.select("id", F.posexplode("bands")).select(F.xxhash64("pos", "col").alias("key"), "pos", "id")
    shared = banded.groupBy("key").agg(F.count("*").alias("m"), F.min("id").alias("head")).where("m > 1").drop("m")
    members = store(banded.join(shared, "key"), "members")

    sketch = full.select("id", "n_shingles", "sketch")
    heads = sketch.toDF("head", "head_n", "head_sketch")
    pairs = members.where("id != head").select("id", "head").distinct().join(sketch, "id").join(heads, "head")
    apart = _bits_apart(F.col("sketch"), F.col("head_sketch"))
    sizes = 100 * F.least("n_shingles", "head_n") >= similarity * F.greatest("n_shingles", "head_n")
    close = pairs.withColumn("apart", apart).where(sizes & (F.col("apart") <= MOST_BITS))
    best = store(close.groupBy("id").agg(F.min_by("head", F.struct("apart", "head")).alias("head")), "best_heads")

    involved = best.select("id").union(best.select("head")).distinct()
    sets = store(_full_sets(with_texts(texts, involved), size), "shingle_sets")
    both = best.join(sets, "id").join(sets.toDF("head", "head_set"), "head")
    inside = F.size(F.array_intersect("set", "head_set"))
    linked = 100 * inside >= similarity * (F.size("set") + F.size("head_set") - inside)
    links = store(both.where(linked).select(F.col("id").alias("a"), F.col("head").alias("b")), "links")

    labels = roots(links)
    labelled = members.select("key", "pos", "id").join(labels, "id", "left").withColumn("label", F.coalesce("label", "id"))
    mixed = labelled.groupBy("key").agg(F.min("label").alias("low"), F.max("label").alias("high")).where("low < high").select("key")
    open_ = store(labelled.join(mixed, "key").join(full.select("id", "n_shingles", "sketch", "bands"), "id"), "open_members")
    suspects = store(_suspects(open_.drop("bands"), similarity), "suspects")
    more_sets = store(_full_sets(with_texts(texts, suspects.select("id").distinct()), size), "shingle_sets")
    more = store(_joining_links(open_.join(suspects, ["key", "id"]).join(more_sets, "id"), similarity), "links")
    if not more.isEmpty():
        merged = components(more)  # of labels, which have no rows in `labels`
        kept = labels.join(merged.toDF("label", "into"), "label", "left").select("id", F.coalesce("into", "label").alias("label"))
        labels = kept.unionByName(merged)
    return signed.select("id", "n_shingles"), labels


def _groups(docs: DataFrame, texts: DataFrame, size: int, similarity: int) -> DataFrame:
    """(key1, key2, n_shingles, component_id) of every distinct text; component_id is the smallest doc_id of its group."""
    sizes, labels = linked_groups(texts, size, similarity)
    named = texts.select("id", *KEYS).join(owners(docs), KEYS).join(sizes, "id").join(labels, "id", "left").withColumn("label", F.coalesce("label", "id"))
    named = store(named.select(*KEYS, "n_shingles", "label", "first_id"), "groups")
    smallest = named.groupBy("label").agg(F.min("first_id").alias("component_id"))
    return named.join(smallest, "label").select(*KEYS, "n_shingles", "component_id")


def _component() -> Column:
    return F.when(F.col("n_shingles") == 0, F.col("doc_id")).otherwise(F.col("component_id"))


def near_duplicates(docs: DataFrame, size: int = 2, similarity: int = SIMILARITY) -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id (smallest doc_id of its group), kept.

    Null ids are in groups, but name them only where no member has an id (component_id is null then, and all such members stay).
    Documents without words are alone.  Repeated rows with the smallest id of a group all stay: they are one document.
    """
    by_text = _groups(docs, store_distinct(docs), size, similarity)
    rows = docs.select("doc_id", *text_keys(F.col("text"))).join(by_text, KEYS)
    named = rows.select("doc_id", "n_shingles", _component().alias("component_id"))
    return named.withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))


def without_near_duplicates(docs: DataFrame, size: int = 5, similarity: int = SIMILARITY) -> DataFrame:
    """The kept document of each group, columns unchanged; the rest of a row is dealt to its stored text."""
    texts = store_distinct(docs)
    by_text = _groups(docs, texts, size, similarity)
    rest = F.struct(*[F.col(c) for c in docs.columns if c != "text"]).alias("rest")
    rows = docs.select("doc_id", rest, F.col("text").isNull().alias("none"), *text_keys(F.col("text"))).join(by_text, KEYS)
    kept = rows.where(F.col("doc_id").eqNullSafe(_component())).select(*KEYS, "rest", "none")
    both = texts.select(*KEYS, "text").join(kept.hint("shuffle_hash"), KEYS)
    text = F.when(~F.col("none"), F.col("text")).alias("text")
    return both.select(*[text if c == "text" else F.col("rest")[c].alias(c) for c in docs.columns])
