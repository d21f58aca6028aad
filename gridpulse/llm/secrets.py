"""Secret scan with multipart credential linking, in DataFrame functions only.

Strong kinds are reported wherever they match: assignments of a secret, access identifiers, long hexadecimal runs.
Weak kinds - account names, bare keys, endpoints - are too common to report by themselves.  A weak candidate counts
only if the parts that would make it a usable credential stand within `SCOPE` code points:

* a bare key needs an access identifier, an account or an endpoint;
* an account needs a secret (assignment, hexadecimal run or bare key);
* an endpoint needs both an identifier and a secret.

Parts that overlap do not complete each other, and a bare key inside an endpoint is a piece of its address: an ordinary link is no credential.

The link is an interval join done by order instead of by pairs: along the starts and ends of a text's parts, the end of the last identifier
(secret, endpoint) that is over, and the start of the next one to come, decide whether one is in scope.  That is linear in the number of
parts, up to a sort, however dense they are.

Scale: matching is one pass over the texts.  Only parts are shuffled, keyed by a 128-bit hash of their text, so that copies of a text,
however many, send each part once per map task and are looked up, not repeated.  A text without parts costs nothing after the scan.

Positions are code points, end exclusive.  Null and empty texts have no parts.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

SCOPE = 300
MASK = "[secret]"

#: Fixed patterns by kind: (kind, pattern, group whose length counts, its least length).
STRONG = (
    ("assign", r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 8),
    ("access", r"AKIA[A-Z0-9]+", 0, 16),
    ("hex", r"[0-9a-f]+", 0, 32),
)
WEAK = (
    ("account", r"""(?i)(?<![a-z0-9_])(user|username|login|account|client_?id|access_?key_?id)["']?\x20*[:=]\x20*["']?([A-Za-z0-9@._-]+)""", 2, 3),
    ("key", r"(?<![A-Za-z0-9+/_=-])(?=[A-Za-z+/_=-]*[0-9])(?=[0-9+/_=-]*[A-Za-z])[A-Za-z0-9+/_=-]{20,}+", 0, 20),
    ("endpoint", r"""(?i)(?:https?|jdbc:[a-z]+|postgres|mysql|mongodb|redis|amqp)://[^\x00-\x20"'<>]+|(?<![a-z0-9_])(?:host|endpoint|server)["']?\x20*[:=]\x20*["']?[a-z0-9.:/_-]+""", 0, 8),
)
KINDS = tuple(k[0] for k in STRONG + WEAK)
#: Patterns that only match where the plain one can succeed, to leave out texts and short runs early.
_QUICK = {"access": r"AKIA[A-Z0-9]{12,}", "hex": r"[0-9a-f]{32,}"}


def _number(kind: str) -> int:
    return KINDS.index(kind)


def _text_key(text: Column) -> list[Column]:
    """128 bits that stand for a text."""
    text = F.coalesce(text, F.lit(""))
    return [F.xxhash64(text).alias("key1"), F.xxhash64(F.lit("secrets"), text).alias("key2")]


def _matches(text: Column) -> Column:
    """Array of (kind, nth, gap, len, size): leftmost matches of all kinds; gap is the text between two matches.

    A run of `[0-9a-f]+` (or of access characters) is long enough exactly if the bounded pattern matches it, at the same place.
    """
    found = []
    for number, (kind, pattern, group, _) in enumerate(STRONG + WEAK):
        p = F.lit(_QUICK.get(kind, pattern))
        gaps = F.split(text, _QUICK.get(kind, pattern), -1)
        whole = F.regexp_extract_all(text, p, F.lit(0))
        value = F.regexp_extract_all(text, p, F.lit(group)) if group else whole
        zipped = F.arrays_zip(F.slice(gaps, 1, F.size(whole)).alias("gap"), whole.alias("whole"), value.alias("value"))
        rows = F.transform(zipped, _row_of(number))
        found.append(F.when(text.rlike(_QUICK.get(kind, pattern)), rows))
    return F.flatten(F.array_compact(F.array(*found)))


def _row_of(number: int) -> Callable[[Column, Column], Column]:
    def row(m: Column, i: Column) -> Column:
        sizes = (F.length(m[c]).alias(n) for c, n in (("gap", "gap"), ("whole", "len"), ("value", "size")))
        return F.struct(F.lit(number).alias("kind"), i.alias("nth"), *sizes)

    return row


def _count(number: int) -> Column:
    return F.size(F.filter("spans", lambda s: s["kind"] == number)).cast("long")


def _parts(docs: DataFrame) -> DataFrame:
    """(key1, key2, kind, start, end) of every match of sufficient length, once per distinct text."""
    matched = docs.select(*_text_key(F.col("text")), F.explode(_matches(F.col("text"))).alias("m")).select("key1", "key2", "m.*")
    single = matched.groupBy("key1", "key2", "kind", "nth").agg(*(F.first(c).alias(c) for c in ("gap", "len", "size")))
    upto = Window.partitionBy("key1", "key2", "kind").orderBy("nth").rowsBetween(Window.unboundedPreceding, 0)
    end = F.sum(F.col("gap") + F.col("len")).over(upto)
    placed = single.repartition("key1", "key2").withColumn("end", end).withColumn("start", F.col("end") - F.col("len"))
    enough = reduce(lambda c, k: c.when(F.col("kind") == k[0], k[1][3]), enumerate(STRONG + WEAK), F.when(F.lit(False), 0))
    return placed.where(F.col("size") >= enough).select("key1", "key2", "kind", "start", "end")


def _near(parts: DataFrame, sought: dict[str, tuple[str, ...]]) -> DataFrame:
    """`parts` with one boolean per entry of `sought`: whether a part of these kinds lies in scope, before or after the row and apart from it.

    Every part is two points, its end and its start.  Along the points of a text, up to a start, the last end of the kinds is that of the nearest part
    that is over by then; downwards, from an end, the last start is that of the nearest part still to come.  Parts that overlap the row are in neither.
    """
    is_end = F.col("_end")
    ahead = Window.partitionBy("key1", "key2").orderBy("_at", F.col("_end").desc()).rowsBetween(Window.unboundedPreceding, 0)
    behind = Window.partitionBy("key1", "key2").orderBy(F.col("_at").desc(), "_end").rowsBetween(Window.unboundedPreceding, 0)
    points = parts.withColumn("_end", F.explode(F.array(F.lit(True), F.lit(False)))).withColumn("_at", F.when(is_end, F.col("end")).otherwise(F.col("start")))
    marks = {}
    for name, kinds in sought.items():
        of_kind = F.col("kind").isin(*map(_number, kinds))
        over = F.max(F.when(of_kind & is_end, F.col("_at"))).over(ahead)
        to_come = F.min(F.when(of_kind & ~is_end, F.col("_at"))).over(behind)
        marks[name] = F.coalesce(F.when(is_end, to_come - F.col("_at")).otherwise(F.col("_at") - over) <= SCOPE, F.lit(False))
    part = ("key1", "key2", "kind", "start", "end")
    return points.withColumns(marks).groupBy(*part).agg(*(F.bool_or(name).alias(name) for name in sought))


def _overlaps(kinds: tuple[str, ...]) -> Column:
    """Whether the row overlaps another part of one of these kinds."""
    of_kind = F.col("kind").isin(*map(_number, kinds))
    ahead = Window.partitionBy("key1", "key2").orderBy("start", "kind").rowsBetween(Window.unboundedPreceding, -1)
    behind = Window.partitionBy("key1", "key2").orderBy(F.col("start").desc(), F.col("kind").desc()).rowsBetween(Window.unboundedPreceding, -1)
    before = F.max(F.when(of_kind, F.col("end"))).over(ahead) > F.col("start")
    after = F.min(F.when(of_kind, F.col("start"))).over(behind) < F.col("end")
    return F.coalesce(before, F.lit(False)) | F.coalesce(after, F.lit(False))


def found_spans(docs: DataFrame) -> DataFrame:
    """(key1, key2, kind, start, end) of all strong parts and of the weak ones that are linked, once per distinct text.

    A weak candidate that overlaps a strong part belongs to it and is left out; so is a bare key inside an endpoint, which is a piece
    of an address.  Parts that overlap never complete each other.
    """
    parts = _parts(docs)
    strong = F.col("kind") < len(STRONG)
    owned = parts.withColumns({"by_strong": _overlaps(tuple(k[0] for k in STRONG)), "by_address": _overlaps(("endpoint",))})
    belongs = (~strong & F.col("by_strong")) | ((F.col("kind") == _number("key")) & F.col("by_address"))
    candidates = owned.where(~belongs).select("key1", "key2", "kind", "start", "end")
    sought = {"by_identifier": ("access", "account"), "by_endpoint": ("endpoint",), "by_secret": ("assign", "hex", "key")}
    marked = _near(candidates, sought)
    linked = (
        strong
        | ((F.col("kind") == _number("key")) & (F.col("by_identifier") | F.col("by_endpoint")))
        | ((F.col("kind") == _number("account")) & F.col("by_secret"))
        | ((F.col("kind") == _number("endpoint")) & F.col("by_identifier") & F.col("by_secret"))
    )
    return marked.where(linked).select("key1", "key2", "kind", "start", "end")


def _listed(spans: Column) -> Column:
    """`kind:start:end` joined by commas, in the order of the array."""
    names = F.array(*map(F.lit, KINDS))
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"], s["end"])), ",")


def _by_text(docs: DataFrame) -> DataFrame:
    """(key1, key2, spans): the sorted spans of each distinct text that has any."""
    return found_spans(docs).groupBy("key1", "key2").agg(F.sort_array(F.collect_list(F.struct("start", "kind", "end"))).alias("spans"))


def scan(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, n_assign, n_access, n_hex, base_sha256, spans, n_linked.

    `spans` lists all reported parts by start, then kind; `base_sha256` is of the strong ones alone.
    """
    keyed = docs.select("doc_id", *_text_key(F.col("text")))
    spans = F.coalesce(F.col("spans"), F.array().cast("array<struct<start:bigint,kind:int,end:bigint>>"))
    both = keyed.join(_by_text(docs), ["key1", "key2"], "left").withColumn("spans", spans)
    base = F.filter("spans", lambda s: s["kind"] < len(STRONG))
    counts = [_count(k).alias(f"n_{kind}") for k, (kind, *_) in enumerate(STRONG)]
    return both.select(
        "doc_id", *counts, F.sha2(_listed(base), 256).alias("base_sha256"), _listed(F.col("spans")).alias("spans"),
        F.size(F.filter("spans", lambda s: s["kind"] >= len(STRONG))).cast("long").alias("n_linked"),
    )


def redact(docs: DataFrame, mask: str = MASK) -> DataFrame:
    """`docs` with every reported span replaced by `mask` (overlapping ones by one), columns unchanged; n_chars follows the text.

    Texts without any part never leave their partition's scan; only the others are joined with their spans.
    """
    columns = docs.columns
    any_kind = reduce(lambda a, b: a | b, (F.col("text").rlike(_QUICK.get(k[0], k[1])) for k in STRONG + WEAK))
    suspect = F.coalesce(any_kind, F.lit(False))
    text_keys = _text_key(F.col("text"))
    spans = _by_text(docs).withColumnsRenamed({"key1": "_key1", "key2": "_key2", "spans": "_spans"})
    held = docs.where(suspect).withColumns({"_key1": text_keys[0], "_key2": text_keys[1]}).join(spans, ["_key1", "_key2"], "left")
    # a span that overlaps the text masked before it only lengthens the mask
    reach = F.aggregate(
        "_spans",
        F.struct(F.lit(0).cast("long").alias("end"), F.lit("").alias("text")),
        lambda at, s: F.struct(
            F.greatest(at["end"], s["end"]).alias("end"),
            F.concat(
                at["text"],
                F.when(s["start"] < at["end"], "").otherwise(
                    F.concat(F.substring("text", (at["end"] + 1).cast("int"), (s["start"] - at["end"]).cast("int")), F.lit(mask))
                ),
            ).alias("text"),
        ),
    )
    masked = F.concat(reach["text"], F.substring(F.col("text"), (reach["end"] + 1).cast("int"), F.length("text")))
    held = held.withColumn("text", F.when(F.col("_spans").isNotNull(), masked).otherwise(F.col("text")))
    if "n_chars" in columns:
        changed = F.col("_spans").isNotNull()
        held = held.withColumn("n_chars", F.when(changed, F.length("text").cast(docs.schema["n_chars"].dataType)).otherwise(F.col("n_chars")))
    return docs.where(~suspect).select(*columns).unionByName(held.select(*columns))
