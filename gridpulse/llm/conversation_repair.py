"""Repair of conversation structure by a weighted CYK parse.

A conversation is right if its role initials spell `(s?(ua)+)?`: nothing, or an optional system turn and then user and
assistant in turn.  Every row is kept (0), given the role user or assistant (3) or deleted (4); blank rows and repeated ones must be
deleted; a row that breaks off costs 3 more unless it is deleted; a row with empty text may be inserted anywhere (3).

**Grammar.** The nonterminals are pairs of states [p, q] of that pattern (start, after system, after user, after assistant): what a
span of rows may turn into when it takes the pattern from p to q.  The rules are in Chomsky normal form: [p, q] -> [p, r] [r, q]
joins two neighbouring spans, and a terminal rule for each edit of one row.  Insertions need no row: they close every cell, [p, q] -> I… .
A cell holds the cheapest (cost, audit) of its nonterminal, the audit being the edits' initials D, I, K, R; ties take the ASCII-least audit.  Two audits
of one span and one cost are never prefixes of each other (equal edits of the rows leave only insertions to differ by, and those cost), so the
least of a joined span is joined from the least of its parts.

**Chart.** Cells are combined bottom-up by span length.  Since a span's cell does not depend on where it is split, one split of each
span is enough, which is what lets a long conversation be parsed in pieces: rows are cut into spans of `SPAN`, a group of at most `SPAN` spans is
joined by one task, and so on until a conversation has one cell.  No task sees a whole long conversation before that; a cell holds a few audits.

Rows are taken by turn, nulls first; rows of one turn by role and then by a hash of their text.  A null role or text is one space; a null
conv_id is a conversation of its own.  An empty table gives empty tables.  Repeated rows are rows.  Other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridpulse.llm.texts import KEYS, text_keys
from gridpulse.operators.sequence import Sequence
from gridpulse.schema import ROW
from gridpulse.workspace import store

#: Costs of the edits, and of leaving a row that breaks off.
RENAME, DELETE, INSERT, BROKEN = 3, 4, 3, 3

#: Rows of a first span, and spans joined at once.
SPAN = 64

WHITE = " \t\n\x0b\x0c\r"
ROLES = {"u": "user", "a": "assistant"}

# States: 0 start, 1 after system, 2 after user, 3 after assistant; a conversation may end in 0 or 3.
_STATES, _ENDS = range(4), (0, 3)
_STEP = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (2, "a"): 3, (3, "u"): 2}

# One character for each row: its role initial (s, u, a or another), in one of three forms.
_INITIALS = "suax"
_FORMS = {"whole": "suax", "broken": "SUAX", "gone": "0123"}

Cell = dict[tuple[int, int], tuple[int, str]]
_CELL = "costs array<long>, audits array<string>"


# -- cells ---------------------------------------------------------------------------


def joined(left: Cell, right: Cell) -> Cell:
    """[p, q] -> [p, r] [r, q], the cheapest r."""
    out: Cell = {}
    for (p, r), (cost, audit) in left.items():
        for q in _STATES:
            after = right.get((r, q))
            if after is not None:
                found = (cost + after[0], audit + after[1])
                if (p, q) not in out or found < out[p, q]:
                    out[p, q] = found
    return out


def insertions() -> Cell:
    """What insertions alone can do; the closure of every cell."""
    cell: Cell = {(p, p): (0, "") for p in _STATES}
    one: Cell = {(p, q): (INSERT, "I") for (p, role), q in _STEP.items() if role in ROLES}
    for _ in _STATES:
        longer = joined(cell, one)
        cell = {k: min(v for v in (cell.get(k), longer.get(k)) if v is not None) for k in cell.keys() | longer.keys()}
    return cell


def row_cell(code: str) -> Cell:
    """The edits of one row, without insertions around it."""
    form = next(f for f, letters in _FORMS.items() if code in letters)
    initial = _INITIALS[_FORMS[form].index(code)]
    cell: Cell = {(p, p): (DELETE, "D") for p in _STATES}
    if form == "gone":
        return cell
    extra = BROKEN if form == "broken" else 0
    for (p, role), q in _STEP.items():
        edits = [(extra, "K")] if role == initial else []
        edits += [(RENAME + extra, "R")] if role in ROLES else []
        for edit in edits:
            cell[p, q] = min(cell.get((p, q), edit), edit)
    return cell


class Chart:
    """Cells of spans, by the characters of their rows; those of short spans are remembered."""

    SHORT = 8

    def __init__(self) -> None:
        closure = insertions()
        self.rows = {c: joined(joined(closure, row_cell(c)), closure) for letters in _FORMS.values() for c in letters}
        self.known: dict[str, Cell] = {}

    def span(self, codes: str) -> Cell:
        """The cell of a span of at least one row, bottom-up by doubled lengths."""
        size = self.SHORT
        return self.all([self._short(codes[k : k + size]) for k in range(0, len(codes), size)])

    def _short(self, codes: str) -> Cell:
        cell = self.known.get(codes)
        if cell is None:
            cell = self.known[codes] = self.all([self.rows[c] for c in codes])
        return cell

    @staticmethod
    def all(cells: list[Cell]) -> Cell:
        """Neighbours are joined, then neighbours of what came out, until one cell is left."""
        while len(cells) > 1:
            pairs = [joined(a, b) for a, b in zip(cells[::2], cells[1::2])]
            cells = pairs + cells[2 * len(pairs) :]
        return cells[0]


def _flat(cell: Cell) -> tuple[list[int | None], list[str | None]]:
    entries = [cell.get((p, q), (None, None)) for p in _STATES for q in _STATES]
    return [e[0] for e in entries], [e[1] for e in entries]


def _cell(costs: list[int | None], audits: list[str | None]) -> Cell:
    return {divmod(k, len(_STATES)): (c, a) for k, (c, a) in enumerate(zip(costs, audits)) if c is not None}


# -- rows ----------------------------------------------------------------------------


def _plain(rows: DataFrame) -> DataFrame:
    """conv_id, turn, role, text without nulls in the last two, and the text's hash."""
    text = F.coalesce("text", F.lit(" "))
    return rows.select("conv_id", "turn", F.coalesce("role", F.lit(" ")).alias("role"), text.alias("text"), *text_keys(text))


def _initial(role: Column) -> Column:
    initial = F.substring(role, 1, 1)
    return F.when(initial.isin("s", "u", "a"), initial).otherwise("x")


def faulty(rows: DataFrame) -> Sequence:
    """The rows in order, with their fault: blank, duplicate, truncated or null; texts stay behind."""
    end = F.right(F.rtrim("text", F.lit(WHITE)), F.lit(1))
    narrow = _plain(rows).select("conv_id", "turn", "role", *KEYS, end.alias("end"))
    seq = Sequence.of(narrow, order=("turn", "role", *KEYS), keys=("conv_id",))
    # A row is known by its place, so a repeated row, however often it occurs, is one row per task and never a join key.
    first = seq.rows.groupBy("conv_id", "role", *KEYS).agg(F.min(ROW).alias("place")).select("place", F.lit(True).alias("first"))
    marked = seq.rows.join(first, F.col(ROW) == F.col("place"), "left")
    fault = (
        F.when(F.col("end") == "", "blank")
        .when(F.col("first").isNull(), "duplicate")
        .when(~F.col("end").isin(".", "!", "?"), "truncated")
    )
    return seq.with_rows(marked.select("conv_id", "turn", "role", ROW, fault.alias("fault")))


def _spans(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """First spans: from the rows' characters to a cell, with the adjacent roles that are not right."""
    chart = Chart()
    for batch in batches:
        out = [_span_row(chart, codes) for codes in batch.column("codes").to_pylist()]
        yield _with_cells(batch, out)


def _span_row(chart: Chart, codes: str) -> tuple:
    initials = [_INITIALS[next(f.index(c) for f in _FORMS.values() if c in f)] for c in codes]
    illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:]))
    return initials[0], initials[-1], illegal, *_flat(chart.span(codes))


def _joins(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Neighbouring spans of one conversation become one."""
    for batch in batches:
        yield _with_cells(batch, [_joined_row(parts) for parts in batch.column("parts").to_pylist()])


def _joined_row(parts: list[dict]) -> tuple:
    cell = Chart.all([_cell(p["costs"], p["audits"]) for p in parts])
    seams = sum(a["last"] + b["first"] not in ("su", "ua", "au") for a, b in zip(parts, parts[1:]))
    return parts[0]["first"], parts[-1]["last"], sum(p["illegal"] for p in parts) + seams, *_flat(cell)


def _with_cells(batch: pa.RecordBatch, rows: list[tuple]) -> pa.RecordBatch:
    types = {"first": pa.string(), "last": pa.string(), "illegal": pa.int64(), "costs": pa.list_(pa.int64()), "audits": pa.list_(pa.string())}
    columns = {name: pa.array([r[k] for r in rows], kind) for k, (name, kind) in enumerate(types.items())}
    return pa.RecordBatch.from_pydict({"conv_id": batch.column("conv_id"), "span": batch.column("span")} | columns)


def _parsed(seq: Sequence, longest: int) -> DataFrame:
    """(conv_id, illegal, cost, audit), one row per conversation."""
    kind = seq.rows.schema["conv_id"].dataType.simpleString()
    schema = f"conv_id {kind}, span long, first string, last string, illegal long, {_CELL}"
    form = F.when(F.col("fault").isin("blank", "duplicate"), "gone").when(F.col("fault") == "truncated", "broken").otherwise("whole")
    code = F.coalesce(*[F.when(form == f, F.translate(_initial(F.col("role")), _INITIALS, letters)) for f, letters in _FORMS.items()])
    in_order = F.sort_array(F.collect_list(F.struct(ROW, code.alias("code"))))
    codes = F.array_join(F.transform(in_order, lambda r: r["code"]), "").alias("codes")
    spans = seq.rows.groupBy("conv_id", F.expr(f"{ROW} div {SPAN}").alias("span")).agg(codes).mapInArrow(_spans, schema)
    parts = F.sort_array(F.collect_list(F.struct("span", "first", "last", "illegal", "costs", "audits"))).alias("parts")
    width = SPAN
    while longest > width * (SPAN - 2):  # places are counted over all conversations, so one may touch two spans more than it fills
        spans = store(spans.groupBy("conv_id", F.expr(f"span div {SPAN}").alias("span")).agg(parts).mapInArrow(_joins, schema), "spans")
        width *= SPAN
    whole = spans.groupBy("conv_id").agg(parts, F.lit(0).cast("long").alias("span")).mapInArrow(_joins, schema)
    ends = [F.struct(F.col("costs")[q].alias("cost"), F.col("audits")[q].alias("audit")) for q in _ENDS]
    best = F.array_min(F.filter(F.array(*ends), lambda e: e["cost"].isNotNull()))
    return whole.select("conv_id", "illegal", best.alias("best")).select("conv_id", "illegal", "best.*")


def audits(rows: DataFrame) -> DataFrame:
    """One row per conversation: gaps, blank, duplicate, truncated, illegal, cost (all long) and audit.

    gaps: turns missing between the first and the last (null turns do not count); illegal: adjacent role initials other than su, ua, au.
    """
    seq = faulty(rows)
    seq = seq.with_rows(store(seq.rows, "faults"))
    faults = ("blank", "duplicate", "truncated")
    of_turn = seq.rows.groupBy("conv_id", "turn").agg(F.count("*").alias("rows"), *[F.count_if(F.col("fault") == f).alias(f) for f in faults])
    missing = F.max("turn").cast("long") - F.min("turn").cast("long") + 1 - F.count("turn")
    counted = of_turn.groupBy("conv_id").agg(F.coalesce(missing, F.lit(0)).alias("gaps"), F.sum("rows").alias("rows"), *[F.sum(f).alias(f) for f in faults])
    counted = store(counted, "conversations")
    longest = counted.agg(F.max("rows")).first()[0] or 0
    parsed = _parsed(seq, longest).withColumnRenamed("conv_id", "parsed_id")
    both = counted.join(parsed, F.col("conv_id").eqNullSafe(F.col("parsed_id")))
    return store(both.select("conv_id", "gaps", *faults, "illegal", "cost", "audit"), "audits")


# -- repaired conversations ----------------------------------------------------------


def _edited(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of one conversation after another, each led by its audit: what the edits make of them."""
    audit, at, state, conv = "", 0, 0, None
    out: list[tuple] = []

    def inserted() -> None:
        nonlocal at, state
        while audit[at : at + 1] == "I":
            state = _STEP[state, "u" if state != 2 else "a"]
            out.append((conv, at, "I", "assistant" if state == 3 else "user", ""))
            at += 1

    for batch in batches:
        for head, conv_id, role, text in zip(*[batch.column(c).to_pylist() for c in ("audit", "conv_id", "role", "text")]):
            if head is not None:
                inserted()
                audit, at, state, conv = head, 0, 0, conv_id
                continue
            inserted()
            edit = audit[at]
            if edit != "D":
                initial = role[:1] if edit == "K" else "a" if state == 2 else "u"
                state = _STEP[state, initial]
                out.append((conv, at, edit, role if edit == "K" else ROLES[initial], text))
            at += 1
        yield _lines(out, batch.schema.field("conv_id").type)
        out.clear()
        kind = batch.schema.field("conv_id").type
    inserted()
    if out:
        yield _lines(out, kind)


def _lines(rows: list[tuple], kind: pa.DataType) -> pa.RecordBatch:
    types = {"conv_id": kind, "line": pa.int64(), "edit": pa.string(), "role": pa.string(), "text": pa.string()}
    return pa.RecordBatch.from_pydict({n: pa.array([r[k] for r in rows], t) for k, (n, t) in enumerate(types.items())})


def repaired(rows: DataFrame, audited: DataFrame) -> DataFrame:
    """The rows of repaired conversations: conv_id, line (place of the edit in the audit), edit (I, K or R), role, text.

    `audited` is `audits(rows)`.  A conversation lies in one partition, in order of lines; it is read as a stream, so what a task keeps of it
    is its audit.
    """
    plain = _plain(rows).withColumn("audit", F.lit(None).cast("string"))
    heads = audited.select("conv_id", "audit")
    led = plain.unionByName(heads, allowMissingColumns=True).repartition("conv_id")
    ordered = led.sortWithinPartitions("conv_id", F.col("audit").isNull(), "turn", "role", *KEYS)
    kind = rows.schema["conv_id"].dataType.simpleString()
    return ordered.select("audit", "conv_id", "role", "text").mapInArrow(_edited, f"conv_id {kind}, line long, edit string, role string, text string")


def text_digests(lines: DataFrame) -> DataFrame:
    """(conv_id, repaired_sha256) of `repaired` rows: the hash of their `role:text`, joined by newlines, taken as they stream by."""
    kind = lines.schema["conv_id"].dataType.simpleString()

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        open_, last, arrow_kind = None, None, None
        done: list[tuple] = []

        def closed() -> pa.RecordBatch:
            ids, sums = [d[0] for d in done], [d[1] for d in done]
            done.clear()
            return pa.RecordBatch.from_pydict({"conv_id": pa.array(ids, arrow_kind), "repaired_sha256": pa.array(sums, pa.string())})

        for batch in batches:
            arrow_kind = batch.schema.field("conv_id").type
            for conv, line, role, text in zip(*[batch.column(c).to_pylist() for c in ("conv_id", "line", "role", "text")]):
                if open_ is None or conv != last[0] or line <= last[1]:
                    if open_ is not None:
                        done.append((last[0], open_.hexdigest()))
                    open_ = hashlib.sha256(f"{role}:{text}".encode())
                else:
                    open_.update(f"\n{role}:{text}".encode())
                last = (conv, line)
            yield closed()
        if open_ is not None:
            done.append((last[0], open_.hexdigest()))
            yield closed()

    return lines.select("conv_id", "line", "role", "text").mapInArrow(hashed, f"conv_id {kind}, repaired_sha256 string")


# -- damage for the registered query -------------------------------------------------


def damaged(conversations: DataFrame) -> DataFrame:
    """Rows with faults planted by crc32 of `conv_id:turn` modulo 20: 0 drops a row, 1 empties its text, 2 takes its `.!?`, 3 repeats it, 4 makes it a user's."""
    space = F.lit(" ")
    name = F.concat_ws(":", F.coalesce(F.col("conv_id").cast("string"), space), F.coalesce(F.col("turn").cast("string"), space))
    fate = F.crc32(name) % 20
    text = F.coalesce("text", space)
    rows = conversations.select(
        "conv_id",
        "turn",
        F.when(fate == 4, "user").otherwise(F.coalesce("role", space)).alias("role"),
        F.when(fate == 1, "").when(fate == 2, F.translate(text, ".!?", "")).otherwise(text).alias("text"),
        F.when(fate == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0))).alias("times"),
        (fate == 0).alias("lost"),
    )
    return rows.where("not lost").select("conv_id", "turn", "role", "text", F.explode("times").alias("_time")).drop("_time")


def damaged_and_repaired(conversations: DataFrame) -> DataFrame:
    """One row for every conv_id of the table, also of those that lost all rows: the audit of the damaged rows and the hash of the repaired ones."""
    rows = damaged(conversations)
    found = audits(rows)
    sums = text_digests(repaired(rows, found)).withColumnRenamed("conv_id", "summed_id")
    full = found.join(sums, F.col("conv_id").eqNullSafe(F.col("summed_id")), "left").drop("summed_id").withColumnRenamed("conv_id", "found_id")
    ids = conversations.select("conv_id").distinct()
    out = ids.join(full, F.col("conv_id").eqNullSafe(F.col("found_id")), "left")
    numbers = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")
    return out.select(
        "conv_id",
        *[F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in numbers],
        F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("repaired_sha256", F.sha2(F.lit(""), 256)).alias("repaired_sha256"),
    )
