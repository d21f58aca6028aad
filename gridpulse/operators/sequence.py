"""Exact row positions and row-frame windows over one long ordered series.

A window without a partition key would move the whole series into one task, and
a window keyed by host would move a dominating host into one task.  Here the
series is instead cut by *position*:

1. `Sequence.of` range-partitions on (keys, order), sorts each partition and
   stores it with the position inside its partition; adding the row counts of
   the earlier partitions gives the global position `row_idx`.  The range
   bounds include the tiebreak column, so neither a hot key nor a hot timestamp
   can fill a partition.
2. `blocked` groups rows into blocks of equal length and repeats the last rows
   of each block (the halo) in front of the next one, so trailing row frames
   inside a block see what they would see in the whole series.
3. `carried` brings values across any distance: one row per half block is
   scanned in two levels, so no task sees more than a sliver of the series.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence as Seq
from dataclasses import dataclass, replace
from itertools import accumulate

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from gridpulse.schema import ROW, TS
from gridpulse.workspace import store

BLOCK = "_block"
CARRY = "_carry"  # True on rows that only transport a value into a block

MIN_BLOCK = 64
MAX_BLOCK = 4000  # with halo and carry rows, a block stays in the window operator's row buffer
SUPER = 4096  # blocks scanned together on the first level of a carry scan

_POSITION_BITS = 33  # monotonically_increasing_id keeps the in-partition position there


@dataclass(frozen=True)
class Sequence:
    """An ordered frame whose rows know their position."""

    rows: DataFrame
    length: int
    block: int
    keys: tuple[str, ...] = ()

    @staticmethod
    def of(
        df: DataFrame,
        order: Seq[str] = (TS,),
        keys: Seq[str] = (),
        block: int | None = None,
    ) -> "Sequence":
        """Order `df` by (keys, order) and number its rows.

        `order` should end in a unique column; rows that tie on all of it keep
        an arbitrary but, once stored, fixed order.
        """
        sort = [F.col(c) for c in (*keys, *order)]
        tagged = (
            df.repartitionByRange(*sort)
            .sortWithinPartitions(*sort)
            .withColumn("_id", F.monotonically_increasing_id())
        )
        stored = store(tagged, "ordered").withColumn("_part", F.shiftright("_id", _POSITION_BITS))
        position = F.col("_id").bitwiseAND((1 << _POSITION_BITS) - 1)

        # One number per range partition, so this stays as small as the shuffle's
        # own bookkeeping however long the series is.
        sizes = stored.groupBy("_part").agg((F.max(position) + 1).alias("size")).orderBy("_part").collect()
        ends = list(accumulate(r["size"] for r in sizes))
        offsets = df.sparkSession.createDataFrame(
            [(r["_part"], end - r["size"]) for r, end in zip(sizes, ends)], "_part long, offset long"
        )
        rows = (
            stored.join(F.broadcast(offsets), "_part")
            .withColumn(ROW, F.col("offset") + position)
            .drop("_part", "_id", "offset")
        )
        length = ends[-1] if ends else 0
        return Sequence(rows, length, block or _block_length(df, length), tuple(keys))

    def with_rows(self, rows: DataFrame) -> "Sequence":
        return replace(self, rows=rows)

    # -- windows inside blocks -------------------------------------------------

    @property
    def forward(self) -> WindowSpec:
        return Window.partitionBy(BLOCK, *self.keys).orderBy(ROW)

    @property
    def backward(self) -> WindowSpec:
        return Window.partitionBy(BLOCK, *self.keys).orderBy(F.col(ROW).desc())

    def blocked(self, halo: int) -> DataFrame:
        """Rows with a `_block`, each block preceded by the `halo` rows before it."""
        self._check(halo)
        own = self._own_block()
        if halo == 0:
            return self.rows.withColumn(BLOCK, own)
        targets = F.when(self._is_tail(halo), F.array(own, own + 1)).otherwise(F.array(own))
        return self.rows.withColumn(BLOCK, F.explode(targets))

    def own(self, blocked: DataFrame) -> DataFrame:
        """Drop the halo copies again."""
        return blocked.where(F.col(BLOCK) == self._own_block()).drop(BLOCK)

    def trailing(self, halo: int, add: Callable[[DataFrame, WindowSpec], DataFrame]) -> "Sequence":
        """Apply `add(blocked rows, forward window)`, whose row frames must reach
        back at most `halo` rows."""
        return self.with_rows(self.own(add(self.blocked(halo), self.forward)))

    # -- values carried over any distance ----------------------------------------

    def edges(self, columns: Seq[str], halo: int) -> DataFrame:
        """Stored summary, one row per half block: first and last valid value of
        each column with their positions, and its extremes.

        Half 2b is block b without its last `halo` rows, half 2b+1 those rows.
        """
        half = 2 * self._own_block() + self._is_tail(halo).cast("long")
        at = {c: F.when(F.col(c).isNotNull(), F.col(ROW)) for c in columns}
        return store(
            self.rows.groupBy(*self.keys, half.alias("_half")).agg(
                *[F.min(at[c]).alias(f"{c}_first_at") for c in columns],
                *[F.min_by(c, at[c]).alias(f"{c}_first") for c in columns],
                *[F.max(at[c]).alias(f"{c}_last_at") for c in columns],
                *[F.max_by(c, at[c]).alias(f"{c}_last") for c in columns],
                *[F.min(c).alias(f"{c}_min") for c in columns],
                *[F.max(c).alias(f"{c}_max") for c in columns],
            ),
            "edges",
        )

    def carried(self, columns: Seq[str], halo: int, edges: DataFrame | None = None) -> DataFrame:
        """`blocked(halo)` plus, around each block, rows that carry the nearest
        valid value of every column from before and from after it.

        Adds `<column>_at`, the position a non-null value comes from.  Carry rows
        have `_carry` set and sort first and last in their block.
        """
        halo = max(halo, 1)  # edges need a tail to hang on
        edges = self.edges(columns, halo) if edges is None else edges
        data = self.blocked(halo).withColumns(
            {CARRY: F.lit(False)} | {f"{c}_at": F.when(F.col(c).isNotNull(), F.col(ROW)) for c in columns}
        )
        return data.unionByName(self._carry_rows(edges, columns, halo), allowMissingColumns=True)

    def _carry_rows(self, edges: DataFrame, columns: Seq[str], halo: int) -> DataFrame:
        # What lies before half 2b+1 is what block b+1 (with its halo) cannot see,
        # and what lies after it is what block b cannot see.
        def scanned(kind: str) -> DataFrame:
            names = [n for c in columns for n in (f"{c}_{kind}_at", f"{c}_{kind}")]
            narrow = edges.select(*self.keys, "_half", *names)
            span = 2 * (self.length // self.block + 1)
            return exclusive_scan(narrow, self.keys, "_half", names, kind, span)

        def rows(kind: str, block: Column, position: Column) -> DataFrame:
            return (
                scanned(kind)
                .where("_half % 2 = 1")
                .select(
                    *self.keys,
                    block.alias(BLOCK),
                    position.cast("long").alias(ROW),
                    F.lit(True).alias(CARRY),
                    *[F.col(f"{c}_{kind}").alias(c) for c in columns],
                    *[F.col(f"{c}_{kind}_at").alias(f"{c}_at") for c in columns],
                )
            )

        owner = F.expr("_half div 2")
        following = owner + 1
        before = rows("last", following, following * self.block - halo - 1)
        after = rows("first", owner, following * self.block)
        return before.unionByName(after)

    # -- prefix sums -----------------------------------------------------------

    def running_sum(self, measure: str, name: str) -> DataFrame:
        """Rows plus `name`, the inclusive running sum of `measure` per key."""
        blocks = self.blocked(0)
        prefix = exclusive_scan(
            blocks.groupBy(*self.keys, BLOCK).agg(F.sum(measure).alias("_before")),
            self.keys,
            BLOCK,
            ["_before"],
            "sum",
            self.length // self.block + 1,
        )
        inside = blocks.withColumn(
            name, F.sum(measure).over(self.forward.rowsBetween(Window.unboundedPreceding, 0))
        )
        joined = _null_safe_join(inside, prefix, (BLOCK, *self.keys))
        return joined.withColumn(name, F.col(name) + F.coalesce("_before", F.lit(0))).drop(
            "_before", BLOCK
        )

    # -- helpers -----------------------------------------------------------------

    def _own_block(self) -> Column:
        return F.expr(f"{ROW} div {self.block}")

    def _is_tail(self, halo: int) -> Column:
        return F.col(ROW) % self.block >= self.block - halo

    def _check(self, halo: int) -> None:
        if halo >= self.block:
            raise ValueError(f"halo {halo} does not fit in blocks of {self.block} rows")


def exclusive_scan(
    df: DataFrame, keys: Seq[str], position: str, columns: Seq[str], kind: str, span: int
) -> DataFrame:
    """Replace `columns` by their scan over the other rows of the key.

    kind `last`: last non-null among earlier positions; `first`: first non-null
    among later positions; `sum`: sum over earlier positions.  `span` bounds the
    positions: up to `SUPER` one window per key does it, beyond that rows are
    scanned inside groups of `SUPER` positions and then one row per group is.
    """
    backwards = kind == "first"

    def before(spec: WindowSpec, column: str) -> WindowSpec:
        order = F.col(column).desc() if backwards else F.col(column).asc()
        return spec.orderBy(order).rowsBetween(Window.unboundedPreceding, -1)

    def scan(c: str, w: WindowSpec) -> Column:
        return (F.sum(c) if kind == "sum" else F.last(c, ignorenulls=True)).over(w)

    if span <= SUPER:
        w = before(Window.partitionBy(*keys), position)
        return df.withColumns({c: scan(c, w) for c in columns})

    def total(c: str) -> Column:
        valid_at = F.when(F.col(c).isNotNull(), F.col(position))
        return {"sum": F.sum(c), "last": F.max_by(c, valid_at), "first": F.min_by(c, valid_at)}[kind]

    grouped = df.withColumn("_super", F.expr(f"`{position}` div {SUPER}"))
    inside = before(Window.partitionBy(*keys, "_super"), position)
    across = before(Window.partitionBy(*keys), "_super")
    outer = (
        grouped.groupBy(*keys, "_super")
        .agg(*[total(c).alias(c) for c in columns])
        .select(*keys, "_super", *[scan(c, across).alias(f"_outer_{c}") for c in columns])
    )
    inner = grouped.withColumns({f"_inner_{c}": scan(c, inside) for c in columns})
    joined = _null_safe_join(inner, outer, ("_super", *keys))

    def combined(c: str) -> Column:
        if kind == "sum":
            return F.coalesce(f"_inner_{c}", F.lit(0)) + F.coalesce(f"_outer_{c}", F.lit(0))
        return F.coalesce(f"_inner_{c}", f"_outer_{c}")

    others = [c for c in df.columns if c not in columns]
    return joined.select(*others, *[combined(c).alias(c) for c in columns])


def _null_safe_join(left: DataFrame, right: DataFrame, on: Seq[str]) -> DataFrame:
    """Left join on equal columns, where a NULL key equals a NULL key."""
    renamed = right.withColumnsRenamed({c: f"_r_{c}" for c in on})
    # Block numbers are never NULL; plain equality keeps their hash partitioning usable.
    pairs = [(F.col(c), F.col(f"_r_{c}"), c.startswith("_")) for c in on]
    condition = [a == b if internal else a.eqNullSafe(b) for a, b, internal in pairs]
    return left.join(renamed, condition, "left").drop(*[f"_r_{c}" for c in on])


def _block_length(df: DataFrame, length: int) -> int:
    partitions = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return min(MAX_BLOCK, max(MIN_BLOCK, length // (16 * partitions) + 1))
