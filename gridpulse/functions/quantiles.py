"""Exact quantiles (linear interpolation) that do not need all values in one place.

The source is scanned twice, whatever its size.  The first scan merges a bounded sketch per column, which gives two values that are all but certain to
enclose each wanted rank.  The second counts the values between those exactly, each distinct value once, and how many lie before: a table of
a few thousandths of the rows, in which the ranks are then narrowed down by histograms.  A rank that a sketch missed is counted in the whole column.
Nothing is sampled; sketches only say where to look.
"""

from __future__ import annotations

import math
from collections.abc import Sequence as Seq
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Row, Window
from pyspark.sql import functions as F

from gridpulse.functions.keyed import joined_by_key, same_keys
from gridpulse.workspace import store

BINS = 1024
#: Distinct values of a range that are counted one by one instead of being binned again.
FEW_ROWS = 4096
#: Sketches are off by a rank in so many; brackets are twice as wide.
ACCURACY = 1000


@dataclass(frozen=True)
class _Range:
    """Values of a column between two of its values: how many are smaller, and how many distinct ones there are; at first the whole column."""

    column: int
    low: float = -math.inf
    high: float = math.inf
    below: int = 0
    values: int | None = None


def exact_quantiles(
    df: DataFrame, columns: Seq[str], probabilities: Seq[float], bins: int = BINS, few_rows: int = FEW_ROWS, keys: Seq[str] = (), accuracy: int = ACCURACY
) -> DataFrame:
    """One row (with keys: one per key, null being a key) with an array column per input column; nulls and NaN are ignored, infinities are values."""
    inner = {f"_key{j}": c for j, c in enumerate(keys)}
    values = df.select(*[F.col(c).alias(k) for k, c in inner.items()], *[_value(c).alias(_x(k)) for k, c in enumerate(columns)])
    if keys:
        return _by_key(values, list(columns), list(probabilities), list(inner), bins, few_rows, accuracy).withColumnsRenamed(inner)
    return _overall(values, list(columns), list(probabilities), bins, few_rows, accuracy)


def _x(k: int) -> str:
    return f"_x{k}"


def _value(column: str) -> Column:
    """The column as double, NaN as null, negative zero as zero."""
    x = F.col(column).cast("double")
    return F.when(~F.isnan(x), x + F.lit(0.0))


# -- the two scans -------------------------------------------------------------------


def _sketches(n: int, probabilities: list[float], accuracy: int) -> list[Column]:
    """Per column its rows and, for each probability, two values around the wanted one."""
    delta = 2 / accuracy

    def edge(k: int, p: float) -> Column:
        if 0 < p < 1:
            return F.percentile_approx(_x(k), F.lit(p), F.lit(accuracy))
        return F.min(_x(k)) if p <= 0 else F.max(_x(k))

    return [
        column
        for k in range(n)
        for column in (
            F.count(_x(k)).alias(f"_rows{k}"),
            F.array(*[edge(k, p - delta) for p in probabilities]).alias(f"_low{k}"),
            F.array(*[edge(k, p + delta) for p in probabilities]).alias(f"_high{k}"),
        )
    ]


def _counted(rows: DataFrame, n: int, low, high, keys: Seq[str] = ()) -> DataFrame:
    """Stored counts (keys, k, slot, x, n): of each value x between a low and a high edge, and of all others (x null) by the high edges before them.

    (slot, x), nulls first, is the order of the values.  `low` and `high` give the array of edges of a column.
    """

    def entry(k: int) -> Column:
        x = F.col(_x(k))
        inside = F.exists(F.arrays_zip(low(k).alias("low"), high(k).alias("high")), lambda e: x.between(e["low"], e["high"]))
        slot = F.size(F.filter(high(k), lambda h: h < x))
        found = F.struct(F.lit(k).alias("k"), slot.alias("slot"), F.when(inside, x).alias("x"))
        return F.when(x.isNotNull() & (inside | (slot < F.size(high(k)))), found)

    entries = rows.select(*keys, F.explode(F.array_compact(F.array(*[entry(k) for k in range(n)]))).alias("e"))
    return store(entries.groupBy(*keys, "e.k", "e.slot", "e.x").agg(F.count("*").alias("n")), "value_counts")


_STEPS = (F.sum, "n"), (F.count, "values"), (F.min, "low"), (F.max, "high")


def _steps(counted: DataFrame, keys: Seq[str] = ()) -> DataFrame:
    """Per column the brackets and the stretches between them, at most two per probability and one more."""
    inside = F.col("x").isNotNull().alias("inside")
    return counted.groupBy(*keys, "k", "slot", inside).agg(*[f("n" if name == "n" else "x").alias(name) for f, name in _STEPS])


def _bin(x: Column, low: Column, high: Column, distinct: Column, bins: int, few_rows: int) -> Column:
    """Bins in the order of values: one for each of few values; infinities apart from the finite ones; otherwise of equal width."""
    infinite = (low == -math.inf) | (high == math.inf)
    apart = F.when(x == -math.inf, -1.0).when(x == math.inf, 1.0).otherwise(0.0)
    scale = F.when(high - low == math.inf, 2.0).otherwise(1.0)  # the width of the widest range is no number, half of it is
    share = (x / scale - low / scale) / (high / scale - low / scale)
    return F.when(distinct <= few_rows, x).when(infinite, apart).otherwise(F.floor(share * bins).cast("double"))


def _interpolated(position: float, below: float, above: float) -> float:
    weight = position - int(position)
    return below if weight == 0 or below == above else (1 - weight) * below + weight * above


# -- one series ----------------------------------------------------------------------


def _overall(rows: DataFrame, columns: list[str], probabilities: list[float], bins: int, few_rows: int, accuracy: int) -> DataFrame:
    n = len(columns)
    found = rows.agg(*_sketches(n, probabilities, accuracy)).first()
    sizes = [found[f"_rows{k}"] for k in range(n)]
    wanted = {k: sorted({r for p in probabilities for r in _ranks(p, sizes[k])}) for k in range(n) if sizes[k]}
    value = _located(rows, wanted, found, bins, few_rows)

    def quantile(k: int, p: float) -> float | None:
        if not sizes[k]:
            return None
        lower, upper = _ranks(p, sizes[k])
        return _interpolated(p * (sizes[k] - 1), value[k, lower], value[k, upper])

    row = tuple([quantile(k, p) for p in probabilities] for k in range(n))
    return rows.sparkSession.createDataFrame([row], ", ".join(f"`{c}` array<double>" for c in columns))


def _ranks(p: float, rows: int) -> tuple[int, int]:
    position = int(p * (rows - 1))
    return position, min(position + 1, rows - 1)


def _located(rows: DataFrame, wanted: dict[int, list[int]], edges: Row | None, bins: int, few_rows: int) -> dict[tuple[int, int], float]:
    """Values of the wanted ranks (column, rank); without edges whole columns are counted."""
    n = len(rows.columns)

    def edge(kind: str, infinity: float):
        def of(k: int) -> Column:
            known = [infinity] if edges is None else edges[f"_{kind}{k}"]
            return F.array(*[F.lit(v).cast("double") for v in known])

        return of

    counted = _counted(rows, n, edge("low", -math.inf), edge("high", math.inf))
    ranks: dict[tuple[int, int], float | _Range | None] = {(k, rank): _Range(k) for k, own in wanted.items() for rank in own}
    while True:
        open_ = sorted({r for r in ranks.values() if isinstance(r, _Range)}, key=lambda r: (r.column, r.low))
        if not open_:
            break
        histograms = _histogram(counted, open_, bins, few_rows)
        for (k, rank), r in list(ranks.items()):
            if isinstance(r, _Range):
                ranks[k, rank] = _narrower(r, rank, histograms[r])
    missed = {k: [rank for rank in own if ranks[k, rank] is None] for k, own in wanted.items()}
    missed = {k: own for k, own in missed.items() if own}
    return ranks | (_located(rows, missed, None, bins, few_rows) if missed else {})


def _narrower(r: _Range, rank: int, histogram: list[Row]) -> float | _Range | None:
    """The bin that holds the rank, its value if it has but one, or None if the rank lies between brackets."""
    upto = r.below
    for row in histogram:
        if rank < upto + row.n:
            if row.low is None:
                return None
            return row.low if row.low == row.high else _Range(r.column, row.low, row.high, upto, row["values"])
        upto += row.n
    return None


def _histogram(counted: DataFrame, ranges: list[_Range], bins: int, few_rows: int) -> dict[_Range, list[Row]]:
    """Rows, distinct values, smallest and largest value of each bin, in order; bins of a whole column are its brackets and what lies between."""
    if ranges[0].values is None:
        rows = sorted(_steps(counted).collect(), key=lambda r: (r.slot, r.inside))
        return {r: [row for row in rows if row.k == r.column] for r in ranges}
    x = F.col("x")

    def entry(j: int, r: _Range) -> Column:
        place = _bin(x, F.lit(r.low), F.lit(r.high), F.lit(r.values), bins, few_rows)
        return F.when((F.col("k") == r.column) & x.between(r.low, r.high), F.struct(F.lit(j).alias("j"), place.alias("bin")))

    entries = counted.select("n", "x", F.explode(F.array_compact(F.array(*[entry(j, r) for j, r in enumerate(ranges)]))).alias("e"))
    rows = entries.groupBy("e.j", "e.bin").agg(*[f("n" if name == "n" else "x").alias(name) for f, name in _STEPS]).collect()
    found: dict[_Range, list[Row]] = {r: [] for r in ranges}
    for row in sorted(rows, key=lambda r: r.low):
        found[ranges[row.j]].append(row)
    return found


# -- many series ---------------------------------------------------------------------


def _by_key(rows: DataFrame, columns: list[str], probabilities: list[float], keys: list[str], bins: int, few_rows: int, accuracy: int) -> DataFrame:
    """Ranks and ranges are rows here, joined to the counts by key and column; what the driver sees is how many ranks are still open."""
    n = len(columns)
    sketches = store(rows.groupBy(*keys).agg(*_sketches(n, probabilities, accuracy)), "sketches")
    size = [F.col(f"_rows{k}") for k in range(n)]

    def lower(p: float, k: int) -> Column:
        return F.floor(F.lit(p) * (size[k] - 1)).cast("long")

    def of_column(k: int) -> Column:
        ranks = [r for p in probabilities for r in (lower(p, k), F.least(lower(p, k) + 1, size[k] - 1))]
        return F.transform(F.array_distinct(F.array(*ranks)), lambda r: F.struct(F.lit(k).alias("k"), r.alias("rank")))

    every = F.flatten(F.array(*[F.when(size[k] > 0, of_column(k)).otherwise(F.array().cast("array<struct<k:int,rank:bigint>>")) for k in range(n)]))
    wanted = store(sketches.select(*keys, F.inline(every)), "ranks")
    edges = {k: (F.col(f"_low{k}"), F.col(f"_high{k}")) for k in range(n)}
    bracketed = joined_by_key(rows, sketches.drop(*[f"_rows{k}" for k in range(n)]), keys)
    counted = _counted(bracketed, n, lambda k: edges[k][0], lambda k: edges[k][1], keys)
    ranges = _picked(_steps(counted, keys), wanted, keys, F.struct("slot", "inside"))
    missed = ranges.where("not inside or low is null").select(*keys, "k", "rank")
    if not missed.isEmpty():
        whole = _counted(rows, n, lambda k: F.array(F.lit(-math.inf)), lambda k: F.array(F.lit(math.inf)), keys)
        counted = store(_semi(counted, missed, [*keys, "k"], "left_anti").unionByName(_semi(whole, missed, [*keys, "k"], "left_semi")), "value_counts")
        ranges = _picked(_steps(counted, keys), wanted, keys, F.struct("slot", "inside"))
    known = ["k", "rank", "low", "high", "below", "values"]
    ranges = store(ranges.select(*keys, *known), "ranges")
    done = ranges.where("low = high")
    open_ = ranges.where("low < high")
    while not open_.isEmpty():
        narrowed = store(_narrowed(counted, open_, keys, bins, few_rows).select(*keys, *known), "ranges")
        done, open_ = done.unionByName(narrowed.where("low = high")), narrowed.where("low < high")
    found = done.groupBy(*keys).agg(F.map_from_entries(F.collect_list(F.struct(F.struct("k", "rank"), F.col("low")))).alias("_found"))
    joined = sketches.join(found.withColumnsRenamed({c: f"_r_{c}" for c in keys}), same_keys(keys, "_r_"), "left")

    def quantile(k: int, p: float) -> Column:
        position = F.lit(p) * (size[k] - 1)
        weight = position - lower(p, k)
        at = [F.try_element_at("_found", F.struct(F.lit(k).alias("k"), r.alias("rank"))) for r in (lower(p, k), F.least(lower(p, k) + 1, size[k] - 1))]
        return F.when((weight == 0) | (at[0] == at[1]), at[0]).otherwise((1 - weight) * at[0] + weight * at[1])

    return joined.select(*keys, *[F.array(*[quantile(k, p) for p in probabilities]).alias(c) for k, c in enumerate(columns)])


def _semi(table: DataFrame, other: DataFrame, keys: list[str], how: str) -> DataFrame:
    return table.join(other.select(*keys).distinct().withColumnsRenamed({c: f"_r_{c}" for c in keys}), same_keys(keys, "_r_"), how)


def _picked(bins: DataFrame, wanted: DataFrame, keys: list[str], order: Column, group: Seq[str] = ()) -> DataFrame:
    """For every wanted rank (`below` rows come before its bins, if it has that column) the bin that holds it.

    A window sees the bins of one key, column and range: at most `BINS` or `FEW_ROWS` of them.
    """
    by = [*keys, "k", *group]
    upto = F.sum("n").over(Window.partitionBy(*by).orderBy(order).rowsBetween(Window.unboundedPreceding, 0))
    right = bins.withColumn("_upto", upto).withColumnsRenamed({c: f"_r_{c}" for c in by})
    before = F.col("_start") if "_start" in wanted.columns else F.lit(0)
    holds = (F.col("rank") >= before + F.col("_upto") - F.col("n")) & (F.col("rank") < before + F.col("_upto"))
    return wanted.join(right, same_keys(by, "_r_") & holds).withColumn("below", before + F.col("_upto") - F.col("n"))


def _narrowed(counted: DataFrame, open_: DataFrame, keys: list[str], bins: int, few_rows: int) -> DataFrame:
    """One round: the values of every open range fall into bins, and each rank takes its bin as the next range."""
    by = [*keys, "k"]
    spans = open_.groupBy(*by).agg(F.collect_set(F.struct("low", "high", "values")).alias("spans"))
    joined = counted.where("x is not null").join(spans.withColumnsRenamed({c: f"_r_{c}" for c in by}), same_keys(by, "_r_"))
    span = joined.select(*by, "x", "n", F.explode("spans").alias("s")).where(F.col("x").between(F.col("s.low"), F.col("s.high")))
    place = _bin(F.col("x"), F.col("s.low"), F.col("s.high"), F.col("s.values"), bins, few_rows)
    binned = span.groupBy(*by, F.col("s.low").alias("span"), place.alias("bin"))
    histogram = binned.agg(*[f("n" if name == "n" else "x").alias(name) for f, name in _STEPS])
    wanted = open_.select(*by, "rank", F.col("low").alias("span"), F.col("below").alias("_start"))
    return _picked(histogram, wanted, keys, F.col("bin"), ["span"])
