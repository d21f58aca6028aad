"""Pearson and Spearman correlation of metric pairs, overall and per workload."""

from __future__ import annotations

from collections.abc import Sequence as Seq
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridpulse.functions.ranks import average_ranks
from gridpulse.functions.rounding import half_even, stable
from gridpulse.functions.significance import correlation_p_value
from gridpulse.operators.sequence import Sequence
from gridpulse.schema import METRICS, ROW, WORKLOAD, present


@dataclass(frozen=True)
class Pair:
    x: str
    y: str
    label: str
    expected: str


# The pairs with their labels and expectations.
PAIRS = (
    Pair("gpu_usage", "power_consumption", "GPU Usage × Power Consumption",
         "Strong positive — GPU workloads draw more power"),
    Pair("temperature", "gpu_usage", "Temperature × GPU Usage",
         "Moderate positive — heat builds with compute load"),
    Pair("memory_usage", "gpu_usage", "Memory Usage × GPU Usage",
         "Moderate positive — training uses both GPU and memory"),
    Pair("cpu_usage", "gpu_usage", "CPU Usage × GPU Usage",
         "Weak to moderate — depends on pipeline balance"),
    Pair("temperature", "power_efficiency", "Temperature × Power Efficiency",
         "Negative — efficiency drops as temperature rises"),
    Pair("gpu_usage", "thermal_headroom", "GPU Usage × Thermal Headroom",
         "Strong negative — higher load reduces safety margin"),
)

# Sample-size guards, strength bands, matrix columns.
MIN_PAIRS = 10
MIN_GROUP_ROWS = 20
STRENGTH_BANDS = ((0.8, "Strong"), (0.5, "Moderate"), (0.3, "Weak"))
NO_STRENGTH = "Very weak / None"
MATRIX_COLUMNS = (*METRICS, "power_efficiency", "thermal_headroom")

PAIR = "pair_ord"


def usable_pairs(df: DataFrame, pairs: Seq[Pair] = PAIRS) -> list[tuple[int, Pair]]:
    """Pairs whose columns the frame has, with their position."""
    return [(i, p) for i, p in enumerate(pairs) if {p.x, p.y} <= set(df.columns)]


# Wider aggregations outgrow what one generated method may hold and run interpreted,
# dozens of times slower per row; a further scan of the few columns is far cheaper.
PAIRS_PER_SCAN = 6


def _per_pair(df: DataFrame, by: Seq[str], pairs: list[tuple[int, Column, Column]], name: str) -> DataFrame:
    """(by, group_rows, pair_ord, n, <name>) with the coefficient of each pair."""
    parts = [
        _one_scan(df, by, pairs[k : k + PAIRS_PER_SCAN], name) for k in range(0, len(pairs), PAIRS_PER_SCAN)
    ]
    return reduce(DataFrame.unionByName, parts)


def _one_scan(df: DataFrame, by: Seq[str], pairs: list[tuple[int, Column, Column]], name: str) -> DataFrame:
    cells = [
        F.struct(F.lit(i).alias(PAIR), F.regr_count(y, x).alias("n"), _coefficient(x, y).alias(name))
        for i, x, y in pairs
    ]
    grouped = df.groupBy(*by).agg(F.count(F.lit(1)).alias("group_rows"), F.array(*cells).alias("cells"))
    return grouped.select(*by, "group_rows", F.inline("cells"))


def _coefficient(x: Column, y: Column) -> Column:
    """Pearson r over rows with both values; NULL, not an error, when one is constant."""
    spread = F.stddev_samp(F.when(y.isNotNull(), x)) * F.stddev_samp(F.when(x.isNotNull(), y))
    return F.try_divide(F.covar_samp(x, y), spread)


def pearson(df: DataFrame, by: Seq[str] = (), pairs: Seq[Pair] = PAIRS) -> DataFrame:
    """Unrounded Pearson r per pair on rows where both values exist."""
    usable = [(i, F.col(p.x), F.col(p.y)) for i, p in usable_pairs(df, pairs)]
    return _per_pair(df, by, usable, "pearson")


def guarded_pearson(df: DataFrame, by: Seq[str] = (), pairs: Seq[Pair] = PAIRS) -> DataFrame:
    """Rounded Pearson r per pair; 0 where fewer than ten rows have both values."""
    return pearson(df, by, pairs).select(
        *by, PAIR, "n", _guarded(stable(F.col("pearson"), 3), 0.0).alias("pearson_r")
    )


def rank_table(seq: Sequence, pairs: Seq[Pair] = PAIRS) -> DataFrame:
    """Ranks of every pair's variables, overall and inside the workload.

    A pair is ranked over the rows that have both values.  When no value is
    missing, a column's rank is the same in all its pairs and is computed once.
    """
    usable = usable_pairs(seq.rows, pairs)
    used = sorted({c for _, p in usable for c in (p.x, p.y)})
    if not usable:
        return _with_workload(seq.rows).select(ROW, WORKLOAD)
    complete = seq.rows.agg(*[F.count(c).alias(c) for c in used]).first()
    if all(complete[c] == seq.length for c in used):
        variables = {c: F.col(c) for c in used}
    else:
        variables = {}
        for i, p in usable:
            both = F.col(p.x).isNotNull() & F.col(p.y).isNotNull()
            variables |= {f"{i}_x": F.when(both, F.col(p.x)), f"{i}_y": F.when(both, F.col(p.y))}
    return average_ranks(_with_workload(seq.rows), seq.length, variables, WORKLOAD)


def _with_workload(df: DataFrame) -> DataFrame:
    """Without a category every row belongs to none, so there is nothing to break down by."""
    return df if WORKLOAD in df.columns else df.withColumn(WORKLOAD, F.lit(None).cast("string"))


def spearman(ranks: DataFrame, by: Seq[str] = (), pairs: Seq[Pair] = PAIRS) -> DataFrame:
    """Unrounded Spearman rho per pair from `rank_table`."""
    kind = "group_rank" if by else "rank"

    def variable(i: int, side: str, column: str) -> str | None:
        return next((v for v in (f"{column}_{kind}", f"{i}_{side}_{kind}") if v in ranks.columns), None)

    named = [(i, variable(i, "x", p.x), variable(i, "y", p.y)) for i, p in enumerate(pairs)]
    return _per_pair(ranks, by, [(i, F.col(x), F.col(y)) for i, x, y in named if x and y], "spearman")


def _guarded(value: Column, small: float) -> Column:
    return F.when(F.col("n") < MIN_PAIRS, F.lit(small)).otherwise(value)


def strength(r: Column) -> Column:
    out = F.lit(NO_STRENGTH)
    for floor, name in reversed(STRENGTH_BANDS):
        out = F.when(F.abs(r) >= floor, name).otherwise(out)
    return out


def pair_correlations(
    seq: Sequence, ranks: DataFrame, pairs: Seq[Pair] = PAIRS
) -> DataFrame:
    """(pair_ord, n, pearson_r, pearson_p, spearman_r, spearman_p), rounded."""
    both = pearson(seq.rows, (), pairs).join(spearman(ranks, (), pairs).drop("n", "group_rows"), PAIR)
    return both.select(
        PAIR,
        "n",
        _guarded(stable(F.col("pearson"), 3), 0.0).alias("pearson_r"),
        _guarded(half_even(correlation_p_value("pearson", "n"), 5), 1.0).alias("pearson_p"),
        _guarded(stable(F.col("spearman"), 3), 0.0).alias("spearman_r"),
        _guarded(half_even(correlation_p_value("spearman", "n"), 5), 1.0).alias("spearman_p"),
    )


def correlations_by_workload(
    seq: Sequence, ranks: DataFrame, pairs: Seq[Pair] = PAIRS
) -> DataFrame:
    """(pair_ord, workload_type, pearson_r, spearman_r) for workloads of more than 20 rows."""
    by = (WORKLOAD,)
    rho = spearman(ranks, by, pairs).drop("n", "group_rows")
    both = (
        pearson(_with_workload(seq.rows), by, pairs)
        .where(F.col(WORKLOAD).isNotNull() & (F.col("group_rows") > MIN_GROUP_ROWS))
        .join(rho, [WORKLOAD, PAIR], "left")
    )
    return both.select(
        PAIR,
        WORKLOAD,
        _guarded(stable(F.col("pearson"), 3), 0.0).alias("pearson_r"),
        _guarded(stable(F.col("spearman"), 3), 0.0).alias("spearman_r"),
    )


def describe_pairs(table: DataFrame, pairs: Seq[Pair] = PAIRS) -> DataFrame:
    """Add labels, strength, direction and the interpretation sentence."""

    def constant(attribute: str) -> Column:
        return F.array(*[F.lit(getattr(p, attribute)) for p in pairs])[F.col(PAIR)]

    r = F.col("pearson_r")

    def shown(c: str) -> Column:
        return F.when(F.col("n") < MIN_PAIRS, "0").otherwise(F.coalesce(F.col(c).cast("string"), F.lit("nan")))

    described = table.withColumns(
        {
            "pair": constant("label"),
            "x_col": constant("x"),
            "y_col": constant("y"),
            "strength": strength(r),
            "direction": F.when(r > 0, "positive").otherwise("negative"),
        }
    )
    sentence = F.concat(
        F.col("strength"), F.lit(" "), F.col("direction"), F.lit(" correlation (Pearson r="), shown("pearson_r"),
        F.lit(", Spearman ρ="), shown("spearman_r"), F.lit("). "), constant("expected"), F.lit("."),
    )
    return described.withColumn("interpretation", sentence)


def correlation_report(
    seq: Sequence, ranks: DataFrame | None = None, pairs: Seq[Pair] = PAIRS
) -> DataFrame:
    """One row per pair with both coefficients, labels and the per-workload map."""
    if not usable_pairs(seq.rows, pairs):
        return seq.rows.sparkSession.createDataFrame([], _REPORT)
    ranks = rank_table(seq, pairs) if ranks is None else ranks
    overall = describe_pairs(pair_correlations(seq, ranks, pairs), pairs)
    values = F.struct("pearson_r", "spearman_r")
    nested = (
        correlations_by_workload(seq, ranks, pairs)
        .groupBy(F.col(PAIR).alias("_pair"))
        .agg(F.map_from_entries(F.collect_list(F.struct(F.col(WORKLOAD), values))).alias("by_workload"))
    )
    none = F.map_from_entries(F.array().cast(f"array<struct<k:string,v:{_VALUES}>>"))
    return overall.join(nested, F.col(PAIR) == F.col("_pair"), "left").select(
        PAIR, "pair", "x_col", "y_col", "pearson_r", "pearson_p", "spearman_r", "spearman_p",
        "strength", "direction", "interpretation", F.coalesce("by_workload", none).alias("by_workload"),
    )


_VALUES = "struct<pearson_r:double,spearman_r:double>"
_REPORT = (
    f"{PAIR} int, pair string, x_col string, y_col string, pearson_r double, pearson_p double, spearman_r double, spearman_p double, "
    f"strength string, direction string, interpretation string, by_workload map<string,{_VALUES}>"
)


def correlation_matrix(df: DataFrame, columns: Seq[str] = MATRIX_COLUMNS) -> DataFrame:
    """Pearson matrix in long form (x, y, r); each pair is computed once."""
    have = present(df, columns)
    pairs = [(a, b) for i, a in enumerate(have) for b in have[i:]]
    r = _per_pair(df, (), [(i, F.col(a), F.col(b)) for i, (a, b) in enumerate(pairs)], "r")

    first = F.array(*[F.lit(a) for a, _ in pairs])[F.col(PAIR)]
    second = F.array(*[F.lit(b) for _, b in pairs])[F.col(PAIR)]
    mirrored = F.array(
        F.struct(first.alias("x"), second.alias("y")), F.struct(second.alias("x"), first.alias("y"))
    )
    # The diagonal mirrors onto itself.
    return r.select(F.inline(F.array_distinct(mirrored)), stable(F.col("r"), 3).alias("r"))


def matrix_wide(long: DataFrame, columns: Seq[str] = MATRIX_COLUMNS) -> DataFrame:
    return long.groupBy("x").pivot("y", list(columns)).agg(F.first("r"))


def heatmap_cells(long: DataFrame) -> DataFrame:
    """Matrix cells with display names and two-place text values."""

    def title(c: str) -> Column:
        return F.initcap(F.replace(F.col(c), F.lit("_"), F.lit(" ")))

    return long.select(title("x").alias("x"), title("y").alias("y"), "r", half_even(F.col("r"), 2).alias("label"))
