"""Gap filling, clipping, normalising and null accounting."""

from __future__ import annotations

from collections.abc import Sequence as Seq

from pyspark.sql import Column, DataFrame, Row, Window, WindowSpec
from pyspark.sql import functions as F

from gridpulse.functions.keyed import joined_by_key
from gridpulse.functions.rounding import half_even
from gridpulse.operators.sequence import CARRY, Sequence
from gridpulse.schema import METRICS, ROW, VALID_RANGE, present

FILL_LIMIT = 3  # rows a value is carried forward before interpolation starts


def forward_fill(seq: Sequence, limit: int = FILL_LIMIT, metrics: Seq[str] = METRICS) -> Sequence:
    """Each null takes the last valid value at most `limit` rows back."""

    def fill(df: DataFrame, w: WindowSpec) -> DataFrame:
        frame = w.rowsBetween(-limit, 0)
        return df.withColumns({c: F.last(c, ignorenulls=True).over(frame) for c in present(df, metrics)})

    return seq.trailing(limit, fill)


def fill_gaps(seq: Sequence, metrics: Seq[str] = METRICS, limit: int = FILL_LIMIT) -> Sequence:
    """Forward fill up to `limit` rows, then interpolate linearly by position.

    Nulls before the first valid value take it, nulls after the last valid value
    take that one; a column without any value stays null.
    """
    return seq.with_rows(seq.own(filled_blocks(seq, metrics, limit, halo=0)))


def filled_blocks(
    seq: Sequence, metrics: Seq[str], limit: int, halo: int, edges: DataFrame | None = None
) -> DataFrame:
    """`fill_gaps` in blocked form: the halo rows are filled as well, so trailing
    windows over the filled values need no further shuffle."""
    columns = present(seq.rows, metrics)
    earlier = seq.forward.rowsBetween(Window.unboundedPreceding, 0)
    later = seq.backward.rowsBetween(Window.unboundedPreceding, 0)

    def nearest(suffix: str, window) -> dict[str, Column]:
        return {
            f"{c}_{suffix}{part}": F.last(f"{c}{part}", ignorenulls=True).over(window)
            for c in columns
            for part in ("", "_at")
        }

    # The backward windows come first: what follows shares the forward sort.
    around = (
        seq.carried(columns, halo, edges)
        .withColumns(nearest("next", later))
        .withColumns(nearest("prev", earlier))
        .where(~F.col(CARRY))
    )
    helpers = [f"{c}_{s}" for c in columns for s in ("at", "next", "next_at", "prev", "prev_at")]
    return around.withColumns({c: _filled(c, limit) for c in columns}).drop(CARRY, *helpers)


def _filled(c: str, limit: int) -> Column:
    before, before_at = F.col(f"{c}_prev"), F.col(f"{c}_prev_at")
    after, after_at = F.col(f"{c}_next"), F.col(f"{c}_next_at")
    distance = F.col(ROW) - before_at
    return (
        F.when(F.col(c).isNotNull(), F.col(c))
        .when(before_at.isNull(), after)
        .when((distance <= limit) | after_at.isNull(), before)
        .otherwise(before + (after - before) * (distance - limit) / (after_at - before_at - limit))
    )


def clip(df: DataFrame, ranges: dict[str, tuple[float, float]] = VALID_RANGE) -> DataFrame:
    """Limit each metric to its valid range; null stays null."""
    return df.withColumns({c: _clipped(F.col(c), c, ranges) for c in present(df, ranges)})


def _clipped(value: Column, metric: str, ranges=VALID_RANGE) -> Column:
    low, high = ranges[metric]
    # greatest/least skip nulls, so a null would turn into the lower bound.
    return F.when(value.isNotNull(), F.greatest(F.lit(low), F.least(value, F.lit(high))))


def clean(seq: Sequence) -> Sequence:
    filled = fill_gaps(seq)
    return filled.with_rows(clip(filled.rows))


def value_ranges(df: DataFrame, metrics: Seq[str] = METRICS) -> DataFrame:
    """One row: `<metric>_min` and `<metric>_max`."""
    columns = present(df, metrics)
    return df.agg(
        *[F.min(c).alias(f"{c}_min") for c in columns],
        *[F.max(c).alias(f"{c}_max") for c in columns],
    )


def cleaned_ranges(edges: DataFrame, metrics: Seq[str] = METRICS) -> Row:
    """The value ranges cleaning will produce, from the edge summary it needs anyway.

    Filling only copies values or interpolates between two of them, and clipping
    is monotone, so both extremes are clipped extremes of the valid raw values.
    """
    columns = [c for c in metrics if f"{c}_min" in edges.columns]
    return edges.agg(
        *[_clipped(F.min(f"{c}_min"), c).alias(f"{c}_min") for c in columns],
        *[_clipped(F.max(f"{c}_max"), c).alias(f"{c}_max") for c in columns],
    ).first()


def normalize(df: DataFrame, ranges: Row | None = None) -> DataFrame:
    """Add `<metric>_normalized` = (x - min) / (max - min), 0 for a constant metric.

    `ranges` is the one row of `value_ranges` when it is known already.
    """
    ranges = value_ranges(df).first() if ranges is None else ranges

    def scaled(c: str) -> Column:
        low, high = ranges[f"{c}_min"], ranges[f"{c}_max"]
        if low is None:
            return F.lit(None).cast("double")
        if low == high:
            return F.lit(0.0)
        return half_even((F.col(c) - low) / (high - low), 4)

    return df.withColumns({f"{c}_normalized": scaled(c) for c in present(df)})


def normalize_per(df: DataFrame, per: Seq[str]) -> DataFrame:
    """Add `<metric>_normalized` against the range of the row's key; 0 for a metric that is constant in the key."""
    columns = present(df)
    ranges = df.groupBy(*per).agg(*[f(c).alias(f"_{n}_{c}") for c in columns for n, f in (("min", F.min), ("max", F.max))])
    joined = joined_by_key(df, ranges, per)

    def scaled(c: str) -> Column:
        low, high = F.col(f"_min_{c}"), F.col(f"_max_{c}")
        return F.when(low == high, 0.0).otherwise(half_even((F.col(c) - low) / F.nullif(high - low, F.lit(0.0)), 4))

    return joined.withColumns({f"{c}_normalized": scaled(c) for c in columns}).drop(*[f"_{n}_{c}" for c in columns for n in ("min", "max")])


def null_counts(df: DataFrame, metrics: Seq[str] = METRICS) -> DataFrame:
    """Missing cells per column, long form (metric, missing, total)."""
    columns = present(df, metrics)
    counted = df.agg(
        F.count(F.lit(1)).alias("total"), *[F.count_if(F.col(c).isNull()).alias(c) for c in columns]
    )
    return counted.unpivot("total", columns, "metric", "missing")


def missing_cells(df: DataFrame, metrics: Seq[str] = METRICS) -> DataFrame:
    """Missing cells over the whole frame, one row."""
    return null_counts(df, metrics).agg(F.coalesce(F.sum("missing"), F.lit(0)).alias("missing"))
