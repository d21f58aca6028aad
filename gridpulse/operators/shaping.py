"""Filters, listings, samples and trend lines that feed the views."""

from __future__ import annotations

import math
from collections.abc import Sequence as Seq

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gridpulse.operators.rules import RULE
from gridpulse.operators.summaries import SEVERITIES
from gridpulse.schema import ROW, TS, WORKLOAD, present

# Display budgets, sample seed, trend resolution, limit lines.
PLOT_POINTS = 2000
LISTING_ROWS = 200
SAMPLE_ROWS = 2000
SAMPLE_SEED = 42
TREND_POINTS = 100
TREND_MIN_ROWS = 10
TIMELINES = {
    "gpu_cpu": ("gpu_usage", "cpu_usage"),
    "temperature": ("temperature",),
    "memory": ("memory_usage",),
}
LIMIT_LINES = {
    "gpu_cpu": {"Critical": 90},
    "temperature": {"Danger Zone": (85, 100), "Throttle": 90},
    "memory": {"Warning": 85, "Critical": 95},
}


def apply_filters(df: DataFrame, workloads: Seq[str] = (), date_range: tuple | None = None) -> DataFrame:
    """Keep the given workloads (none given: all) and timestamps in the closed range.

    Tables laid out by day (a `date` column) are read for the days of the range only.
    """
    if workloads:
        df = df.where(F.col(WORKLOAD).isin(*workloads))
    if date_range:
        first, last = (F.lit(d).cast("timestamp_ntz") for d in date_range)
        df = df.where(F.col(TS).between(first, last))
        if dict(df.dtypes).get("date") == "date":
            df = df.where(F.col("date").between(F.to_date(first), F.to_date(last)))
    return df


def downsample(df: DataFrame, length: int, points: int = PLOT_POINTS) -> DataFrame:
    """Every n-th row by position, n = max(1, length // points)."""
    return df.where(F.col(ROW) % max(1, length // points) == 0)


def sample_rows(
    df: DataFrame, length: int, ids: Seq[str], size: int = SAMPLE_ROWS, seed: int = SAMPLE_SEED
) -> DataFrame:
    """A reproducible random sample: the rows with the smallest hash of their id.

    Every task keeps only its `size` smallest, so no full sort takes place.
    """
    if length <= size:
        return df
    text = F.concat_ws(":", F.lit(str(seed)), *[F.col(c).cast("string") for c in ids])
    return df.orderBy(F.md5(text), *ids).limit(size)


def trend_fit(df: DataFrame, x: str, y: str) -> DataFrame:
    """Least-squares line on rows with both values: n, slope, intercept, x_min, x_max.

    Slope and intercept are null unless there are more than ten rows.
    """
    both = df.where(F.col(x).isNotNull() & F.col(y).isNotNull())
    enough = F.count(F.lit(1)) > TREND_MIN_ROWS
    return both.agg(
        F.count(F.lit(1)).alias("n"),
        F.when(enough, F.regr_slope(F.col(y), F.col(x))).alias("slope"),
        F.when(enough, F.regr_intercept(F.col(y), F.col(x))).alias("intercept"),
        F.min(x).alias("x_min"),
        F.max(x).alias("x_max"),
    )


def trend_line(fit: DataFrame, points: int = TREND_POINTS) -> DataFrame:
    """Evenly spaced x over the fitted range with the fitted y."""
    step = (F.col("x_max") - F.col("x_min")) / (points - 1)
    return (
        fit.where(F.col("slope").isNotNull())
        .select("*", F.explode(F.sequence(F.lit(0), F.lit(points - 1))).alias("point"))
        .withColumn("x", F.col("x_min") + F.col("point") * step)
        .select("point", "x", (F.col("intercept") + F.col("slope") * F.col("x")).alias("y"))
    )


def scatter(df: DataFrame, length: int, ids: Seq[str], x: str, y: str) -> tuple[DataFrame, DataFrame]:
    """Sampled points of a pair and the trend line through them."""
    points = sample_rows(df, length, ids).select(*ids, x, y)
    return points, trend_line(trend_fit(points, x, y))


def timeline(df: DataFrame, length: int, metrics: Seq[str]) -> DataFrame:
    """Downsampled (timestamp, metric, value) rows of a line chart."""
    return downsample(df, length).unpivot([TS], list(metrics), "metric", "value")


def limit_lines(spark: SparkSession) -> DataFrame:
    """(timeline, label, low, high): the limits drawn into the timelines; a line has low = high, a zone has not."""
    rows = [
        (name, label, *(map(float, at) if isinstance(at, tuple) else (float(at), float(at))))
        for name, limits in LIMIT_LINES.items()
        for label, at in limits.items()
    ]
    return spark.createDataFrame(rows, "timeline string, label string, low double, high double")


def in_limits(df: DataFrame, limits: DataFrame, columns: Seq[str], width: float = 5.0) -> DataFrame:
    """An interval join: every reading (the given columns, as `metric` and `value`) with every limit of its metric that it reaches.

    `limits` has metric, low (included) and high (excluded; null: no end), and what else should come along.  Values are cut into
    bins of the width, limits are repeated for their bins, and bins are joined by equality, so that a reading meets only the limits of
    its bin.  Beyond the last end that any limit has, all bins are one.
    """
    ends = limits.agg(F.min("low"), F.max(F.greatest("low", F.coalesce("high", "low")))).first()
    if ends[0] is None:
        first = last = 0
    else:
        first, last = math.floor(ends[0] / width), math.floor(ends[1] / width) + 1
    bin_of = lambda x: F.greatest(F.lit(first - 1), F.least(F.lit(last), F.floor(x / width))).cast("int")
    binned = limits.withColumnRenamed("metric", "_metric").withColumn(
        "_bin", F.explode(F.sequence(bin_of(F.col("low")), F.coalesce(bin_of(F.col("high")), F.lit(last))))
    )
    kept = [c for c in df.columns if c not in columns]
    readings = df.unpivot(kept, list(columns), "metric", "value").where("value is not null")
    within = (F.col("value") >= F.col("low")) & (F.col("high").isNull() | (F.col("value") < F.col("high")))
    met = (F.col("metric") == F.col("_metric")) & (bin_of(F.col("value")) == F.col("_bin")) & within
    return readings.join(binned, met).drop("_metric", "_bin")


def limit_zones(spark: SparkSession) -> DataFrame:
    """The limits of the timelines as intervals (metric, timeline, label, low, high): a line has no upper end."""
    rows = [
        (metric, name, label, *(map(float, at) if isinstance(at, tuple) else (float(at), None)))
        for name, limits in LIMIT_LINES.items()
        for metric in TIMELINES[name]
        for label, at in limits.items()
    ]
    return spark.createDataFrame(rows, "metric string, timeline string, label string, low double, high double")


def limit_readings(df: DataFrame) -> DataFrame:
    """What the timelines' limits say about a series: per metric and limit the readings that reach it, how many workloads they belong to, the first
    and last time, and the peak."""
    met = in_limits(df.select(TS, WORKLOAD, *present(df)), limit_zones(df.sparkSession), present(df))
    return met.groupBy("metric", "timeline", "label").agg(
        F.count("*").alias("readings"),
        F.count_distinct(WORKLOAD).alias("workloads"),
        F.min(TS).alias("first_at"),
        F.max(TS).alias("last_at"),
        F.max("value").alias("peak"),
    )


def bottleneck_timeline(bottlenecks: DataFrame) -> DataFrame:
    """(timestamp, issue, severity, reason) with the rank severities are drawn in."""
    rank = F.array_position(F.array(*[F.lit(s) for s in SEVERITIES]), F.col("severity")).cast("int")
    return bottlenecks.select(TS, "issue", "severity", "reason", rank.alias("severity_rank"))


def _minute() -> Column:
    return F.substring(F.col(TS).cast("string"), 1, 16).alias(TS)


def bottleneck_listing(bottlenecks: DataFrame, rows: int = LISTING_ROWS) -> DataFrame:
    """The first events in time order, time shown to the minute."""
    first = bottlenecks.orderBy(ROW, RULE).limit(rows)
    return first.select(_minute(), "issue", "severity", "reason", "recommendation")


def anomaly_listing(anomalies: DataFrame, rows: int = LISTING_ROWS) -> DataFrame:
    """The first confirmed anomalies in time order, time shown to the minute."""
    first = anomalies.where("is_anomaly").orderBy(ROW, "metric_ord").limit(rows)
    return first.select(_minute(), "metric", "value", "z_score", "confidence", "methods_flagged")
