"""Aggregates behind the dashboard and the report."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gridpulse.functions.quantiles import exact_quantiles
from gridpulse.functions.rounding import denoise, stable
from gridpulse.operators.rules import RULE, RULES
from gridpulse.schema import ROW, TS, WORKLOAD, complete, present

# Display names, gauge limits (good, warn), severity levels.
METRIC_LABELS = {
    "gpu_usage": "GPU Usage (%)",
    "cpu_usage": "CPU Usage (%)",
    "memory_usage": "Memory Usage (%)",
    "temperature": "Temperature (°C)",
    "power_consumption": "Power (W)",
}
GAUGES = (
    ("GPU Usage", "gpu_usage", 70, 85),
    ("Temperature", "temperature", 70, 85),
    ("Memory Usage", "memory_usage", 70, 85),
    ("Power Draw", "power_consumption", 60, 80),
)
SEVERITIES = ("Critical", "Warning", "Medium")
REPORT_CRITICAL_ABOVE = 50


def _counts(df: DataFrame, key: Column | str, name: str = "event_count") -> DataFrame:
    return df.groupBy(key).agg(F.count(F.lit(1)).alias(name))


def _hour() -> Column:
    return F.hour(TS).alias("hour")


# -- bottleneck events -------------------------------------------------------------


def bottlenecks_by_type(bottlenecks: DataFrame) -> DataFrame:
    return _counts(bottlenecks, "issue")


def bottlenecks_by_severity(bottlenecks: DataFrame) -> DataFrame:
    """Every level is present, with 0 when it did not occur."""
    row = bottlenecks.agg(*[F.count_if(F.col("severity") == s).alias(s) for s in SEVERITIES])
    return row.unpivot([], list(SEVERITIES), "severity", "event_count")


def top_hours(bottlenecks: DataFrame, k: int = 5) -> DataFrame:
    """The k hours with most events, earlier hours first among equals."""
    return _counts(bottlenecks, _hour()).orderBy(F.desc("event_count"), "hour").limit(k)


def _count_by(cells: Column, key: str) -> Column:
    """Counts summed by one key over an array of histogram cells: an array of (key, event_count)."""
    keys = F.array_distinct(F.transform(cells, lambda c: c[key]))

    def total(k: Column) -> Column:
        own = F.filter(cells, lambda c: c[key].eqNullSafe(k))
        return F.aggregate(own, F.lit(0).cast("long"), lambda n, c: n + c["event_count"])

    return F.transform(keys, lambda k: F.struct(k.alias("key"), total(k).alias("event_count")))


def _histogram(events: DataFrame, *keys: str | Column) -> DataFrame:
    """One row with all cells of a histogram, which is small: issues, levels and hours are few."""
    counted = events.groupBy(*keys).agg(F.count(F.lit(1)).alias("event_count"))
    return counted.agg(F.collect_list(F.struct("*")).alias("cells"))


def _total(cells: Column) -> Column:
    return F.aggregate(cells, F.lit(0).cast("long"), lambda n, c: n + c["event_count"])


def bottleneck_summary(bottlenecks: DataFrame) -> DataFrame:
    """One row: total, by_type, by_severity, most_affected_hours; zero and empty maps without events."""
    return summary_of_issues(_histogram(bottlenecks, "issue", "severity", _hour()))


def summary_of_issues(histogram: DataFrame) -> DataFrame:
    """The same from one row of cells (issue, severity, hour, event_count)."""
    cells = F.col("cells")
    by_size = F.array_sort(F.transform(_count_by(cells, "hour"), lambda e: F.struct((-e["event_count"]).alias("less"), e["key"].alias("key"))))
    top = F.transform(F.slice(by_size, 1, 5), lambda e: F.struct(e["key"].alias("key"), (-e["less"]).alias("event_count")))
    return histogram.select(
        _total(cells).alias("total"),
        F.map_from_entries(_count_by(cells, "issue")).alias("by_type"),
        F.map_from_entries(_count_by(cells, "severity")).alias("by_severity"),
        F.map_from_entries(top).alias("most_affected_hours"),
    )


def bottleneck_frequency(bottlenecks: DataFrame) -> DataFrame:
    """Events per issue with the severity of its first event.

    The first event is found by a number (position, rule), which keeps the
    aggregate in fixed-width hash buffers; the severity follows from the rule.
    """
    first = F.min(F.col(ROW) * len(RULES) + F.col(RULE))
    grouped = bottlenecks.groupBy("issue").agg(F.count(F.lit(1)).alias("event_count"), first.alias("first"))
    severity = F.array(*[F.lit(r.severity) for r in RULES])[(F.col("first") % len(RULES)).cast("int")]
    return grouped.select("issue", "event_count", severity.alias("severity"))


def issue_counts(bottlenecks: DataFrame) -> DataFrame:
    """One row with the event count of every issue, 0 when it did not occur."""
    return bottlenecks.agg(*[F.count_if(F.col("issue") == r.issue).alias(r.id) for r in RULES])


def report_issue_levels(bottlenecks: DataFrame) -> DataFrame:
    """Issue counts with the level the report shows, which also looks at frequency."""
    return with_report_level(bottlenecks_by_type(bottlenecks))


def with_report_level(counts: DataFrame) -> DataFrame:
    critical = F.col("issue").contains("Critical") | (F.col("event_count") > REPORT_CRITICAL_ABOVE)
    return counts.withColumn(
        "report_level", F.when(critical, "Critical").otherwise("Warning")
    )


# -- anomalies -----------------------------------------------------------------------


def anomalies_by_metric(anomalies: DataFrame) -> DataFrame:
    return _counts(anomalies.where("is_anomaly"), "metric")


def anomalies_by_confidence(anomalies: DataFrame) -> DataFrame:
    return _counts(anomalies, "confidence")


def confidence_counts(anomalies: DataFrame) -> DataFrame:
    """One row: flagged points per confidence level, 0 when there are none."""
    return anomalies.agg(
        *[F.count_if(F.col("confidence") == level).alias(level) for level in ("high", "medium", "low")]
    )


def anomalies_by_hour(anomalies: DataFrame) -> DataFrame:
    return _counts(anomalies.where("is_anomaly"), _hour()).orderBy("hour")


def anomaly_totals(anomalies: DataFrame) -> DataFrame:
    return anomalies.agg(
        F.count(F.lit(1)).alias("total"), F.count_if(F.col("is_anomaly")).alias("confirmed")
    )


def anomaly_summary(anomalies: DataFrame) -> DataFrame:
    """One row: totals and maps by metric, confidence and hour; empty maps without anomalies."""
    return summary_of_hits(_histogram(anomalies, "metric", "confidence", "is_anomaly", _hour()))


def summary_of_hits(histogram: DataFrame) -> DataFrame:
    """The same from one row of cells (metric, confidence, is_anomaly, hour, event_count)."""
    cells = F.col("cells")
    confirmed = F.filter(cells, lambda c: c["is_anomaly"])
    return histogram.select(
        _total(cells).alias("total"),
        _total(confirmed).alias("confirmed"),
        F.map_from_entries(_count_by(confirmed, "metric")).alias("by_metric"),
        F.map_from_entries(_count_by(cells, "confidence")).alias("by_confidence"),
        F.map_from_entries(_count_by(confirmed, "hour")).alias("hourly_distribution"),
    )


def anomaly_heatmap(anomalies: DataFrame) -> DataFrame:
    """Confirmed anomalies per metric, one column per hour (`h0` … `h23`), 0 when none."""
    hour = F.hour(TS)
    return anomalies.where("is_anomaly").groupBy("metric").agg(
        *[F.count_if(hour == h).alias(f"h{h}") for h in range(24)]
    )


# -- metrics -------------------------------------------------------------------------


def kpi_row(metrics: DataFrame, bottlenecks: DataFrame, anomalies: DataFrame) -> DataFrame:
    """Mean and max of each metric with the event counts, as the KPI cards show them."""
    columns = present(metrics)
    digits = {c: 0 if c == "power_consumption" else 1 for c in columns}
    return metrics.agg(
        *[stable(F.avg(c), digits[c]).alias(f"avg_{c}") for c in columns],
        *[stable(F.max(c), 0).alias(f"max_{c}") for c in columns],
    ).withColumns(
        {
            "bottleneck_events": bottlenecks.agg(F.count(F.lit(1))).scalar(),
            "confirmed_anomalies": anomalies.agg(F.count_if(F.col("is_anomaly"))).scalar(),
        }
    )


def long_stats(row: DataFrame, columns: list[str], stats: dict[str, str], label=lambda c: c) -> DataFrame:
    """Turn one wide row of `<stat>_<column>` cells into one row per column."""
    cells = [
        F.struct(
            F.lit(label(c)).alias("metric"), *[F.col(f"{s}_{c}").alias(name) for s, name in stats.items()]
        )
        for c in columns
    ]
    return row.select(F.inline(F.array(*cells)))


def metric_summary(metrics: DataFrame) -> DataFrame:
    """Mean, max, min and standard deviation per metric, one place."""
    columns = present(metrics)
    functions = {"mean": F.avg, "max": F.max, "min": F.min, "std": F.stddev_samp}
    row = metrics.agg(
        *[stable(f(c), 1).alias(f"{s}_{c}") for c in columns for s, f in functions.items()]
    )
    return long_stats(row, columns, {s: s for s in functions}, METRIC_LABELS.get)


def hourly_averages(metrics: DataFrame) -> DataFrame:
    return (
        metrics.groupBy("hour_of_day")
        .agg(*[stable(F.avg(c), 1).alias(c) for c in present(metrics)])
        .orderBy("hour_of_day")
    )


def power_by_workload(metrics: DataFrame) -> DataFrame:
    return metrics.groupBy(WORKLOAD).agg(
        denoise(F.avg("power_consumption")).alias("avg_power"),
        F.max("power_consumption").alias("max_power"),
    )


def workload_distribution(metrics: DataFrame) -> DataFrame:
    """Rows and share per workload; the total is summed over the few counted rows."""
    counted = _counts(metrics.where(F.col(WORKLOAD).isNotNull()), WORKLOAD, "row_count")
    total = F.sum("row_count").over(Window.partitionBy(F.lit(0)))
    return counted.withColumn("share", F.col("row_count") / total)


def distinct_workloads(metrics: DataFrame) -> DataFrame:
    return metrics.select(WORKLOAD).distinct()


def health_gauges(metrics: DataFrame) -> DataFrame:
    """Mean against the gauge limits; power is scaled to at most 100.  Metrics that do not exist have no gauge."""
    gauges = [g for g in GAUGES if g[1] in metrics.columns]
    if not gauges:
        return metrics.sparkSession.createDataFrame([], "gauge string, value double, status string")
    return gauges_of(metrics.agg(*[F.avg(c).alias(c) for _, c, _, _ in gauges]))


def gauges_of(row: DataFrame) -> DataFrame:
    """The gauges of those metrics whose means the row has."""

    def gauge(name: str, c: str, good: int, warn: int) -> Column:
        mean = denoise(F.col(c))
        value = F.least(F.lit(100.0), mean / 5) if c == "power_consumption" else mean
        status = F.when(value <= good, "good").when(value <= warn, "warn").otherwise("critical")
        return F.struct(F.lit(name).alias("gauge"), value.alias("value"), status.alias("status"))

    return row.select(F.inline(F.array(*[gauge(*g) for g in GAUGES if g[1] in row.columns])))


def describe_metrics(metrics: DataFrame) -> DataFrame:
    """Count, mean, std, min, quartiles and max per metric."""
    columns = present(metrics)
    functions = {"count": F.count, "mean": F.avg, "std": F.stddev_samp, "min": F.min, "max": F.max}
    rounded = {"mean", "std"}
    row = metrics.agg(
        *[
            (denoise(f(c)) if s in rounded else f(c)).alias(f"{s}_{c}")
            for c in columns
            for s, f in functions.items()
        ]
    )
    quartiles = exact_quantiles(metrics, columns, (0.25, 0.5, 0.75)).select(F.struct("*")).scalar()
    names = {"q25": 0, "q50": 1, "q75": 2}
    row = row.withColumn("_q", quartiles).withColumns(
        {f"{q}_{c}": denoise(F.col(f"_q.{c}")[k]) for c in columns for q, k in names.items()}
    )
    order = ("count", "mean", "std", "min", "q25", "q50", "q75", "max")
    return long_stats(row, columns, {s: s for s in order})


# -- report ----------------------------------------------------------------------------


def data_range(metrics: DataFrame) -> DataFrame:
    """First and last day, and the number of rows."""

    def day(c: Column) -> Column:
        return F.date_format(c, "yyyy-MM-dd")

    return metrics.agg(
        F.concat(day(F.min(TS)), F.lit(" to "), day(F.max(TS))).alias("data_range"),
        F.count(F.lit(1)).alias("total_rows"),
    )


def _score(issues: Column) -> Column:
    return F.greatest(F.lit(0), F.least(F.lit(100), 100 - F.floor(issues / 5))).cast("int")


def health_score(bottlenecks: DataFrame, anomalies: DataFrame) -> DataFrame:
    """100 minus one point per five issues, between 0 and 100."""
    totals = bottlenecks.agg(F.count(F.lit(1)).alias("total_bottlenecks")).withColumn(
        "total_anomalies", anomalies.agg(F.count_if(F.col("is_anomaly"))).scalar()
    )
    return with_score(totals)


def with_score(totals: DataFrame) -> DataFrame:
    return totals.withColumn("health_score", _score(F.col("total_bottlenecks") + F.col("total_anomalies")))


def report_header(metrics: DataFrame, bottlenecks: DataFrame, anomalies: DataFrame) -> DataFrame:
    averages = complete(metrics).agg(
        stable(F.avg("gpu_usage"), 1).alias("avg_gpu"),
        stable(F.avg("temperature"), 1).alias("avg_temp"),
        stable(F.avg("power_consumption"), 0).alias("avg_power"),
        F.count(F.lit(1)).alias("total_rows"),
        F.concat_ws(
            " to ", F.date_format(F.min(TS), "yyyy-MM-dd"), F.date_format(F.max(TS), "yyyy-MM-dd")
        ).alias("data_range"),
    )
    scored = health_score(bottlenecks, anomalies).select(F.struct("*")).scalar()
    return averages.withColumn("_s", scored).select(*averages.columns, "_s.*")
