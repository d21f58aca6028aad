"""Report aggregates from small tables of cells, so that each input is read once whatever the report shows.

A cell holds what one scan knows of one (hour of day, workload), (issue, severity, hour) or (metric, confidence, verdict, hour): counts and, for
metrics, count, mean, variance, minimum and maximum.  Everything below is derived from cells: there are at most 24 per workload,
192 and 360 of them, and all of them merge, so that Spark adds them up before it shuffles.  Results equal those of `summaries` and `findings`.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gridpulse.functions.rounding import denoise, stable
from gridpulse.operators import findings, summaries
from gridpulse.schema import METRICS, TS, WORKLOAD, complete

_HOUR = "hour_of_day"


def metric_cells(metrics: DataFrame) -> DataFrame:
    """(hour_of_day, workload_type, rows, first, last, and n, mean, var, low, high of every metric); absent metrics are null."""
    parts = {"n": F.count, "mean": F.avg, "var": F.var_pop, "low": F.min, "high": F.max}
    return complete(metrics).groupBy(_HOUR, WORKLOAD).agg(
        F.count(F.lit(1)).alias("rows"), F.min(TS).alias("first"), F.max(TS).alias("last"),
        *[f(c).alias(f"{name}_{c}") for c in METRICS for name, f in parts.items()],
    )


def issue_cells(bottlenecks: DataFrame) -> DataFrame:
    """(issue, severity, hour, event_count)."""
    return bottlenecks.groupBy("issue", "severity", F.hour(TS).alias("hour")).agg(F.count(F.lit(1)).alias("event_count"))


def hit_cells(anomalies: DataFrame) -> DataFrame:
    """(metric, confidence, is_anomaly, hour, event_count)."""
    keys = ("metric", "confidence", "is_anomaly", F.hour(TS).alias("hour"))
    return anomalies.groupBy(*keys).agg(F.count(F.lit(1)).alias("event_count"))


def _mean(c: str, when: Column | None = None) -> Column:
    """The mean over all rows of the cells for which `when` holds; null if they have no reading."""
    n = F.col(f"n_{c}") if when is None else F.when(when, F.col(f"n_{c}"))
    return F.try_divide(F.sum(n * F.col(f"mean_{c}")), F.sum(n))


def _events(when: Column | None = None) -> Column:
    n = F.col("event_count") if when is None else F.when(when, F.col("event_count"))
    return F.coalesce(F.sum(n), F.lit(0).cast("long"))


# -- metrics -------------------------------------------------------------------------


def kpi_row(metrics: DataFrame, issues: DataFrame, hits: DataFrame, columns: list[str]) -> DataFrame:
    return metrics.agg(
        *[stable(_mean(c), 0 if c == "power_consumption" else 1).alias(f"avg_{c}") for c in columns],
        *[stable(F.max(f"high_{c}"), 0).alias(f"max_{c}") for c in columns],
    ).withColumns(
        {
            "bottleneck_events": issues.agg(_events()).scalar(),
            "confirmed_anomalies": hits.agg(_events(F.col("is_anomaly"))).scalar(),
        }
    )


def metric_summary(metrics: DataFrame, columns: list[str]) -> DataFrame:
    """Mean, max, min and standard deviation; deviations are taken from the overall mean, so nothing cancels out."""
    means = metrics.agg(*[_mean(c).alias(c) for c in columns]).select(F.struct("*")).scalar()

    def deviation(c: str) -> Column:
        n, off = F.col(f"n_{c}"), F.col(f"mean_{c}") - F.col(f"_m.{c}")
        return F.sqrt(F.try_divide(F.sum(n * (F.col(f"var_{c}") + off * off)), F.sum(n) - 1))

    functions = {"mean": _mean, "max": lambda c: F.max(f"high_{c}"), "min": lambda c: F.min(f"low_{c}"), "std": deviation}
    row = metrics.withColumn("_m", means).agg(*[stable(f(c), 1).alias(f"{s}_{c}") for c in columns for s, f in functions.items()])
    return summaries.long_stats(row, columns, {s: s for s in functions}, summaries.METRIC_LABELS.get)


def hourly_averages(metrics: DataFrame, columns: list[str]) -> DataFrame:
    return metrics.groupBy(_HOUR).agg(*[stable(_mean(c), 1).alias(c) for c in columns]).orderBy(_HOUR)


def power_by_workload(metrics: DataFrame) -> DataFrame:
    power = "power_consumption"
    return metrics.groupBy(WORKLOAD).agg(denoise(_mean(power)).alias("avg_power"), F.max(f"high_{power}").alias("max_power"))


def workload_distribution(metrics: DataFrame) -> DataFrame:
    counted = metrics.where(F.col(WORKLOAD).isNotNull()).groupBy(WORKLOAD).agg(F.sum("rows").alias("row_count"))
    return counted.withColumn("share", F.col("row_count") / F.sum("row_count").over(Window.partitionBy(F.lit(0))))


def health_gauges(metrics: DataFrame, columns: list[str]) -> DataFrame:
    gauges = [c for _, c, _, _ in summaries.GAUGES if c in columns]
    if not gauges:
        return metrics.sparkSession.createDataFrame([], "gauge string, value double, status string")
    return summaries.gauges_of(metrics.agg(*[_mean(c).alias(c) for c in gauges]))


def _days() -> Column:
    return F.concat_ws(" to ", *[F.date_format(c, "yyyy-MM-dd") for c in (F.min("first"), F.max("last"))])


def report_header(metrics: DataFrame, issues: DataFrame, hits: DataFrame) -> DataFrame:
    averages = metrics.agg(
        stable(_mean("gpu_usage"), 1).alias("avg_gpu"),
        stable(_mean("temperature"), 1).alias("avg_temp"),
        stable(_mean("power_consumption"), 0).alias("avg_power"),
        F.coalesce(F.sum("rows"), F.lit(0)).alias("total_rows"),
        _days().alias("data_range"),
    )
    totals = issues.agg(_events().alias("total_bottlenecks")).withColumn("total_anomalies", hits.agg(_events(F.col("is_anomaly"))).scalar())
    scored = summaries.with_score(totals).select(F.struct("*")).scalar()
    return averages.withColumn("_s", scored).select(*averages.columns, "_s.*")


# -- events --------------------------------------------------------------------------


def issue_levels(issues: DataFrame) -> DataFrame:
    return summaries.with_report_level(issues.groupBy("issue").agg(F.sum("event_count").alias("event_count")))


def anomaly_totals(hits: DataFrame) -> DataFrame:
    return hits.agg(_events().alias("total"), _events(F.col("is_anomaly")).alias("confirmed"))


def anomalies_by_metric(hits: DataFrame) -> DataFrame:
    return hits.where("is_anomaly").groupBy("metric").agg(F.sum("event_count").alias("event_count"))


def bottleneck_summary(issues: DataFrame) -> DataFrame:
    return summaries.summary_of_issues(issues.agg(F.collect_list(F.struct("*")).alias("cells")))


def anomaly_summary(hits: DataFrame) -> DataFrame:
    return summaries.summary_of_hits(hits.agg(F.collect_list(F.struct("*")).alias("cells")))


def finding_inputs(metrics: DataFrame, issues: DataFrame, hits: DataFrame) -> DataFrame:
    """One row with every number that findings and strategies need."""
    training = F.col(WORKLOAD) == "training"
    row = metrics.agg(
        F.coalesce(F.sum("rows"), F.lit(0)).alias("total_rows"),
        denoise(_mean("temperature")).alias("avg_temp"),
        F.max("high_temperature").alias("max_temp"),
        denoise(_mean("power_consumption")).alias("avg_power"),
        denoise(_mean("gpu_usage", F.col(_HOUR).isin(*findings.OFF_PEAK_HOURS))).alias("offpeak_gpu"),
        F.coalesce(F.sum(F.when(training, F.col("rows"))), F.lit(0)).alias("train_rows"),
        denoise(_mean("cpu_usage", training)).alias("train_cpu"),
        denoise(_mean("gpu_usage", training)).alias("train_gpu"),
    )
    by_hour = issues.groupBy("issue", "hour").agg(F.sum("event_count").alias("cnt"))
    counted = hits.groupBy("metric").agg(_events(F.col("is_anomaly")).alias("hits"), _events(F.col("confidence") == "high").alias("high"))
    return findings.joined_inputs(row, findings.issue_inputs(by_hour), findings.hit_inputs(counted))
