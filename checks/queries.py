"""One registered query per operator, over the metric series read from `events`.

Queries on stored results share one analysis run per session and data folder,
as a user's views share the tables of their last run.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridpulse.functions.rounding import denoise, stable
from gridpulse.operators import anomalies, cleaning, correlation, features, findings, long_frames, rules, shaping, summaries
from gridpulse.operators.sequence import Sequence
from gridpulse.plans import catalog
from gridpulse.plans.report import ReportCells
from gridpulse.plans.run import Run, analyse, prepare
from gridpulse.plans.stored import open_run, save_run
from gridpulse.schema import (
    BOTTLENECKS,
    CLEANED_METRICS,
    METRICS,
    NORMALIZED,
    SYSTEM_METRICS,
    TS,
    WORKLOAD,
)
from gridpulse.sources import sinks, tables
from gridpulse.sources.metrics import metrics_from_events, read_csv
from gridpulse.workspace import new_path

ID = "event_id"
ORDER = (TS, ID)

_runs: dict[tuple[str, str], Run] = {}


def run_of(spark: SparkSession, sf_dir: str) -> Run:
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _runs:
        _runs[key] = analyse(metrics_from_events(spark, sf_dir), ORDER, keep=(ID,))
    return _runs[key]


def raw_sequence(run: Run) -> Sequence:
    return run.metrics.with_rows(run.raw)


def cleaned_sequence(run: Run) -> Sequence:
    """Stored cleaned metrics, as input of operators that derive more from them."""
    return run.metrics.with_rows(run.metrics.rows.select(ID, TS, *METRICS, WORKLOAD, "row_idx"))


def _source(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metrics_from_events(spark, sf_dir).select(ID, TS, *METRICS, WORKLOAD)


def _by_host(spark: SparkSession, sf_dir: str) -> Sequence:
    return Sequence.of(metrics_from_events(spark, sf_dir), ORDER, keys=("host_id",))


def _csv_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    run = run_of(spark, sf_dir)
    path = sinks.save_cleaned_csv(run.metrics.rows, new_path(spark, "csv"))
    return read_csv(spark, path, CLEANED_METRICS)


def _raw_csv_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = sinks.save_raw_csv(metrics_from_events(spark, sf_dir), new_path(spark, "csv"), days=30)
    return read_csv(spark, path)


def _table_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    run = run_of(spark, sf_dir)
    path = sinks.save_metrics(run.metrics.rows, new_path(spark, "table"))
    return spark.read.parquet(path).select(*SYSTEM_METRICS.names)


def _bottleneck_sink(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The versioned table after one replacement: nothing of its first content is left."""
    run, path = run_of(spark, sf_dir), new_path(spark, "table")
    sinks.save_bottlenecks(run.bottlenecks.where("severity = 'Critical'"), path, versioned=True)
    sinks.save_bottlenecks(run.bottlenecks, path, versioned=True)
    return tables.read(spark, path)


def _anomaly_sink(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = sinks.save_anomalies(run_of(spark, sf_dir).anomalies, new_path(spark, "table"), versioned=True)
    return tables.read(spark, path)


#: A user's own rules; the second needs a column that the table below lacks, and finds nothing.
OWN_RULES = (
    rules.Rule(
        "warm_and_idle", "temperature > 75 AND gpu_usage < 30", ("temperature", "gpu_usage"), "Warm and Idle", "Medium", "🟡",
        "Temperature {temperature}°C at {gpu_usage}% GPU", "Check the fans",
    ),
    rules.Rule("fan_stopped", "fan_speed = 0", ("fan_speed",), "Fan Stopped", "Critical", "🔴", "Fan at {fan_speed}", "Replace it"),
)
OWN_PAIRS = (correlation.Pair("memory_usage", "power_consumption", "Memory × Power", "Weak"), correlation.Pair("fan_speed", "temperature", "Fan × Heat", "-"))
LONG_FRAME = 5000


def _user_rules(metrics: DataFrame) -> DataFrame:
    table = metrics.drop("power_consumption")
    return rules.scan_rules(table, [*OWN_RULES, *rules.RULES], keep=(ID,)).select(ID, "issue", "severity", "reason")


def _own_pairs(run: Run) -> DataFrame:
    return correlation.pair_correlations(run.metrics, correlation.rank_table(run.metrics, OWN_PAIRS), OWN_PAIRS).select(
        "pair_ord", "n", "pearson_r", "spearman_r"
    )


def _long_frames(seq: Sequence, *keep: str) -> DataFrame:
    """Means and deviations over the last 5000 rows, more than a block of the series holds."""
    metrics = ("gpu_usage", "temperature")
    names = [f(m, LONG_FRAME) for m in metrics for f in (long_frames.mean_name, long_frames.std_name)]
    rows = long_frames.long_rolling(seq, metrics, LONG_FRAME).rows
    return rows.select(ID, *keep, *[stable(F.col(n), 2).alias(n) for n in names])


def _export_filtered(spark: SparkSession, sf_dir: str) -> DataFrame:
    run = run_of(spark, sf_dir)
    kept = shaping.apply_filters(run.metrics.rows, ["training", "idle"]).select(*SYSTEM_METRICS.names)
    path = sinks.write_csv(kept, new_path(spark, "csv"))
    return read_csv(spark, path, SYSTEM_METRICS)


def _export_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    result = catalog.run_query(run_of(spark, sf_dir), "power_by_workload")
    path = sinks.write_csv(result, new_path(spark, "csv"))
    return spark.read.schema(result.schema).csv(path, header=True)


def _rule(rule: rules.Rule) -> Callable[[SparkSession, str], DataFrame]:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        events = rules.scan_rules(run_of(spark, sf_dir).metrics.rows, [rule], keep=(ID,))
        return events.select(ID, TS, "issue", "severity", "severity_icon", "recommendation")

    return query


def _canned(key: str) -> Callable[[SparkSession, str], DataFrame]:
    return lambda spark, sf_dir: catalog.run_query(run_of(spark, sf_dir), key)


def _on_metrics(build: Callable[[DataFrame], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    return lambda spark, sf_dir: build(run_of(spark, sf_dir).metrics.rows)


def _on_bottlenecks(build: Callable[[DataFrame], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    return lambda spark, sf_dir: build(run_of(spark, sf_dir).bottlenecks)


def _on_anomalies(build: Callable[[DataFrame], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    return lambda spark, sf_dir: build(run_of(spark, sf_dir).anomalies)


def _on_all(build: Callable[[DataFrame, DataFrame, DataFrame], DataFrame]):
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        run = run_of(spark, sf_dir)
        return build(run.metrics.rows, run.bottlenecks, run.anomalies)

    return query


def _on_run(build: Callable[[Run], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    return lambda spark, sf_dir: build(run_of(spark, sf_dir))


#: Report tables from one scan of each input, and the queries that derive the same ones from the inputs themselves.
SHARED_SCAN = {
    "header": "report_header", "kpi": "kpi_row", "metric_summary": "metric_summary", "hourly_averages": "hourly_averages",
    "power_by_workload": "power_by_workload_chart", "workload_distribution": "workload_distribution", "gauges": "health_gauges",
    "bottlenecks": "report_issue_levels", "bottleneck_summary": "bn_summary", "anomaly_totals": "an_totals",
    "anomalies": "an_by_metric", "anomaly_summary": "an_summary", "inputs": "finding_inputs",
}
FINDING_INPUTS = (
    "total_rows", "avg_temp", "max_temp", "avg_power", "bottlenecks", "gpu", "memory",
    "memory_critical", "thermal", "throttle", "power", "peak_from", "peak_to", "confirmed",
    "high", "top_metric", "pct_safe",
)
_cells: dict[tuple[str, str], ReportCells] = {}


def _shared_scan(name: str) -> Callable[[SparkSession, str], DataFrame]:
    """A report table from the cells of a run, which are counted when first asked for."""

    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        key, run = (spark.sparkContext.applicationId, sf_dir), run_of(spark, sf_dir)
        if key not in _cells:
            _cells[key] = ReportCells.scan(run.metrics.rows, run.bottlenecks, run.anomalies)
        table = _cells[key].table(name)
        if name == "inputs":
            return table.select(*FINDING_INPUTS)
        return _maps_as_text(table) if name in ("bottleneck_summary", "anomaly_summary") else table

    return query


ANOMALY_COLUMNS = (
    ID, TS, "metric", "value", "z_score", "zscore_flag", "iqr_flag", "rolling_flag",
    "methods_flagged", "confidence", "is_anomaly",
)


def _flags(suffixes: tuple[str, ...]) -> list[str]:
    return [f"{m}_{s}" for m in METRICS for s in suffixes]


def _maps_as_text(row: DataFrame) -> DataFrame:
    """Map columns as sorted `key=count` entries, which SQL engines can compare."""

    def text(c: str):
        entries = F.transform(F.map_entries(c), lambda e: F.concat(e["key"].cast("string"), F.lit("="), e["value"].cast("string")))
        return F.array_join(F.array_sort(entries), ",")

    return row.withColumns({c: text(c) for c, kind in row.dtypes if kind.startswith("map")})


def _reopened(spark: SparkSession, sf_dir: str) -> Run:
    return open_run(spark, save_run(run_of(spark, sf_dir), new_path(spark, "saved_run")))


def _timeline_limits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The limit lines, for a series that has any reading."""
    return shaping.limit_lines(spark).join(metrics_from_events(spark, sf_dir).limit(1).select(), how="left_semi")


def _text_input(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The analysis of a source that writes times as text and missing readings as NaN."""
    source = metrics_from_events(spark, sf_dir)
    parts = [F.year(TS), F.month(TS), F.dayofmonth(TS), F.date_format(TS, "HH:mm:ss.SSSSSS")]
    text = F.concat_ws("-", *parts[:3], F.lit(None).cast("string"))
    written = source.withColumns({m: F.coalesce(m, F.lit(float("nan"))) for m in METRICS} | {TS: F.concat(text, F.lit(" "), parts[3])})
    return analyse(written, ORDER, keep=(ID,)).metrics.rows.select(ID, "gpu_usage", "rolling_avg_gpu_5")


def _per_hour_correlation(run: Run) -> DataFrame:
    hourly = run.metrics.rows.withColumn("hour_start", F.window(TS, "1 hour")["start"])
    return correlation.guarded_pearson(hourly, ["hour_start"])


def _spearman(run: Run) -> DataFrame:
    table = correlation.pair_correlations(run.metrics, run.ranks)
    return table.select("pair_ord", "n", "spearman_r")


def _pvalues(run: Run) -> DataFrame:
    table = correlation.pair_correlations(run.metrics, run.ranks)
    return table.select("pair_ord", "pearson_p", "spearman_p")


def _trend_fit(run: Run) -> DataFrame:
    fit = shaping.trend_fit(run.metrics.rows, "gpu_usage", "power_consumption")
    return fit.withColumns({c: F.round(c, 6) for c in ("slope", "intercept")})


def _scatter(run: Run) -> tuple[DataFrame, DataFrame]:
    return shaping.scatter(run.metrics.rows, run.metrics.length, (ID,), "gpu_usage", "power_consumption")


def _trend_line(run: Run) -> DataFrame:
    line = shaping.trend_line(shaping.trend_fit(run.metrics.rows, "gpu_usage", "power_consumption"))
    return line.withColumns({c: F.round(c, 6) for c in ("x", "y")})


def _timeline(run: Run) -> DataFrame:
    metrics = [m for names in shaping.TIMELINES.values() for m in names]
    return shaping.timeline(run.metrics.rows, run.metrics.length, metrics)


def _hot_windows_15m(run: Run) -> DataFrame:
    text = next(q.sql for q in catalog.QUERIES if q.key == "hot_windows")
    return catalog.run_sql(run, text.replace("10 minutes", "15 minutes"))


ADHOC = """
    SELECT s.workload_type, b.severity, COUNT(*) AS events
    FROM bottlenecks b JOIN system_metrics s ON b.row_idx = s.row_idx
    GROUP BY s.workload_type, b.severity
"""


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        # sources and sinks
        "src_metrics": _source,
        "csv_roundtrip": _csv_roundtrip,
        "raw_csv_roundtrip": _raw_csv_roundtrip,
        "table_roundtrip": _table_roundtrip,
        "bottleneck_sink": _bottleneck_sink,
        "anomaly_sink": _anomaly_sink,
        "export_filtered": _export_filtered,
        "export_query": _export_query,
        "data_range": _on_metrics(summaries.data_range),
        # cleaning
        "ffill_limit3": _on_run(lambda r: cleaning.forward_fill(raw_sequence(r)).rows.select(ID, *METRICS)),
        "interpolate_gaps": _on_run(lambda r: cleaning.fill_gaps(raw_sequence(r)).rows.select(ID, *METRICS)),
        "interpolate_by_host": lambda s, d: cleaning.fill_gaps(_by_host(s, d)).rows.select(ID, "host_id", *METRICS),
        "clean_metrics": _on_run(lambda r: cleaning.clean(raw_sequence(r)).rows.select(ID, *METRICS)),
        "normalize_minmax": _on_run(
            lambda r: cleaning.normalize(cleaned_sequence(r).rows).select(ID, *NORMALIZED)
        ),
        "normalize_by_host": lambda s, d: cleaning.normalize_per(cleaning.clean(_by_host(s, d)).rows, ("host_id",)).select(
            ID, "host_id", *NORMALIZED
        ),
        "null_counts": _on_run(lambda r: cleaning.null_counts(r.raw)),
        "missing_cells": _on_run(lambda r: cleaning.missing_cells(r.raw)),
        # features
        "feat_ratios": _on_run(
            lambda r: cleaned_sequence(r)
            .rows.withColumns(features.ratio_features(list(METRICS)))
            .select(ID, "gpu_cpu_ratio", "power_efficiency", "thermal_headroom")
        ),
        "feat_rolling": _on_run(
            lambda r: features.engineer_features(cleaned_sequence(r)).rows.select(
                ID, "rolling_avg_gpu_5", "rolling_avg_gpu_15", "rolling_avg_temp_10", "rolling_std_gpu_5"
            )
        ),
        "rolling_5000": _on_run(lambda r: _long_frames(cleaned_sequence(r))),
        "rolling_5000_by_host": lambda s, d: _long_frames(_by_host(s, d), "host_id"),
        "feat_lag_diff": _on_run(
            lambda r: features.engineer_features(cleaned_sequence(r)).rows.select(ID, "memory_pressure")
        ),
        "feat_time": _on_run(
            lambda r: cleaned_sequence(r)
            .rows.withColumns(features.time_features())
            .select(ID, "hour_of_day", "day_of_week", "is_peak_hour")
        ),
        "feature_table": _on_metrics(lambda m: m.select(ID, *SYSTEM_METRICS.names)),
        "feature_table_by_host": lambda s, d: prepare(_by_host(s, d)).rows.select(
            ID, "host_id", *METRICS, "rolling_avg_gpu_5", "rolling_avg_gpu_15", "rolling_avg_temp_10",
            "rolling_std_gpu_5", "memory_pressure",
        ),
        # filters and listings
        "filter_workloads": _on_metrics(
            lambda m: shaping.apply_filters(
                m, ["training", "inference"], ("2024-01-05 00:00:00", "2024-01-20 12:00:00")
            ).select(ID, TS, WORKLOAD, *METRICS)
        ),
        "distinct_workloads": _on_metrics(summaries.distinct_workloads),
        "bottleneck_listing": _on_bottlenecks(lambda b: shaping.bottleneck_listing(b)),
        "anomaly_listing": _on_anomalies(shaping.anomaly_listing),
        # bottleneck rules
        **{f"rule_{r.id}": _rule(r) for r in rules.RULES},
        "detect_bottlenecks": _on_metrics(
            lambda m: rules.scan_rules(m, keep=(ID,)).select(ID, *BOTTLENECKS.names)
        ),
        "user_rules": _on_metrics(_user_rules),
        "bottleneck_reasons": _on_bottlenecks(lambda b: b.select(ID, "issue", "reason")),
        # anomaly methods
        "anomalies_by_host": lambda s, d: anomalies.scan_anomalies(
            prepare(_by_host(s, d)), keep=(ID, "host_id"), per=("host_id",)
        ).select("host_id", *ANOMALY_COLUMNS),
        "iqr_fences_by_host": lambda s, d: anomalies.iqr_fences(metrics_from_events(s, d), per=("host_id",)).withColumns(
            {c: denoise(F.col(c)) for c in ("lower_fence", "upper_fence")}
        ),
        "anomaly_zscore": _on_metrics(
            lambda m: anomalies.zscores(m).select(ID, *_flags(("zscore", "zscore_flag")))
        ),
        "anomaly_iqr": _on_run(
            lambda r: anomalies.iqr_flags(r.metrics.rows).select(ID, *_flags(("iqr_flag",)))
        ),
        "iqr_fences": _on_run(
            lambda r: anomalies.iqr_fences(r.metrics.rows).withColumns(
                {c: F.round(c, 6) for c in ("lower_fence", "upper_fence")}
            )
        ),
        "anomaly_rolling": _on_run(
            lambda r: anomalies.detect_rolling(cleaned_sequence(r)).rows.select(ID, *_flags(("rolling_flag",)))
        ),
        "unpivot_metrics": _on_metrics(lambda m: anomalies.unpivot_metrics(m, (ID, TS))),
        "detect_anomalies": _on_run(
            lambda r: anomalies.scan_anomalies(r.metrics, keep=(ID,)).select(*ANOMALY_COLUMNS)
        ),
        "detector_options": _on_run(
            lambda r: anomalies.scan_anomalies(
                r.metrics, ("temperature", "cpu_usage"), keep=(ID,), threshold=1.5, multiplier=0.5, window=8, num_std=1.5
            ).select(*ANOMALY_COLUMNS)
        ),
        "anomalies_confirmed": _on_anomalies(lambda a: anomalies.confirmed(a).select(*ANOMALY_COLUMNS)),
        # correlation
        "corr_pearson": _on_run(lambda r: correlation.guarded_pearson(r.correlated)),
        "own_pairs": _on_run(_own_pairs),
        "corr_small_sample": _on_run(_per_hour_correlation),
        "corr_spearman": _on_run(_spearman),
        "corr_pvalues": _on_run(_pvalues),
        "corr_by_workload": _on_run(
            lambda r: correlation.correlations_by_workload(r.metrics, r.ranks)
        ),
        "corr_report": _on_run(lambda r: r.correlations.drop("by_workload", "pearson_p", "spearman_p")),
        "corr_matrix": _on_run(lambda r: correlation.correlation_matrix(r.correlated)),
        "corr_matrix_wide": _on_run(
            lambda r: correlation.matrix_wide(correlation.correlation_matrix(r.correlated))
        ),
        "corr_heatmap": _on_run(lambda r: correlation.heatmap_cells(correlation.correlation_matrix(r.correlated))),
        "corr_strong_pairs": _on_run(
            lambda r: r.correlations.where("strength = 'Strong'").orderBy("pair_ord").limit(4)
            .select("pair", "x_col", "y_col", "pearson_r")
        ),
        # bottleneck summaries
        "bn_by_type": _on_bottlenecks(summaries.bottlenecks_by_type),
        "bn_by_severity": _on_bottlenecks(summaries.bottlenecks_by_severity),
        "bn_top_hours": _on_bottlenecks(summaries.top_hours),
        "bn_frequency": _on_bottlenecks(summaries.bottleneck_frequency),
        "timeline_limits": _timeline_limits,
        "limit_readings": lambda s, d: shaping.limit_readings(metrics_from_events(s, d)),
        "reopened_q8": lambda spark, sf_dir: catalog.run_query(_reopened(spark, sf_dir), "correlated_events"),
        "reopened_filter": lambda spark, sf_dir: shaping.apply_filters(
            _reopened(spark, sf_dir).metrics.rows, date_range=("2024-01-05", "2024-01-06 12:00:00")
        ).select(ID, "gpu_usage"),
        "analyse_text_input": _text_input,
        "bn_summary": _on_bottlenecks(lambda b: _maps_as_text(summaries.bottleneck_summary(b))),
        "bn_timeline": _on_bottlenecks(lambda b: shaping.bottleneck_timeline(b)),
        "issue_counts_row": _on_bottlenecks(summaries.issue_counts),
        "report_issue_levels": _on_bottlenecks(summaries.report_issue_levels),
        # anomaly summaries
        "an_by_metric": _on_anomalies(summaries.anomalies_by_metric),
        "an_by_confidence": _on_anomalies(summaries.anomalies_by_confidence),
        "anomaly_confidence_counts": _on_anomalies(summaries.confidence_counts),
        "an_hourly": _on_anomalies(summaries.anomalies_by_hour),
        "an_totals": _on_anomalies(summaries.anomaly_totals),
        "an_summary": _on_anomalies(lambda a: _maps_as_text(summaries.anomaly_summary(a))),
        "anomaly_heatmap": _on_anomalies(summaries.anomaly_heatmap),
        # metric summaries
        "kpi_row": _on_all(summaries.kpi_row),
        "metric_summary": _on_metrics(summaries.metric_summary),
        "hourly_averages": _on_metrics(summaries.hourly_averages),
        "power_by_workload_chart": _on_metrics(summaries.power_by_workload),
        "workload_distribution": _on_metrics(summaries.workload_distribution),
        "health_gauges": _on_metrics(summaries.health_gauges),
        "describe_metrics": _on_run(lambda r: summaries.describe_metrics(r.raw)),
        # report
        "health_score": _on_all(lambda m, b, a: summaries.health_score(b, a)),
        "report_header": _on_all(summaries.report_header),
        **{f"shared_{name}": _shared_scan(name) for name in SHARED_SCAN},
        # SQL library
        "q1_usage_by_workload": _canned("usage_by_workload"),
        "q2_hot_windows": _canned("hot_windows"),
        "q2_hot_windows_15m": _on_run(_hot_windows_15m),
        "q3_memory_by_hour": _canned("memory_by_hour"),
        "q4_bn_frequency": _canned("bottleneck_frequency"),
        "q5_peak_offpeak": _canned("peak_offpeak"),
        "q6_power_by_workload": _canned("power_by_workload"),
        "q7_anomalies_by_hour": _canned("anomalies_by_hour"),
        "q8_correlated_events": _canned("correlated_events"),
        "adhoc_sql": _on_run(lambda r: catalog.run_sql(r, ADHOC)),
        # findings and strategies
        "offpeak_gpu": _on_metrics(findings.offpeak_gpu),
        "training_balance": _on_metrics(findings.training_balance),
        "finding_inputs": _on_all(
            lambda m, b, a: findings.finding_inputs(m, b, a).select(*FINDING_INPUTS)
        ),
        "strategy_inputs": _on_all(
            lambda m, b, a: findings.finding_inputs(m, b, a).select(
                "gpu", "thermal", "memory", "power", "mode_hour", "offpeak_gpu", "train_rows", "train_cpu", "train_gpu"
            )
        ),
        "findings": _on_run(
            lambda r: findings.key_findings(
                findings.finding_inputs(r.metrics.rows, r.bottlenecks, r.anomalies), r.correlations
            )
        ),
        "strategies": _on_all(
            lambda m, b, a: findings.mitigation_strategies(findings.finding_inputs(m, b, a)).drop("implementation")
        ),
        "strategy_steps": _on_all(
            lambda m, b, a: findings.strategy_steps(
                findings.mitigation_strategies(findings.finding_inputs(m, b, a))
            )
        ),
        # samples and trends
        "downsample_systematic": _on_run(
            lambda r: shaping.downsample(r.metrics.rows, r.metrics.length).select(ID, TS, *METRICS)
        ),
        "timeline_metrics": _on_run(_timeline),
        "sample_2000": _on_run(lambda r: _scatter(r)[0]),
        "sample_trend": _on_run(lambda r: _scatter(r)[1].withColumns({c: F.round(c, 6) for c in ("x", "y")})),
        "trend_fit": _on_run(_trend_fit),
        "trend_line": _on_run(_trend_line),
    }
