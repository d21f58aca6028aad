"""Textual findings and mitigation strategies, derived from a handful of aggregates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridpulse.functions.rounding import denoise, half_even, stable
from gridpulse.operators.correlation import PAIR
from gridpulse.schema import TS, WORKLOAD, complete

# Off-peak hours, number of peak hours named, starvation share, order of severities.
OFF_PEAK_HOURS = (22, 23, 0, 1, 2, 3, 4, 5)
PEAK_HOURS_NAMED = 3
STARVED_SHARE = 0.6
SEVERITY_ORDER = ("critical", "warning", "insight", "positive")

# Texts of the findings; {…} is filled from the aggregates.
TEXT = {
    "gpu_title": "Frequent GPU bottlenecks during training workloads",
    "gpu_detail": "GPU usage exceeded 90% in {gpu} events. Most concentrated between {range} across "
    "monitored days. This indicates the system is GPU-bound during peak training hours.",
    "memory_title": "Memory pressure detected — potential leak patterns",
    "memory_detail": "Memory usage exceeded safe thresholds in {memory} events ({memory_critical} critical). "
    "Gradual memory climb patterns suggest possible memory leaks during long-running inference workloads.",
    "throttle_title": "Thermal throttling risk — {throttle} critical events",
    "throttle_detail": "Temperature exceeded 90°C in {throttle} events (max: {max_temp}°C). "
    "Thermal management adequate for {pct_safe}% of time, but sustained training sessions push "
    "temperatures beyond safe limits.",
    "thermal_title": "System thermal management adequate for {pct_safe}% of time",
    "thermal_detail": "Temperature exceeded 85°C in {thermal} events but stayed below throttle threshold. "
    "Average temperature: {avg_temp}°C. Average thermal headroom: {headroom}°C during normal operation.",
    "power_title": "Power consumption spikes detected ({power} events)",
    "power_detail": "Power draw exceeded 320W in {power} events. Average consumption: {avg_power}W. "
    "High power events correlate with GPU-intensive training workloads.",
    "anomaly_title": "Anomalous behavior detected — {top_metric} most affected",
    "anomaly_detail": "{confirmed} confirmed anomalies detected across all metrics ({high} high-confidence). "
    "{top_metric} shows the most anomalous patterns, warranting closer investigation.",
    "correlation_title": "{strength} {direction} correlation: {pair}",
}

# The strategies; {…} is filled from the aggregates.
STRATEGIES = (
    (
        "Dynamic Workload Scheduling", "📅",
        "Defer non-critical training jobs to off-peak hours (10 PM–6 AM) where GPU availability averages "
        "{offpeak_gpu}% vs peak usage. Most bottlenecks cluster around {mode_hour}:00.",
        "Estimated 30–40% reduction in GPU bottleneck events",
        (
            "Set up job scheduler (SLURM / Kubernetes CronJobs)",
            "Prioritize inference during peak, training during off-peak",
            "Add GPU reservation system for critical jobs",
        ),
    ),
    (
        "Cooling System Optimization", "❄️",
        "{thermal} overheating events detected with thermal lag after GPU spikes. "
        "Sustained training pushes temperatures beyond safe operating range.",
        "Prevents thermal throttling, maintains consistent performance",
        (
            "Improve rack airflow — ensure 3U spacing between GPU nodes",
            "Consider liquid cooling for sustained training workloads",
            "Set thermal throttle at 85°C to prevent degradation",
            "Add temperature-based workload migration between nodes",
        ),
    ),
    (
        "Memory Leak Mitigation", "🧠",
        "Memory leak patterns during inference suggest unbounded tensor caching. "
        "{memory} memory pressure events detected.",
        "Prevents OOM crashes, improves system stability",
        (
            "Implement periodic cache clearing every 30 minutes",
            "Set per-process memory caps (ulimit / cgroups)",
            "Add memory watchdog with auto-restart at 90% threshold",
            "Profile memory with torch.cuda.memory_stats()",
        ),
    ),
    (
        "Power Capping Strategy", "⚡",
        "Training workloads push power to 320W+ ({power} events). "
        "Power capping reduces thermal stress with minimal performance impact.",
        "Performance impact <5%, reduces power costs ~12%",
        (
            "Enable GPU power capping: nvidia-smi -pl 300",
            "Monitor perf/watt ratio after capping",
            "Consider time-of-use electricity pricing for scheduling",
        ),
    ),
    (
        "Data Pipeline Efficiency", "🔧",
        "CPU underutilization during training (avg {train_cpu}%) vs GPU (avg {train_gpu}%) "
        "suggests data loading bottleneck.",
        "Can improve GPU utilization by 15–25%",
        (
            "Increase DataLoader workers from 4→8",
            "Enable pin_memory=True for faster CPU→GPU transfer",
            "Implement data prefetching pipeline",
            "Pre-process datasets to binary format (TFRecord / WebDataset)",
        ),
    ),
)


# -- inputs ----------------------------------------------------------------------------


def offpeak_gpu(metrics: DataFrame) -> DataFrame:
    """Mean GPU usage in the off-peak hours."""
    return metrics.agg(_offpeak().alias("offpeak_gpu"))


def _offpeak() -> Column:
    return denoise(F.avg(F.when(F.col("hour_of_day").isin(*OFF_PEAK_HOURS), F.col("gpu_usage"))))


def training_balance(metrics: DataFrame) -> DataFrame:
    """Mean CPU and GPU usage of training rows, and whether the CPU starves the GPU."""
    return metrics.agg(*_training()).withColumn("starved", F.col("train_cpu") < F.col("train_gpu") * STARVED_SHARE)


def _training() -> list[Column]:
    training = F.col(WORKLOAD) == "training"
    return [
        F.count_if(training).alias("train_rows"),
        denoise(F.avg(F.when(training, F.col("cpu_usage")))).alias("train_cpu"),
        denoise(F.avg(F.when(training, F.col("gpu_usage")))).alias("train_gpu"),
    ]


def metric_inputs(metrics: DataFrame) -> DataFrame:
    return complete(metrics).agg(
        F.count(F.lit(1)).alias("total_rows"),
        denoise(F.avg("temperature")).alias("avg_temp"),
        F.max("temperature").alias("max_temp"),
        denoise(F.avg("power_consumption")).alias("avg_power"),
        _offpeak().alias("offpeak_gpu"),
        *_training(),
    )


def bottleneck_inputs(bottlenecks: DataFrame) -> DataFrame:
    """Event counts and the busiest GPU hours, from one (issue, hour) histogram."""
    return issue_inputs(bottlenecks.groupBy("issue", F.hour(TS).alias("hour")).agg(F.count(F.lit(1)).alias("cnt")))


def issue_inputs(histogram: DataFrame) -> DataFrame:
    """The same from the histogram (issue, hour, cnt)."""
    gpu_hour = F.when(F.col("issue") == "GPU Bottleneck", F.struct(-F.col("cnt"), F.col("hour")))
    by_size = F.sort_array(F.collect_list(gpu_hour))  # at most 24 entries
    named = F.transform(F.slice(by_size, 1, PEAK_HOURS_NAMED), lambda e: e["hour"])

    def events(*issues: str) -> Column:
        return F.coalesce(F.sum(F.when(F.col("issue").isin(*issues), F.col("cnt"))), F.lit(0))

    return histogram.agg(
        F.coalesce(F.sum("cnt"), F.lit(0)).alias("bottlenecks"),
        events("GPU Bottleneck").alias("gpu"),
        events("Memory Pressure", "Memory Critical").alias("memory"),
        events("Memory Critical").alias("memory_critical"),
        events("Overheating", "Thermal Throttle").alias("thermal"),
        events("Thermal Throttle").alias("throttle"),
        events("Power Limit").alias("power"),
        F.array_min(named).alias("peak_from"),
        (F.array_max(named) + 1).alias("peak_to"),
        F.get(by_size, 0)["hour"].alias("mode_hour"),
    )


def anomaly_inputs(anomalies: DataFrame) -> DataFrame:
    """Confirmed and high-confidence counts and the most affected metric."""
    counted = anomalies.groupBy("metric").agg(
        F.count_if("is_anomaly").alias("hits"), F.count_if(F.col("confidence") == "high").alias("high")
    )
    return hit_inputs(counted)


def hit_inputs(counted: DataFrame) -> DataFrame:
    """The same from counts by metric (metric, hits, high)."""
    ranked = F.sort_array(F.collect_list(F.when(F.col("hits") > 0, F.struct(-F.col("hits"), F.col("metric")))))
    return counted.agg(
        F.coalesce(F.sum("hits"), F.lit(0)).alias("confirmed"),
        F.coalesce(F.sum("high"), F.lit(0)).alias("high"),
        F.get(ranked, 0)["metric"].alias("top_metric"),
    )


def finding_inputs(metrics: DataFrame, bottlenecks: DataFrame, anomalies: DataFrame) -> DataFrame:
    """One row with every number the texts need."""
    return joined_inputs(metric_inputs(metrics), bottleneck_inputs(bottlenecks), anomaly_inputs(anomalies))


def joined_inputs(row: DataFrame, of_bottlenecks: DataFrame, of_anomalies: DataFrame) -> DataFrame:
    """Three single rows as one, with the share of safe rows."""
    names = row.columns
    return (
        row.withColumn("_b", of_bottlenecks.select(F.struct("*")).scalar())
        .withColumn("_a", of_anomalies.select(F.struct("*")).scalar())
        .select(*names, "_b.*", "_a.*")
        .withColumn("pct_safe", half_even((1 - F.try_divide("thermal", "total_rows")) * 100, 1))
    )


# -- texts -----------------------------------------------------------------------------


def _fixed(c: str | Column, digits: int) -> Column:
    value = F.col(c) if isinstance(c, str) else c
    return F.format_string(f"%.{digits}f", stable(value, digits))


def _fill(text: str, values: dict[str, Column]) -> Column:
    """A text whose {name} parts are replaced by columns."""
    out = F.lit(text)
    for name, value in values.items():
        if "{" + name + "}" in text:
            out = F.replace(out, F.lit("{" + name + "}"), value.cast("string"))
    return out


def _text_values() -> dict[str, Column]:
    counts = ("gpu", "memory", "memory_critical", "thermal", "throttle", "power", "confirmed", "high")
    return {c: F.col(c) for c in (*counts, "max_temp", "pct_safe", "top_metric", "mode_hour")} | {
        "range": F.concat(F.col("peak_from"), F.lit(":00–"), F.col("peak_to"), F.lit(":00")),
        "avg_temp": _fixed("avg_temp", 1),
        "headroom": _fixed(90 - F.col("avg_temp"), 1),
        "avg_power": _fixed("avg_power", 0),
        "offpeak_gpu": _fixed("offpeak_gpu", 0),
        "train_cpu": _fixed("train_cpu", 0),
        "train_gpu": _fixed("train_gpu", 0),
    }


def key_findings(inputs: DataFrame, correlations: DataFrame) -> DataFrame:
    """(emit_ord, severity, icon, title, detail, category) in reading order."""
    values = _text_values()

    def finding(order: int, when: Column, severity, icon, text: str, category: str) -> Column:
        return F.when(
            when,
            F.struct(
                F.lit(order).alias("emit_ord"),
                _literal(severity).alias("severity"),
                _literal(icon).alias("icon"),
                _fill(TEXT[f"{text}_title"], values).alias("title"),
                _fill(TEXT[f"{text}_detail"], values).alias("detail"),
                F.lit(category).alias("category"),
            ),
        )

    leak = F.col("memory_critical") == 0
    hot = F.col("thermal") > 0
    throttled = F.col("throttle") > 0
    rows = F.array(
        finding(0, F.col("gpu") > 0, "critical", "🔴", "gpu", "bottleneck"),
        finding(
            1, F.col("memory") > 0, F.when(leak, "warning").otherwise("critical"),
            F.when(leak, "🟡").otherwise("🔴"), "memory", "bottleneck",
        ),
        finding(2, hot & throttled, "critical", "🔴", "throttle", "thermal"),
        finding(3, hot & ~throttled, "positive", "🟢", "thermal", "thermal"),
        finding(4, F.col("power") > 0, "warning", "🟡", "power", "power"),
        finding(5, F.col("confirmed") > 0, "warning", "🟡", "anomaly", "anomaly"),
    )
    from_metrics = inputs.select(F.inline(F.array_compact(rows)))
    pair = {c: F.col(c) for c in ("strength", "direction", "pair")}
    from_pairs = correlations.where(F.col("strength") == "Strong").select(
        (F.col(PAIR) + 6).alias("emit_ord"),
        F.lit("insight").alias("severity"),
        F.lit("🔵").alias("icon"),
        _fill(TEXT["correlation_title"], pair).alias("title"),
        F.col("interpretation").alias("detail"),
        F.lit("correlation").alias("category"),
    )
    rank = F.array_position(F.array(*[F.lit(s) for s in SEVERITY_ORDER]), F.col("severity"))
    return from_metrics.unionByName(from_pairs).orderBy(rank, "emit_ord")


def _literal(value) -> Column:
    return value if isinstance(value, Column) else F.lit(value)


def mitigation_strategies(inputs: DataFrame) -> DataFrame:
    """(strategy_ord, title, icon, strategy, impact, implementation) for what was detected."""
    values = _text_values()
    applies = (
        F.col("gpu") > 0,
        F.col("thermal") > 0,
        F.col("memory") > 0,
        F.col("power") > 0,
        F.col("train_cpu") < F.col("train_gpu") * STARVED_SHARE,
    )
    rows = [
        F.when(
            when,
            F.struct(
                F.lit(i).alias("strategy_ord"),
                F.lit(title).alias("title"),
                F.lit(icon).alias("icon"),
                _fill(text, values).alias("strategy"),
                F.lit(impact).alias("impact"),
                F.array(*[F.lit(s) for s in steps]).alias("implementation"),
            ),
        )
        for i, (when, (title, icon, text, impact, steps)) in enumerate(zip(applies, STRATEGIES))
    ]
    return inputs.select(F.inline(F.array_compact(F.array(*rows)))).orderBy("strategy_ord")


def strategy_steps(strategies: DataFrame) -> DataFrame:
    """One row per implementation step."""
    return strategies.select(
        "strategy_ord", "title", F.posexplode("implementation").alias("step_ord", "step")
    )
