"""Headline benchmark: prints one JSON line with seconds per step and query.

`analysis_run` is the whole analysis of a fresh series (order, clean, normalise, all
features, rules, anomalies, all tables written).  Every other entry is one view or query over
the stored tables, which is how users meet them.  Each is timed once, to the last row.
"""

from __future__ import annotations

import json
import os
import time

from pyspark.sql import DataFrame, SparkSession

from checks import queries as registered

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")

HEADLINE = (
    "interpolate_gaps",
    "feature_table",
    "feature_table_by_host",
    "detect_bottlenecks",
    "detect_anomalies",
    "corr_report",
    "corr_matrix",
    "kpi_row",
    "metric_summary",
    "describe_metrics",
    "anomaly_heatmap",
    "findings",
    "strategies",
    "downsample_systematic",
    "trend_line",
    "q1_usage_by_workload",
    "q2_hot_windows",
    "q3_memory_by_hour",
    "q4_bn_frequency",
    "q5_peak_offpeak",
    "q6_power_by_workload",
    "q7_anomalies_by_hour",
    "q8_correlated_events",
)


def session() -> SparkSession:
    spark = (
        SparkSession.builder.master(f"local[{CPUS}]")
        .appName("gridpulse-bench")
        .config("spark.sql.shuffle.partitions", CPUS)
        .config("spark.driver.memory", "8g")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def consume(df: DataFrame) -> None:
    df.write.format("noop").mode("overwrite").save()


def main() -> None:
    spark = session()
    spark.range(1000).selectExpr("sum(id)").collect()  # start-up is not part of any query
    seconds: dict[str, float] = {}

    def timed(name: str, work) -> None:
        start = time.perf_counter()
        work()
        seconds[name] = round(time.perf_counter() - start, 3)

    timed("analysis_run", lambda: registered.run_of(spark, SF_DIR))
    catalog = registered.queries()
    for name in HEADLINE:
        timed(name, lambda: consume(catalog[name](spark, SF_DIR)))
    print(
        json.dumps(
            {
                "metric": "telemetry_analysis_total",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(SF_DIR.rstrip("/")).removeprefix("sf"),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
