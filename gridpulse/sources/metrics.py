"""Metric sources: typed, ordered wide frames of five metrics and a category."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridpulse.schema import RAW_METRICS, present

# Microseconds are written and may be absent when read.
_CSV_TIME = "yyyy-MM-dd HH:mm:ss[.SSSSSS]"
CSV_OPTIONS = {"header": "true", "timestampFormat": _CSV_TIME, "timestampNTZFormat": _CSV_TIME}


def ingest(df: DataFrame) -> DataFrame:
    """A missing reading is NULL, however the source wrote it."""
    return df.withColumns({c: F.when(~F.isnan(c), F.col(c)) for c in present(df)})


def read_csv(spark: SparkSession, path: str, schema=RAW_METRICS) -> DataFrame:
    return ingest(spark.read.schema(schema).options(**CSV_OPTIONS).csv(path))


def read_parquet(spark: SparkSession, path: str) -> DataFrame:
    return ingest(spark.read.parquet(path))


def metrics_from_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The `events` table read as a metric series, with sensor dropouts as NULL.

    `event_id` is the tiebreak of the order, `host_id` an optional series key.
    """
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    gpu = F.expr("least(value, 1e2)")
    return ingest(
        events.select(
            "event_id",
            F.col("ts").alias("timestamp"),
            F.expr("user_id % 8").alias("host_id"),
            F.when(
                ~F.expr("event_id % 200 BETWEEN 100 AND 105 OR event_id % 50 = 7"), gpu
            ).alias("gpu_usage"),
            F.expr("if(event_id % 61 = 3, null, (event_id * 37 % 1000) / 1e1)").alias("cpu_usage"),
            F.expr("if(event_id % 71 = 5, null, least(20e0 + 0.3e0 * value, 1e2))").alias("memory_usage"),
            (45e0 + 0.35e0 * gpu + F.expr("(event_id * 17 % 200) / 1e1")).alias("temperature"),
            F.expr("if(event_id % 83 = 2, null, least(120e0 + value, 5e2))").alias("power_consumption"),
            F.when(F.col("event_type").isin("purchase", "click"), "training")
            .when(F.col("event_type").isin("view", "signup"), "inference")
            .when(F.col("event_type") == "error", "idle")
            .alias("workload_type"),
        )
    )
