"""Table and CSV sinks.  Each replaces what was there, also with an empty result.

A table sink leaves plain parquet files at the path, or with `versioned` a table that is replaced whole or not at all and
read back with `tables.read`: a driver lost half-way then leaves the old one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridpulse.operators.anomalies import confirmed
from gridpulse.schema import ANOMALIES, BOTTLENECKS, CLEANED_METRICS, RAW_METRICS, ROW, SYSTEM_METRICS, TS, conform
from gridpulse.sources import tables
from gridpulse.sources.metrics import CSV_OPTIONS


def write_csv(df: DataFrame, path: str) -> str:
    """A folder of CSV parts with headers."""
    df.write.mode("overwrite").options(**CSV_OPTIONS).csv(path)
    return path


def _write_table(df: DataFrame, path: str, versioned: bool, by: tuple[str, ...] = ()) -> str:
    if versioned:
        return tables.replace(df.sparkSession, path, df.write.partitionBy(*by).parquet)
    df.write.mode("overwrite").partitionBy(*by).parquet(path)
    return path


def save_raw_csv(df: DataFrame, folder: str, days: int) -> str:
    return write_csv(conform(df, RAW_METRICS), f"{folder}/system_metrics_{days}d.csv")


def save_cleaned_csv(df: DataFrame, folder: str) -> str:
    return write_csv(conform(df, CLEANED_METRICS), f"{folder}/cleaned_metrics.csv")


def save_metrics(df: DataFrame, path: str, versioned: bool = False) -> str:
    """The feature table, partitioned by day so that time filters prune files.

    Range-partitioning by time first gives every task one or two days to write;
    a day with a large share of the rows is spread over many tasks.
    """
    order = [TS] + [c for c in (ROW,) if c in df.columns]
    table = conform(df.repartitionByRange(*order), SYSTEM_METRICS).withColumn("date", F.to_date(TS))
    return _write_table(table, path, versioned, ("date",))


def save_bottlenecks(events: DataFrame, path: str, versioned: bool = False) -> str:
    return _write_table(conform(events, BOTTLENECKS), path, versioned)


def save_anomalies(anomalies: DataFrame, path: str, versioned: bool = False) -> str:
    """Confirmed anomalies only."""
    return _write_table(conform(confirmed(anomalies), ANOMALIES), path, versioned)
