"""Table contracts: fixed schemas, enforced by select + cast before every sink."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

TS = "timestamp"
WORKLOAD = "workload_type"
ROW = "row_idx"  # position in the ordered series, 0-based, without gaps

# The five metrics, in table order.
METRICS = ("gpu_usage", "cpu_usage", "memory_usage", "temperature", "power_consumption")

# Valid range of each metric.
VALID_RANGE = {
    "gpu_usage": (0.0, 100.0),
    "cpu_usage": (0.0, 100.0),
    "memory_usage": (0.0, 100.0),
    "temperature": (20.0, 105.0),
    "power_consumption": (50.0, 500.0),
}

NORMALIZED = tuple(f"{m}_normalized" for m in METRICS)

# The derived features and their types, in table order.
FEATURES = (
    ("gpu_cpu_ratio", T.DoubleType()),
    ("rolling_avg_gpu_5", T.DoubleType()),
    ("rolling_avg_gpu_15", T.DoubleType()),
    ("rolling_avg_temp_10", T.DoubleType()),
    ("rolling_std_gpu_5", T.DoubleType()),
    ("power_efficiency", T.DoubleType()),
    ("thermal_headroom", T.DoubleType()),
    ("memory_pressure", T.DoubleType()),
    ("hour_of_day", T.IntegerType()),
    ("day_of_week", T.StringType()),
    ("is_peak_hour", T.IntegerType()),
)


def _struct(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(name, kind, True) for name, kind in fields])


RAW_METRICS = _struct(
    (TS, T.TimestampNTZType()),
    *[(m, T.DoubleType()) for m in METRICS],
    (WORKLOAD, T.StringType()),
)

CLEANED_METRICS = _struct(
    *[(f.name, f.dataType) for f in RAW_METRICS],
    *[(c, T.DoubleType()) for c in NORMALIZED],
)

SYSTEM_METRICS = _struct(*[(f.name, f.dataType) for f in CLEANED_METRICS], *FEATURES)



def complete(df: DataFrame) -> DataFrame:
    """`df` with a null column for every metric, category and feature that it does not have."""
    return df.withColumns({f.name: F.lit(None).cast(f.dataType) for f in SYSTEM_METRICS if f.name not in df.columns})


BOTTLENECKS = _struct(
    (TS, T.TimestampNTZType()),
    ("issue", T.StringType()),
    ("reason", T.StringType()),
    ("severity", T.StringType()),
    ("severity_icon", T.StringType()),
    ("recommendation", T.StringType()),
)

ANOMALIES = _struct(
    (TS, T.TimestampNTZType()),
    ("metric", T.StringType()),
    ("value", T.DoubleType()),
    ("z_score", T.DoubleType()),
    ("zscore_flag", T.BooleanType()),
    ("iqr_flag", T.BooleanType()),
    ("rolling_flag", T.BooleanType()),
    ("methods_flagged", T.IntegerType()),
    ("confidence", T.StringType()),
    ("is_anomaly", T.BooleanType()),
)


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Project `df` onto `schema`: same columns, same order, same types.

    A column the frame lacks becomes a typed NULL, so a table always has its
    full schema, also when a metric was never collected.
    """
    return df.select(
        *[
            (F.col(f.name) if f.name in df.columns else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in schema
        ]
    )


def present(df: DataFrame, columns=METRICS) -> list[str]:
    """Those of `columns` the frame has, in the given order."""
    return [c for c in columns if c in df.columns]
