"""Derived features: ratios, trailing windows, differences and time parts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, WindowSpec
from pyspark.sql import functions as F

from gridpulse.functions.rounding import half_even, stable
from gridpulse.operators.sequence import Sequence
from gridpulse.schema import TS

# Headroom limit in degrees and the peak hours, both ends included.
THERMAL_LIMIT = 90.0
PEAK_HOURS = (9, 18)

HALO = 14  # the longest trailing window is 15 rows


def ratio_features(columns: list[str]) -> dict[str, Column]:
    """Row-local numeric features, for those whose inputs exist."""
    gpu = F.col("gpu_usage")
    available = {
        "gpu_cpu_ratio": (("gpu_usage", "cpu_usage"), lambda: half_even(gpu / _floor_one("cpu_usage"), 3)),
        "power_efficiency": (
            ("gpu_usage", "power_consumption"),
            lambda: half_even(gpu / _floor_one("power_consumption"), 4),
        ),
        "thermal_headroom": (("temperature",), lambda: half_even(THERMAL_LIMIT - F.col("temperature"), 1)),
    }
    return {n: build() for n, (needs, build) in available.items() if set(needs) <= set(columns)}


def _floor_one(c: str) -> Column:
    # greatest() skips nulls; a missing divisor must give a missing ratio.
    return F.when(F.col(c).isNotNull(), F.greatest(F.col(c), F.lit(1.0)))


def rolling_features(columns: list[str], w: WindowSpec) -> dict[str, Column]:
    """Trailing row-frame features over the ordered window `w`."""

    def last_rows(n: int) -> WindowSpec:
        return w.rowsBetween(-(n - 1), 0)

    features = {}
    if "gpu_usage" in columns:
        features |= {
            "rolling_avg_gpu_5": stable(F.avg("gpu_usage").over(last_rows(5)), 2),
            "rolling_avg_gpu_15": stable(F.avg("gpu_usage").over(last_rows(15)), 2),
            "rolling_std_gpu_5": stable(
                F.coalesce(F.stddev_samp("gpu_usage").over(last_rows(5)), F.lit(0.0)), 2
            ),
        }
    if "temperature" in columns:
        features["rolling_avg_temp_10"] = stable(F.avg("temperature").over(last_rows(10)), 2)
    return features


def difference_features(columns: list[str], w: WindowSpec) -> dict[str, Column]:
    if "memory_usage" not in columns:
        return {}
    memory = F.col("memory_usage")
    return {"memory_pressure": half_even(F.coalesce(memory - F.lag(memory).over(w), F.lit(0.0)), 2)}


def time_features() -> dict[str, Column]:
    hour = F.hour(TS)
    return {
        "hour_of_day": hour,
        "day_of_week": F.date_format(TS, "EEEE"),
        "is_peak_hour": hour.between(*PEAK_HOURS).cast("int"),
    }


def coerce_timestamp(df: DataFrame) -> DataFrame:
    """Parse the timestamp when it arrives as text."""
    if dict(df.dtypes)[TS] == "string":
        return df.withColumn(TS, F.col(TS).cast("timestamp_ntz"))
    return df


def add_features(df: DataFrame, w: WindowSpec) -> DataFrame:
    """All features of a frame whose trailing windows are given by `w`."""
    return df.withColumns(
        ratio_features(df.columns)
        | rolling_features(df.columns, w)
        | difference_features(df.columns, w)
        | time_features()
    )


def engineer_features(seq: Sequence) -> Sequence:
    """Add every derived feature to cleaned metrics; all windows share one sort."""
    return seq.with_rows(coerce_timestamp(seq.rows)).trailing(HALO, add_features)
