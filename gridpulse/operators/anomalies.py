"""Point anomalies: z-score, IQR fences, trailing deviation, and their vote."""

from __future__ import annotations

from collections.abc import Sequence as Seq
from functools import reduce

from pyspark.sql import Column, DataFrame, WindowSpec
from pyspark.sql import functions as F

from gridpulse.functions.keyed import joined_by_key
from gridpulse.functions.quantiles import exact_quantiles
from gridpulse.functions.rounding import half_even, stable
from gridpulse.operators.sequence import Sequence
from gridpulse.schema import ANOMALIES, METRICS, ROW, TS, conform, present

# Detector defaults.
Z_THRESHOLD = 3.0
IQR_MULTIPLIER = 1.5
ROLLING_WINDOW = 15
ROLLING_STDS = 2.0

METRIC = "metric_ord"  # position of the metric, the tiebreak between anomalies of one row


def rolling_flag_name(metric: str) -> str:
    return f"{metric}_rolling_flag"


# -- trailing deviation ----------------------------------------------------------


def add_rolling_flags(
    df: DataFrame,
    w: WindowSpec,
    window: int = ROLLING_WINDOW,
    num_std: float = ROLLING_STDS,
    metrics: Seq[str] = METRICS,
) -> DataFrame:
    """Add `<metric>_rolling_flag`: value outside trailing mean ± num_std deviations.

    A window of equal values has deviation exactly 0 and never flags; without
    that guard the last bit of its mean would decide.
    """
    columns = present(df, metrics)
    frame = w.rowsBetween(-(window - 1), 0)
    # Named first, so that each window function is evaluated once.
    stats = {f"_mean_{c}": F.avg(c).over(frame) for c in columns}
    stats |= {f"_std_{c}": F.stddev_samp(c).over(frame) for c in columns}

    def flag(c: str) -> Column:
        x, mean, std = F.col(c), F.col(f"_mean_{c}"), F.col(f"_std_{c}")
        outside = (x > mean + num_std * std) | (x < mean - num_std * std)
        return F.coalesce((std > 0) & outside, F.lit(False))

    flagged = df.withColumns(stats).withColumns({rolling_flag_name(c): flag(c) for c in columns})
    return flagged.drop(*stats)


def detect_rolling(
    seq: Sequence,
    window: int = ROLLING_WINDOW,
    num_std: float = ROLLING_STDS,
    metrics: Seq[str] = METRICS,
) -> Sequence:
    return seq.trailing(window - 1, lambda df, w: add_rolling_flags(df, w, window, num_std, metrics))


# -- whole-series statistics -----------------------------------------------------


def moments(df: DataFrame, metrics: Seq[str] = METRICS, per: Seq[str] = ()) -> DataFrame:
    """One row (per key): `<metric>_mean` and `<metric>_std` (sample)."""
    columns = present(df, metrics)
    return df.groupBy(*per).agg(
        *[F.avg(c).alias(f"{c}_mean") for c in columns],
        *[F.stddev_samp(c).alias(f"{c}_std") for c in columns],
    )


def iqr_fences(
    df: DataFrame,
    multiplier: float = IQR_MULTIPLIER,
    metrics: Seq[str] = METRICS,
    per: Seq[str] = (),
) -> DataFrame:
    """Fences per metric (and key): (keys, metric, lower_fence, upper_fence)."""
    columns = present(df, metrics)
    quartiles = exact_quantiles(df, columns, (0.25, 0.75), keys=per)

    def fences(c: str) -> Column:
        q1, q3 = F.col(c)[0], F.col(c)[1]
        reach = multiplier * (q3 - q1)
        return F.struct(
            F.lit(c).alias("metric"),
            (q1 - reach).alias("lower_fence"),
            (q3 + reach).alias("upper_fence"),
        )

    return quartiles.select(*per, F.inline(F.array(*[fences(c) for c in columns])))


def zscores(df: DataFrame, threshold: float = Z_THRESHOLD, metrics: Seq[str] = METRICS, per: Seq[str] = ()) -> DataFrame:
    """Add `<metric>_zscore` (absolute, 3 places) and `<metric>_zscore_flag`, against the statistics of all rows or of each key.

    A constant metric scores 0, since its deviation would be 0/0.
    """
    if per:
        stats = moments(df, metrics, per)
        joined = joined_by_key(df, stats, per)
        score = lambda c: _score(F.col(c), F.col(f"{c}_mean"), F.col(f"{c}_std"))
        return _with_scores(joined, {c: score(c) for c in present(df, metrics)}, threshold).select(*df.columns, *_score_names(df, metrics))
    stats = moments(df, metrics).first()

    def score(c: str) -> Column:
        mean, std = stats[f"{c}_mean"], stats[f"{c}_std"]
        return F.lit(0.0) if std == 0 else F.abs((F.col(c) - F.lit(mean)) / F.lit(std))

    return _with_scores(df, {c: score(c) for c in present(df, metrics)}, threshold)


def _score(x: Column, mean: Column, std: Column) -> Column:
    return F.when(std == 0, 0.0).otherwise(F.abs((x - mean) / F.nullif(std, F.lit(0.0))))


def _with_scores(df: DataFrame, scores: dict[str, Column], threshold: float) -> DataFrame:
    return df.withColumns(
        {f"{c}_zscore": stable(z, 3) for c, z in scores.items()}
        | {f"{c}_zscore_flag": F.coalesce(z > threshold, F.lit(False)) for c, z in scores.items()}
    )


def _score_names(df: DataFrame, metrics: Seq[str]) -> list[str]:
    return [f"{c}_{kind}" for c in present(df, metrics) for kind in ("zscore", "zscore_flag")]


def iqr_flags(
    df: DataFrame,
    multiplier: float = IQR_MULTIPLIER,
    metrics: Seq[str] = METRICS,
    per: Seq[str] = (),
) -> DataFrame:
    """Add `<metric>_iqr_flag`: value strictly outside the fences of all rows, or of its key."""
    if per:
        columns = present(df, metrics)
        quartiles = exact_quantiles(df, columns, (0.25, 0.75), keys=per).withColumnsRenamed({c: f"_q_{c}" for c in columns})
        joined = joined_by_key(df, quartiles, per)

        def outside(c: str) -> Column:
            q1, q3 = F.col(f"_q_{c}")[0], F.col(f"_q_{c}")[1]
            reach = multiplier * (q3 - q1)
            return F.coalesce((F.col(c) < q1 - reach) | (F.col(c) > q3 + reach), F.lit(False))

        return joined.withColumns({f"{c}_iqr_flag": outside(c) for c in columns}).drop(*[f"_q_{c}" for c in columns])
    fences = iqr_fences(df, multiplier, metrics).collect()  # one row per metric

    def flag(c: str, low: float | None, high: float | None) -> Column:
        return F.coalesce((F.col(c) < F.lit(low)) | (F.col(c) > F.lit(high)), F.lit(False))

    return df.withColumns(
        {f"{f.metric}_iqr_flag": flag(f.metric, f.lower_fence, f.upper_fence) for f in fences}
    )


# -- unpivot and vote ------------------------------------------------------------


def unpivot_metrics(df: DataFrame, ids: Seq[str] = (TS,), metrics: Seq[str] = METRICS) -> DataFrame:
    """Wide metrics to (ids, metric, value)."""
    return df.unpivot(list(ids), present(df, metrics), "metric", "value")


def vote(df: DataFrame, metrics: Seq[str] = METRICS, keep: Seq[str] = ()) -> DataFrame:
    """Flagged points of a frame that has the three flags of every metric.

    Works on the wide row and emits only flagged metrics, so the series is not
    first multiplied by the number of metrics.
    """
    columns = present(df, metrics)
    extra = [c for c in (ROW, *keep) if c in df.columns]

    def methods(c: str) -> Column:
        flags = (f"{c}_zscore_flag", f"{c}_iqr_flag", rolling_flag_name(c))
        return sum((F.col(f).cast("int") for f in flags[1:]), F.col(flags[0]).cast("int"))

    points = F.array_compact(
        F.array(
            *[
                F.when(
                    methods(c) >= 1,
                    F.struct(
                        F.lit(i).alias(METRIC),
                        F.lit(c).alias("metric"),
                        half_even(F.col(c), 2).alias("value"),
                        F.col(f"{c}_zscore").alias("z_score"),
                        F.col(f"{c}_zscore_flag").alias("zscore_flag"),
                        F.col(f"{c}_iqr_flag").alias("iqr_flag"),
                        F.col(rolling_flag_name(c)).alias("rolling_flag"),
                        methods(c).alias("methods_flagged"),
                    ),
                )
                for i, c in enumerate(columns)
            ]
        )
    )
    any_flag = reduce(lambda a, b: a | b, [methods(c) >= 1 for c in columns], F.lit(False))
    flagged = df.where(any_flag).select(TS, *extra, F.inline(points))
    votes = F.col("methods_flagged")
    confidence = F.when(votes >= 3, "high").when(votes >= 2, "medium").otherwise("low")
    table = flagged.withColumns({"confidence": confidence, "is_anomaly": votes >= 2})
    return table.select(*[f.name for f in ANOMALIES], METRIC, *extra)


def scan_anomalies(seq: Sequence, metrics: Seq[str] = METRICS, keep: Seq[str] = (), per: Seq[str] = (), **options) -> DataFrame:
    """All flagged points of a series, plus `metric_ord`, `row_idx` and `keep` if present.

    `per` names the keys (say, of a host) whose own mean, deviation and quartiles a reading is held against; without it
    the whole table has one set of statistics.

    Options: threshold, multiplier, window, num_std.  Trailing flags already stored
    with the series (see plans.run) are used as they are, which leaves one narrow
    scan; they are recomputed when a window option is given.
    """
    df = seq.rows
    window = options.get("window", ROLLING_WINDOW)
    num_std = options.get("num_std", ROLLING_STDS)
    stored = all(rolling_flag_name(c) in df.columns for c in present(df, metrics))
    if not stored or (window, num_std) != (ROLLING_WINDOW, ROLLING_STDS):
        df = detect_rolling(seq, window, num_std, metrics).rows
    df = zscores(df, options.get("threshold", Z_THRESHOLD), metrics, per)
    df = iqr_flags(df, options.get("multiplier", IQR_MULTIPLIER), metrics, per)
    return vote(df, metrics, keep)


def detect_anomalies(seq: Sequence, **options) -> DataFrame:
    """All flagged points in table form."""
    return conform(scan_anomalies(seq, **options), ANOMALIES)


def confirmed(anomalies: DataFrame) -> DataFrame:
    """Points at least two methods agree on; what the `anomalies` table holds."""
    return anomalies.where("is_anomaly")
