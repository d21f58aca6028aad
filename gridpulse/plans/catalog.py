"""SQL layer: the three tables as views, the query library, and ad-hoc SQL."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.errors import ParseException
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridpulse.operators.anomalies import METRIC
from gridpulse.operators.rules import RULE
from gridpulse.plans.run import Run
from gridpulse.schema import ROW, complete

TABLES = ("system_metrics", "bottlenecks", "anomalies")


def register_views(run: Run) -> None:
    """(Re)define the three tables for SQL.  `anomalies` holds confirmed rows only;
    flags are integers, so `is_anomaly = 1` works."""
    flags = ("zscore_flag", "iqr_flag", "rolling_flag", "is_anomaly")
    complete(run.metrics.rows).createOrReplaceTempView("system_metrics")
    run.bottlenecks.createOrReplaceTempView("bottlenecks")
    run.anomalies.where("is_anomaly").withColumns(
        {c: F.col(c).cast("int") for c in flags}
    ).createOrReplaceTempView("anomalies")


@dataclass(frozen=True)
class Query:
    key: str
    title: str
    category: str
    description: str
    sql: str


def _rounded(function: str, column: str, digits: int) -> str:
    """An aggregate rounded for display.

    A mean is rounded to eight places first, which removes the bits of a floating sum that depend on how
    partial sums were merged; so ties always round the same way.
    """
    value = f"{function}({column})"
    return f"ROUND({f'ROUND({value}, 8)' if function == 'AVG' else value}, {digits})"


def _aggregate(
    table: str,
    keys: dict[str, str],
    measures: dict[str, tuple],
    order: str = "",
    where: str = "",
    limit: int | None = None,
    by: str = "",
) -> str:
    """A grouped query.  `keys`: output name to expression; `measures`: output name to (function, column, digits),
    (function, column) for an exact one, or () for the number of rows; `by` if groups are not the keys themselves."""
    columns = [f"{e} AS {name}" for name, e in keys.items()]
    for name, m in measures.items():
        value = "COUNT(*)" if not m else _rounded(*m) if len(m) == 3 else f"{m[0]}({m[1]})"
        columns.append(f"{value} AS {name}")
    clauses = [f"SELECT {', '.join(columns)}", f"FROM {table}"]
    clauses += [f"WHERE {where}"] * bool(where) + [f"GROUP BY {by or ', '.join(keys.values())}"]
    clauses += [f"ORDER BY {order}"] * bool(order) + [f"LIMIT {limit}"] * bool(limit)
    return "\n".join(clauses)


def _means(digits: int = 1, **columns: str) -> dict[str, tuple]:
    return {name: ("AVG", c, digits) for name, c in columns.items()}


CORRELATED_ROWS = 50  # fixed value: rows the query shows


def _correlated(rows: int = CORRELATED_ROWS) -> str:
    """The first pairs of a bottleneck and a confirmed anomaly of one minute.

    A bottleneck with a partner adds at least one row, so the pairs shown come from the first `rows` bottlenecks in a minute
    with an anomaly: a semi join with the distinct minutes and a top-n find them without forming a pair.  Only the anomalies of
    those few minutes are numbered, and cut to `rows` per minute, so that a hot minute never forms all its pairs.  The minute is the
    text up to the minute: unlike date_trunc, text does not depend on the session's time zone.
    """

    def by_minute(table: str) -> str:
        return f"(SELECT *, SUBSTR(CAST(timestamp AS STRING), 1, 16) AS minute FROM {table})"

    first = f"b.timestamp, b.{ROW}, b.{RULE}"
    return f"""
        WITH confirmed AS (SELECT * FROM {by_minute("anomalies")} WHERE is_anomaly = 1),
        first_b AS (
            SELECT * FROM {by_minute("bottlenecks")} b
            LEFT SEMI JOIN (SELECT DISTINCT minute AS shared FROM confirmed) ON minute = shared
            ORDER BY {first} LIMIT {rows}
        ), partners AS (
            SELECT *, row_number() OVER (PARTITION BY minute ORDER BY {ROW}, {METRIC}) AS nth
            FROM confirmed LEFT SEMI JOIN (SELECT DISTINCT minute AS shared FROM first_b) ON minute = shared
        )
        SELECT b.timestamp, b.issue AS bottleneck_type, b.severity, a.metric AS anomaly_metric, a.z_score, a.confidence
        FROM first_b b JOIN (SELECT * FROM partners WHERE nth <= {rows}) a ON b.minute = a.minute
        ORDER BY {first}, a.{ROW}, a.{METRIC}
        LIMIT {rows}
        """


_POWER = {"avg_power": ("AVG", "power_consumption", 0)}
_EFFICIENCY = {"avg_efficiency": ("AVG", "power_efficiency", 4)}
_WORKLOADS = {"workload_type": "workload_type"}

# Titles, categories, descriptions and output columns that users know the queries by.
QUERIES = (
    Query(
        "usage_by_workload", "Avg Usage per Workload", "Workload",
        "Average GPU/CPU/Memory/Temperature/Power per workload type",
        _aggregate(
            "system_metrics", _WORKLOADS,
            _means(avg_gpu="gpu_usage", avg_cpu="cpu_usage", avg_memory="memory_usage", avg_temp="temperature") | _POWER | {"sample_count": ()},
            "avg_gpu DESC, workload_type",
        ),
    ),
    Query(
        "hot_windows", "Top 5 Hottest Periods", "Thermal",
        "Highest temperature 10-minute windows",
        _aggregate(
            "system_metrics", {"time_window": "SUBSTR(CAST(window.start AS STRING), 1, 16)"},
            {"max_temp": ("MAX", "temperature", 1)} | _means(avg_temp="temperature", avg_gpu_during="gpu_usage") | {"readings": ()},
            "max_temp DESC, time_window", limit=5, by="window(timestamp, '10 minutes')",
        ),
    ),
    Query(
        "memory_by_hour", "Hourly Memory Trend", "Memory",
        "Average, max and min memory usage per hour of day",
        _aggregate(
            "system_metrics", {"hour_of_day": "hour_of_day"},
            _means(avg_memory="memory_usage")
            | {"max_memory": ("MAX", "memory_usage", 1), "min_memory": ("MIN", "memory_usage", 1), "avg_pressure": ("AVG", "memory_pressure", 3)},
            "hour_of_day",
        ),
    ),
    Query(
        "bottleneck_frequency", "Bottleneck Frequency", "Bottleneck",
        "Count of each bottleneck type by severity",
        _aggregate(
            "bottlenecks", {"issue": "issue", "severity": "severity"},
            {"event_count": (), "first_occurrence": ("MIN", "timestamp"), "last_occurrence": ("MAX", "timestamp")},
            "event_count DESC, issue",
        ),
    ),
    Query(
        "peak_offpeak", "Peak vs Off-Peak", "Time Analysis",
        "Performance comparison between peak hours (9AM-6PM) and off-peak",
        _aggregate(
            "system_metrics", {"period": "IF(is_peak_hour = 1, 'Peak (9AM-6PM)', 'Off-Peak')"},
            _means(avg_gpu="gpu_usage", avg_cpu="cpu_usage", avg_temp="temperature") | _POWER | _EFFICIENCY | {"total_readings": ()},
            by="is_peak_hour",
        ),
    ),
    Query(
        "power_by_workload", "Power by Workload", "Power",
        "Power consumption statistics per workload type",
        _aggregate(
            "system_metrics", _WORKLOADS,
            _POWER
            | {"max_power": ("MAX", "power_consumption", 0), "min_power": ("MIN", "power_consumption", 0)}
            | _EFFICIENCY
            | {"samples": ()},
            "avg_power DESC, workload_type",
        ),
    ),
    Query(
        "anomalies_by_hour", "Anomaly Count by Hour", "Anomaly",
        "Confirmed anomalies per metric per hour",
        _aggregate(
            "anomalies", {"metric": "metric", "hour": "HOUR(timestamp)"},
            {"anomaly_count": (), "avg_zscore": ("AVG", "z_score", 2)},
            "anomaly_count DESC, metric, hour", where="is_anomaly = 1",
        ),
    ),
    Query(
        "correlated_events", "Correlated Events", "Cross-Analysis",
        "Bottlenecks and anomalies occurring in the same minute",
        _correlated(),
    ),
)


def categories() -> list[str]:
    """Categories in first-seen order."""
    return list(dict.fromkeys(q.category for q in QUERIES))


def list_queries(category: str | None = None) -> list[Query]:
    return [q for q in QUERIES if category in (None, "All", q.category)]


def run_query(run: Run, key: str) -> DataFrame:
    """One query of the library over the run's tables."""
    return run_sql(run, next(q.sql for q in QUERIES if q.key == key))


def run_sql(run: Run, text: str) -> DataFrame:
    """Ad-hoc SQL over the three tables.  Only queries are accepted, comments and parentheses around them too."""
    register_views(run)
    statement = text.strip().rstrip(";").strip()
    try:
        # as a subquery, anything that is not a query fails to parse
        return run.metrics.rows.sparkSession.sql(f"SELECT * FROM (\n{statement}\n)")
    except ParseException as e:
        raise ValueError("only queries can be run here") from e
