"""DuckDB twins of the registered queries.

All twins share one chain of common table expressions that computes the whole
analysis with global windows; the engine's block-wise plans must agree with it.
"""

from __future__ import annotations

from checks.queries import SHARED_SCAN
from gridpulse.operators import correlation, findings, rules
from gridpulse.operators.summaries import METRIC_LABELS
from gridpulse.schema import METRICS, NORMALIZED

# -- expressions -------------------------------------------------------------------------


def even(x: str, n: int) -> str:
    return f"(round_even(({x}) * 1e{n}, 0) / 1e{n})"


def calm(x: str) -> str:
    return even(x, 8)


def stable(x: str, n: int) -> str:
    return even(calm(x), n)


def sql_round(x: str, n: int) -> str:
    return f"round({calm(x)}, {n})"


def each(template: str, columns=METRICS, sep: str = ", ") -> str:
    return sep.join(template.format(c=c) for c in columns)


def fill(c: str) -> str:
    distance = f"(row_idx - {c}_pi)"
    return f"""CASE WHEN {c} IS NOT NULL THEN {c}
        WHEN {c}_pi IS NULL THEN {c}_nv
        WHEN {distance} <= 3 OR {c}_ni IS NULL THEN {c}_pv
        ELSE {c}_pv + ({c}_nv - {c}_pv) * ({distance} - 3) / ({c}_ni - {c}_pi - 3) END AS {c}"""


def filled_cte(source: str, name: str, keys: str = "") -> str:
    """CTEs that gap-fill `source`, optionally per key."""
    part = f"PARTITION BY {keys} " if keys else ""
    near = each(
        "last_value({c} IGNORE NULLS) OVER back AS {c}_pv, "
        "last_value(CASE WHEN {c} IS NOT NULL THEN row_idx END IGNORE NULLS) OVER back AS {c}_pi, "
        "first_value({c} IGNORE NULLS) OVER ahead AS {c}_nv, "
        "first_value(CASE WHEN {c} IS NOT NULL THEN row_idx END IGNORE NULLS) OVER ahead AS {c}_ni"
    )
    kept = "row_idx, event_id, timestamp, host_id, workload_type"
    return f"""{name}_near AS MATERIALIZED (
  SELECT *, {near} FROM {source}
  WINDOW back AS ({part}ORDER BY row_idx ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW),
         ahead AS ({part}ORDER BY row_idx ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)),
{name} AS MATERIALIZED (SELECT {kept}, {", ".join(fill(c) for c in METRICS)} FROM {name}_near)"""


LIMITS = {"temperature": (20, 105), "power_consumption": (50, 500)}


def clipped(c: str) -> str:
    low, high = LIMITS.get(c, (0, 100))
    return f"CASE WHEN {c} IS NOT NULL THEN greatest({low}::DOUBLE, least({c}, {high}::DOUBLE)) END AS {c}"


def rolling(keys: str = "") -> tuple[str, str]:
    """Rolling feature columns and their WINDOW clause."""
    part = f"PARTITION BY {keys} " if keys else ""
    columns = f"""{stable("avg(gpu_usage) OVER w5", 2)} AS rolling_avg_gpu_5,
  {stable("avg(gpu_usage) OVER w15", 2)} AS rolling_avg_gpu_15,
  {stable("avg(temperature) OVER w10", 2)} AS rolling_avg_temp_10,
  {stable("coalesce(stddev_samp(gpu_usage) OVER w5, 0)", 2)} AS rolling_std_gpu_5,
  {even("coalesce(memory_usage - lag(memory_usage) OVER o, 0)", 2)} AS memory_pressure"""
    frames = ", ".join(
        f"w{n} AS ({part}ORDER BY row_idx ROWS BETWEEN {n - 1} PRECEDING AND CURRENT ROW)" for n in (5, 10, 15)
    )
    return columns, f"WINDOW {frames}, o AS ({part}ORDER BY row_idx)"


def rolling_flag(c: str) -> str:
    mean, std = f"avg({c}) OVER w15", f"coalesce(stddev_samp({c}) OVER w15, 0)"
    return (
        f"(min({c}) OVER w15 < max({c}) OVER w15 AND ({c} > {mean} + 2 * {std} OR {c} < {mean} - 2 * {std}))"
        f" AS {c}_rolling_flag"
    )


# -- the shared chain ----------------------------------------------------------------------

SOURCE = """src AS MATERIALIZED (
  SELECT event_id, ts AS timestamp, user_id % 8 AS host_id,
    CASE WHEN event_id % 200 BETWEEN 100 AND 105 OR event_id % 50 = 7 THEN NULL
         ELSE least(value, 1e2) END AS gpu_usage,
    CASE WHEN event_id % 61 = 3 THEN NULL ELSE (event_id * 37 % 1000) / 1e1 END AS cpu_usage,
    CASE WHEN event_id % 71 = 5 THEN NULL ELSE least(20e0 + 0.3e0 * value, 1e2) END AS memory_usage,
    45e0 + 0.35e0 * least(value, 1e2) + (event_id * 17 % 200) / 1e1 AS temperature,
    CASE WHEN event_id % 83 = 2 THEN NULL ELSE least(120e0 + value, 5e2) END AS power_consumption,
    CASE WHEN event_type IN ('purchase', 'click') THEN 'training'
         WHEN event_type IN ('view', 'signup') THEN 'inference'
         WHEN event_type = 'error' THEN 'idle' END AS workload_type
  FROM events)"""

ORDERED = """raw AS MATERIALIZED (
  SELECT *, row_number() OVER (ORDER BY timestamp, event_id) - 1 AS row_idx FROM src)"""

FILLED = filled_cte("raw", "filled")

CLEAN = f"""clean AS MATERIALIZED (
  SELECT row_idx, event_id, timestamp, host_id, workload_type, {", ".join(clipped(c) for c in METRICS)} FROM filled)"""

_rolling_columns, _rolling_frames = rolling()

_normalized = ", ".join(
    f"CASE WHEN max({c}) OVER () = min({c}) OVER () THEN 0 ELSE "
    + even(f"({c} - min({c}) OVER ()) / (max({c}) OVER () - min({c}) OVER ())", 4)
    + f" END AS {c}_normalized"
    for c in METRICS
)

FEATURES = f"""feat AS MATERIALIZED (
  SELECT *, {_normalized},
  {even("gpu_usage / greatest(cpu_usage, 1e0)", 3)} AS gpu_cpu_ratio,
  {_rolling_columns},
  {even("gpu_usage / greatest(power_consumption, 1e0)", 4)} AS power_efficiency,
  {even("9e1 - temperature", 1)} AS thermal_headroom,
  hour(timestamp)::INTEGER AS hour_of_day,
  dayname(timestamp) AS day_of_week,
  (CASE WHEN hour(timestamp) BETWEEN 9 AND 18 THEN 1 ELSE 0 END)::INTEGER AS is_peak_hour,
  {", ".join(rolling_flag(c) for c in METRICS)}
  FROM clean {_rolling_frames})"""


# Stated here again, so that a changed threshold in the library shows as a mismatch.
CONDITIONS = {
    "gpu_bottleneck": "gpu_usage > 90",
    "cpu_bottleneck": "cpu_usage > 85",
    "memory_pressure": "85 < memory_usage AND memory_usage <= 95",
    "memory_critical": "memory_usage > 95",
    "overheating": "85 < temperature AND temperature <= 90",
    "thermal_throttle": "temperature > 90",
    "cpu_underutilization": "gpu_usage > 90 AND cpu_usage < 30",
    "power_limit": "power_consumption > 320",
}


def quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def reason(rule: rules.Rule) -> str:
    out = quoted(rule.reason)
    for c in rule.needs:
        out = f"replace({out}, '{{{c}}}', {c}::VARCHAR)"
    return out


BOTTLENECKS = "bn AS MATERIALIZED (\n" + "\nUNION ALL\n".join(
    f"""  SELECT event_id, row_idx, timestamp, {quoted(r.issue)} AS issue, {reason(r)} AS reason,
    {quoted(r.severity)} AS severity, {quoted(r.severity_icon)} AS severity_icon,
    {quoted(r.recommendation)} AS recommendation, {i} AS rule_ord
  FROM feat WHERE {CONDITIONS[r.id]}"""
    for i, r in enumerate(rules.RULES)
) + ")"

POINTS = "points AS MATERIALIZED (\n" + "\nUNION ALL\n".join(
    f"""  SELECT event_id, row_idx, timestamp, {i} AS metric_ord, '{c}' AS metric, {c} AS x, {c}_rolling_flag AS rolling_flag
  FROM feat"""
    for i, c in enumerate(METRICS)
) + ")"

STATS = """stats AS MATERIALIZED (
  SELECT metric, avg(x) AS mean, stddev_samp(x) AS std, quantile_cont(x, 0.25) AS q1, quantile_cont(x, 0.75) AS q3
  FROM points GROUP BY metric)"""

SCORED = f"""scored AS MATERIALIZED (
  SELECT p.*, {stable("CASE WHEN std = 0 THEN 0 ELSE abs((x - mean) / std) END", 3)} AS z_score,
    std <> 0 AND abs((x - mean) / std) > 3 AS zscore_flag,
    x < q1 - 1.5e0 * (q3 - q1) OR x > q3 + 1.5e0 * (q3 - q1) AS iqr_flag
  FROM points p JOIN stats USING (metric))"""

ANOMALIES = f"""an AS MATERIALIZED (
  SELECT event_id, row_idx, metric_ord, timestamp, metric, {even("x", 2)} AS value, z_score, zscore_flag, iqr_flag,
    rolling_flag, methods_flagged::INTEGER AS methods_flagged,
    CASE WHEN methods_flagged >= 3 THEN 'high' WHEN methods_flagged >= 2 THEN 'medium' ELSE 'low' END AS confidence,
    methods_flagged >= 2 AS is_anomaly
  FROM (SELECT *, zscore_flag::INT + iqr_flag::INT + rolling_flag::INT AS methods_flagged FROM scored)
  WHERE methods_flagged >= 1)"""

_pair_rows = "\nUNION ALL\n".join(
    f"SELECT {i} AS pair_ord, row_idx, workload_type, {p.x} AS x, {p.y} AS y FROM feat"
    for i, p in enumerate(correlation.PAIRS)
)

PAIRS = f"""pairs AS MATERIALIZED ({_pair_rows}),
ranked AS MATERIALIZED (
  SELECT *,
    rank() OVER (PARTITION BY pair_ord ORDER BY x) + (count(*) OVER (PARTITION BY pair_ord, x) - 1) / 2e0 AS rx,
    rank() OVER (PARTITION BY pair_ord ORDER BY y) + (count(*) OVER (PARTITION BY pair_ord, y) - 1) / 2e0 AS ry,
    rank() OVER (PARTITION BY pair_ord, workload_type ORDER BY x)
      + (count(*) OVER (PARTITION BY pair_ord, workload_type, x) - 1) / 2e0 AS gx,
    rank() OVER (PARTITION BY pair_ord, workload_type ORDER BY y)
      + (count(*) OVER (PARTITION BY pair_ord, workload_type, y) - 1) / 2e0 AS gy
  FROM pairs WHERE x IS NOT NULL AND y IS NOT NULL),
coef AS MATERIALIZED (
  SELECT pair_ord, count(*) AS n, corr(x, y) AS pearson, corr(rx, ry) AS spearman FROM ranked GROUP BY pair_ord)"""

_labels = ", ".join(
    f"({i}, {quoted(p.label)}, '{p.x}', '{p.y}', {quoted(p.expected)})" for i, p in enumerate(correlation.PAIRS)
)

REPORT = f"""labels_of(pair_ord, pair, x_col, y_col, expected) AS (VALUES {_labels}),
rounded AS (
  SELECT pair_ord, n,
    CASE WHEN n < 10 THEN 0 ELSE {stable("pearson", 3)} END AS pearson_r,
    CASE WHEN n < 10 THEN 0 ELSE {stable("spearman", 3)} END AS spearman_r FROM coef),
banded AS (
  SELECT *, CASE WHEN abs(pearson_r) >= 0.8 THEN 'Strong' WHEN abs(pearson_r) >= 0.5 THEN 'Moderate'
      WHEN abs(pearson_r) >= 0.3 THEN 'Weak' ELSE 'Very weak / None' END AS strength,
    CASE WHEN pearson_r > 0 THEN 'positive' ELSE 'negative' END AS direction
  FROM rounded JOIN labels_of USING (pair_ord)),
report AS MATERIALIZED (
  SELECT pair_ord, pair, x_col, y_col, pearson_r, spearman_r, strength, direction,
    strength || ' ' || direction || ' correlation (Pearson r=' || pearson_r::VARCHAR || ', Spearman ρ='
      || spearman_r::VARCHAR || '). ' || expected || '.' AS interpretation
  FROM banded)"""

_issue = {r.id: quoted(r.issue) for r in rules.RULES}

INPUTS = f"""gpu_hours AS (
  SELECT hour(timestamp) AS h, count(*) AS cnt FROM bn WHERE issue = 'GPU Bottleneck' GROUP BY 1),
gpu_top AS (SELECT h FROM gpu_hours ORDER BY cnt DESC, h LIMIT 3),
inputs AS MATERIALIZED (
  SELECT m.*, b.*, a.*,
    (SELECT min(h) FROM gpu_top)::INTEGER AS peak_from, (SELECT max(h) + 1 FROM gpu_top)::INTEGER AS peak_to,
    (SELECT h FROM gpu_hours ORDER BY cnt DESC, h LIMIT 1)::INTEGER AS mode_hour,
    (SELECT metric FROM an WHERE is_anomaly GROUP BY metric ORDER BY count(*) DESC, metric LIMIT 1) AS top_metric,
    {even("(1 - thermal / total_rows) * 100", 1)} AS pct_safe
  FROM (
    SELECT count(*) AS total_rows, {calm("avg(temperature)")} AS avg_temp, max(temperature) AS max_temp,
      {calm("avg(power_consumption)")} AS avg_power,
      {calm("avg(gpu_usage) FILTER (hour_of_day IN (22, 23, 0, 1, 2, 3, 4, 5))")} AS offpeak_gpu,
      count(*) FILTER (workload_type = 'training') AS train_rows,
      {calm("avg(cpu_usage) FILTER (workload_type = 'training')")} AS train_cpu,
      {calm("avg(gpu_usage) FILTER (workload_type = 'training')")} AS train_gpu
    FROM feat) m,
  (SELECT count(*) AS bottlenecks,
      count(*) FILTER (issue = 'GPU Bottleneck') AS gpu,
      count(*) FILTER (issue IN ('Memory Pressure', 'Memory Critical')) AS memory,
      count(*) FILTER (issue = 'Memory Critical') AS memory_critical,
      count(*) FILTER (issue IN ('Overheating', 'Thermal Throttle')) AS thermal,
      count(*) FILTER (issue = 'Thermal Throttle') AS throttle,
      count(*) FILTER (issue = 'Power Limit') AS power FROM bn) b,
  (SELECT count(*) FILTER (is_anomaly) AS confirmed, count(*) FILTER (confidence = 'high') AS high FROM an) a)"""

_CHAIN = {
    "src": (SOURCE, ()),
    "raw": (ORDERED, ("src",)),
    "filled": (FILLED, ("raw",)),
    "clean": (CLEAN, ("filled",)),
    "feat": (FEATURES, ("clean",)),
    "bn": (BOTTLENECKS, ("feat",)),
    "points": (POINTS, ("feat",)),
    "stats": (STATS, ("points",)),
    "scored": (SCORED, ("stats",)),
    "an": (ANOMALIES, ("scored",)),
    "coef": (PAIRS, ("feat",)),
    "report": (REPORT, ("coef",)),
    "inputs": (INPUTS, ("bn", "an")),
}


def chain(*needed: str) -> str:
    """WITH clause holding the named tables and all they depend on."""
    wanted: list[str] = []

    def visit(name: str) -> None:
        for dependency in _CHAIN[name][1]:
            visit(dependency)
        if name not in wanted:
            wanted.append(name)

    for name in needed:
        visit(name)
    return "WITH " + ",\n".join(_CHAIN[n][0] for n in wanted)


def over(needed: str, body: str, extra: str = "") -> str:
    return chain(*needed.split()) + (",\n" + extra if extra else "") + "\n" + body


# -- twins -----------------------------------------------------------------------------------

FEATURE_COLUMNS = ", ".join(
    (
        "timestamp", *METRICS, "workload_type", *NORMALIZED, "gpu_cpu_ratio", "rolling_avg_gpu_5",
        "rolling_avg_gpu_15", "rolling_avg_temp_10", "rolling_std_gpu_5", "power_efficiency", "thermal_headroom",
        "memory_pressure", "hour_of_day", "day_of_week", "is_peak_hour",
    )
)
M = ", ".join(METRICS)
ANOMALY_COLUMNS = (
    "event_id, timestamp, metric, value, z_score, zscore_flag, iqr_flag, rolling_flag, methods_flagged, "
    "confidence, is_anomaly"
)
MINUTE = "strftime(timestamp, '%Y-%m-%d %H:%M') AS timestamp"


def hot_windows(minutes: int) -> str:
    return over(
        "feat",
        f"""SELECT strftime(time_bucket(INTERVAL '{minutes} minutes', timestamp), '%Y-%m-%d %H:%M') AS time_window,
  round(max(temperature), 1) AS max_temp, {sql_round("avg(temperature)", 1)} AS avg_temp,
  {sql_round("avg(gpu_usage)", 1)} AS avg_gpu_during, count(*) AS readings
FROM feat GROUP BY 1 ORDER BY max_temp DESC, time_window LIMIT 5""",
    )


def student_p(r: str) -> str:
    """Two-sided p of a correlation by Simpson integration of the t density."""
    t = f"least(abs({r}) * sqrt((n - 2) / (1 - {r} * {r})), 5e1)"
    density = "pow(1 + u * u / (n - 2), -(n - 1) / 2e0)"
    front = "exp(lgamma((n - 1) / 2e0) - lgamma((n - 2) / 2e0)) / sqrt((n - 2) * pi())"
    return f"""(SELECT {even(f"greatest(0, 1 - 2 * {front} * t / 4000 / 3 * sum(w * {density}))", 5)}
      FROM (SELECT {t} AS t, {t} * i / 4000 AS u,
        CASE WHEN i IN (0, 4000) THEN 1 WHEN i % 2 = 1 THEN 4 ELSE 2 END AS w FROM range(0, 4001) s(i)) GROUP BY t)"""


MATRIX = (*METRICS, "power_efficiency", "thermal_headroom")
_matrix_long = "\nUNION ALL\n".join(
    f"SELECT '{a}' AS x, '{b}' AS y, {stable(f'corr({a}, {b})', 3)} AS r FROM feat" for a in MATRIX for b in MATRIX
)


def title(c: str) -> str:
    return " ".join(w.capitalize() for w in c.split("_"))


_heatmap = "\nUNION ALL\n".join(
    f"SELECT '{title(a)}' AS x, '{title(b)}' AS y, r, {even('r', 2)} AS label FROM matrix WHERE x = '{a}' AND y = '{b}'"
    for a in MATRIX
    for b in MATRIX
)


def template(text: str) -> str:
    """A findings text with its {name} parts taken from `inputs`."""
    def fixed(x: str, n: int) -> str:
        return f"printf('%.{n}f', {stable(x, n)})"

    values = {
        "range": "peak_from || ':00–' || peak_to || ':00'",
        "avg_temp": fixed("avg_temp", 1),
        "headroom": fixed("90 - avg_temp", 1),
        "avg_power": fixed("avg_power", 0),
        "offpeak_gpu": fixed("offpeak_gpu", 0),
        "train_cpu": fixed("train_cpu", 0),
        "train_gpu": fixed("train_gpu", 0),
    }
    names = ("gpu", "memory", "memory_critical", "thermal", "throttle", "power", "confirmed", "high",
             "max_temp", "pct_safe", "top_metric", "mode_hour", *values)
    out = quoted(text)
    for name in names:
        if "{" + name + "}" in text:
            out = f"replace({out}, '{{{name}}}', ({values.get(name, name)})::VARCHAR)"
    return out


def finding(order: int, when: str, severity: str, icon: str, text: str, category: str) -> str:
    return (
        f"SELECT {order} AS emit_ord, {severity} AS severity, {icon} AS icon, {template(findings.TEXT[text + '_title'])}"
        f" AS title, {template(findings.TEXT[text + '_detail'])} AS detail, '{category}' AS category"
        f" FROM inputs WHERE {when}"
    )


_findings = "\nUNION ALL\n".join(
    (
        finding(0, "gpu > 0", "'critical'", "'🔴'", "gpu", "bottleneck"),
        finding(
            1, "memory > 0", "CASE WHEN memory_critical = 0 THEN 'warning' ELSE 'critical' END",
            "CASE WHEN memory_critical = 0 THEN '🟡' ELSE '🔴' END", "memory", "bottleneck",
        ),
        finding(2, "thermal > 0 AND throttle > 0", "'critical'", "'🔴'", "throttle", "thermal"),
        finding(3, "thermal > 0 AND throttle = 0", "'positive'", "'🟢'", "thermal", "thermal"),
        finding(4, "power > 0", "'warning'", "'🟡'", "power", "power"),
        finding(5, "confirmed > 0", "'warning'", "'🟡'", "anomaly", "anomaly"),
        "SELECT pair_ord + 6, 'insight', '🔵', strength || ' ' || direction || ' correlation: ' || pair, "
        "interpretation, 'correlation' FROM report WHERE strength = 'Strong'",
    )
)

_conditions = ("gpu > 0", "thermal > 0", "memory > 0", "power > 0", "train_cpu < train_gpu * 0.6e0")

_strategies = "\nUNION ALL\n".join(
    f"SELECT {i} AS strategy_ord, {quoted(name)} AS title, {quoted(icon)} AS icon, {template(text)} AS strategy, "
    f"{quoted(impact)} AS impact FROM inputs WHERE {_conditions[i]}"
    for i, (name, icon, text, impact, _) in enumerate(findings.STRATEGIES)
)

_steps = "\nUNION ALL\n".join(
    f"SELECT {i} AS strategy_ord, {quoted(name)} AS title, {k} AS step_ord, {quoted(step)} AS step FROM inputs"
    f" WHERE {_conditions[i]}"
    for i, (name, _, _, _, steps) in enumerate(findings.STRATEGIES)
    for k, step in enumerate(steps)
)

SAMPLE = """sampled AS MATERIALIZED (
  SELECT event_id, gpu_usage, power_consumption FROM feat
  ORDER BY CASE WHEN (SELECT count(*) FROM feat) <= 2000 THEN '' ELSE md5('42:' || event_id::VARCHAR) END, event_id
  LIMIT (SELECT CASE WHEN count(*) <= 2000 THEN count(*) ELSE 2000 END FROM feat))"""


def fit(table: str) -> str:
    return f"""fit AS MATERIALIZED (
  SELECT count(*) AS n, regr_slope(power_consumption, gpu_usage) AS slope,
    regr_intercept(power_consumption, gpu_usage) AS intercept, min(gpu_usage) AS x_min, max(gpu_usage) AS x_max
  FROM {table})"""


LINE = """SELECT point::INTEGER AS point, round(x_min + point * (x_max - x_min) / 99, 6) AS x,
  round(intercept + slope * (x_min + point * (x_max - x_min) / 99), 6) AS y
FROM fit, range(0, 100) t(point)"""


def _summary_rows(stats: dict[str, str], labels: dict[str, str], table: str) -> str:
    return "\nUNION ALL\n".join(
        f"SELECT {quoted(labels[c])} AS metric, " + ", ".join(f"{e.format(c=c)} AS {n}" for n, e in stats.items())
        + f" FROM {table}"
        for c in METRICS
    )


def _gauge(name: str, value: str, good: int, warn: int) -> str:
    return (
        f"SELECT '{name}' AS gauge, {value} AS value, CASE WHEN {value} <= {good} THEN 'good' "
        f"WHEN {value} <= {warn} THEN 'warn' ELSE 'critical' END AS status FROM feat"
    )


SCORE = "greatest(0, least(100, 100 - floor((total_bottlenecks + total_anomalies) / 5)))::INTEGER AS health_score"
TOTALS = "(SELECT count(*) FROM bn) AS total_bottlenecks, (SELECT count(*) FROM an WHERE is_anomaly) AS total_anomalies"
RANGE = "strftime(min(timestamp), '%Y-%m-%d') || ' to ' || strftime(max(timestamp), '%Y-%m-%d') AS data_range"


def _entries(table: str, key: str, where: str = "true", top: str = "") -> str:
    """Counts by a key as sorted `key=count` text."""
    counted = f"SELECT {key} AS k, count(*) AS n FROM {table} WHERE {where} GROUP BY k {top}"
    return f"(SELECT coalesce(string_agg(k || '=' || n, ',' ORDER BY k || '=' || n), '') FROM ({counted}))"


def oracle_sql() -> dict[str, str]:
    twins = {
        "bn_summary": over(
            "bn",
            f"SELECT count(*) AS total, {_entries('bn', 'issue')} AS by_type, {_entries('bn', 'severity')} AS by_severity, "
            + _entries("bn", "hour(timestamp)", top="ORDER BY n DESC, k LIMIT 5")
            + " AS most_affected_hours FROM bn",
        ),
        "an_summary": over(
            "an",
            "SELECT count(*) AS total, count(*) FILTER (WHERE is_anomaly) AS confirmed, "
            f"{_entries('an', 'metric', 'is_anomaly')} AS by_metric, {_entries('an', 'confidence')} AS by_confidence, "
            f"{_entries('an', 'hour(timestamp)', 'is_anomaly')} AS hourly_distribution FROM an",
        ),
        "timeline_limits": """SELECT * FROM (VALUES
            ('gpu_cpu', 'Critical', 90e0, 90e0), ('temperature', 'Danger Zone', 85e0, 100e0), ('temperature', 'Throttle', 90e0, 90e0),
            ('memory', 'Warning', 85e0, 85e0), ('memory', 'Critical', 95e0, 95e0)) t(timeline, label, low, high)
            WHERE (SELECT count(*) FROM events) > 0""",
        "analyse_text_input": over("feat", "SELECT event_id, gpu_usage, rolling_avg_gpu_5 FROM feat"),
        "src_metrics": over("src", f"SELECT event_id, timestamp, {M}, workload_type FROM src"),
        "csv_roundtrip": over(
            "feat", f"SELECT timestamp, {M}, workload_type, {', '.join(NORMALIZED)} FROM feat"
        ),
        "raw_csv_roundtrip": over("src", f"SELECT timestamp, {M}, workload_type FROM src"),
        "table_roundtrip": over("feat", f"SELECT {FEATURE_COLUMNS} FROM feat"),
        "export_filtered": over(
            "feat", f"SELECT {FEATURE_COLUMNS} FROM feat WHERE workload_type IN ('training', 'idle')"
        ),
        "data_range": over("feat", f"SELECT {RANGE}, count(*) AS total_rows FROM feat"),
        "ffill_limit3": over(
            "raw",
            "SELECT event_id, "
            + each("last_value({c} IGNORE NULLS) OVER w AS {c}")
            + " FROM raw WINDOW w AS (ORDER BY row_idx ROWS BETWEEN 3 PRECEDING AND CURRENT ROW)",
        ),
        "interpolate_gaps": over("filled", f"SELECT event_id, {M} FROM filled"),
        "interpolate_by_host": over(
            "raw", f"SELECT event_id, host_id, {M} FROM hosts",
            "numbered AS (SELECT * REPLACE (row_number() OVER (PARTITION BY host_id ORDER BY row_idx) AS row_idx)"
            " FROM raw),\n" + filled_cte("numbered", "hosts", "host_id"),
        ),
        "clean_metrics": over("clean", f"SELECT event_id, {M} FROM clean"),
        "normalize_minmax": over("feat", f"SELECT event_id, {', '.join(NORMALIZED)} FROM feat"),
        "null_counts": over(
            "src",
            each(
                "SELECT count(*) AS total, '{c}' AS metric, count(*) FILTER ({c} IS NULL) AS missing FROM src",
                sep="\nUNION ALL\n",
            ),
        ),
        "missing_cells": over(
            "src", "SELECT " + each("count(*) FILTER ({c} IS NULL)", sep=" + ") + " AS missing FROM src"
        ),
        "feat_ratios": over("feat", "SELECT event_id, gpu_cpu_ratio, power_efficiency, thermal_headroom FROM feat"),
        "feat_rolling": over(
            "feat",
            "SELECT event_id, rolling_avg_gpu_5, rolling_avg_gpu_15, rolling_avg_temp_10, rolling_std_gpu_5 FROM feat",
        ),
        "feat_lag_diff": over("feat", "SELECT event_id, memory_pressure FROM feat"),
        "feat_time": over("feat", "SELECT event_id, hour_of_day, day_of_week, is_peak_hour FROM feat"),
        "feature_table": over("feat", f"SELECT event_id, {FEATURE_COLUMNS} FROM feat"),
        "filter_workloads": over(
            "feat",
            f"""SELECT event_id, timestamp, workload_type, {M} FROM feat
WHERE workload_type IN ('training', 'inference')
  AND timestamp BETWEEN TIMESTAMP '2024-01-05 00:00:00' AND TIMESTAMP '2024-01-20 12:00:00'""",
        ),
        "distinct_workloads": over("feat", "SELECT DISTINCT workload_type FROM feat"),
        "bottleneck_listing": over(
            "bn",
            f"SELECT {MINUTE}, issue, severity, reason, recommendation FROM "
            "(SELECT * FROM bn ORDER BY row_idx, rule_ord LIMIT 200)",
        ),
        "anomaly_listing": over(
            "an",
            f"SELECT {MINUTE}, metric, value, z_score, confidence, methods_flagged FROM "
            "(SELECT * FROM an WHERE is_anomaly ORDER BY row_idx, metric_ord LIMIT 200)",
        ),
        "detect_bottlenecks": over(
            "bn", "SELECT event_id, timestamp, issue, reason, severity, severity_icon, recommendation FROM bn"
        ),
        "bottleneck_reasons": over("bn", "SELECT event_id, issue, reason FROM bn"),
        "anomaly_zscore": over(
            "scored",
            "SELECT event_id, "
            + each(
                "max(z_score) FILTER (metric = '{c}') AS {c}_zscore, "
                "bool_or(zscore_flag) FILTER (metric = '{c}') AS {c}_zscore_flag"
            )
            + " FROM scored GROUP BY event_id",
        ),
        "anomaly_iqr": over(
            "scored",
            "SELECT event_id, "
            + each("bool_or(iqr_flag) FILTER (metric = '{c}') AS {c}_iqr_flag")
            + " FROM scored GROUP BY event_id",
        ),
        "iqr_fences": over(
            "stats",
            "SELECT metric, round(q1 - 1.5e0 * (q3 - q1), 6) AS lower_fence, "
            "round(q3 + 1.5e0 * (q3 - q1), 6) AS upper_fence FROM stats",
        ),
        "anomaly_rolling": over("feat", "SELECT event_id, " + each("{c}_rolling_flag") + " FROM feat"),
        "unpivot_metrics": over("points", "SELECT event_id, timestamp, metric, x AS value FROM points"),
        "detect_anomalies": over("an", f"SELECT {ANOMALY_COLUMNS} FROM an"),
        "anomalies_confirmed": over("an", f"SELECT {ANOMALY_COLUMNS} FROM an WHERE is_anomaly"),
        "corr_pearson": over("coef", f"SELECT pair_ord, n, {stable('pearson', 3)} AS pearson_r FROM coef"),
        "corr_small_sample": over(
            "coef",
            f"""SELECT date_trunc('hour', timestamp)::TIMESTAMP AS hour_start, pair_ord, count(*) AS n,
  CASE WHEN count(*) < 10 THEN 0 ELSE {stable("corr(x, y)", 3)} END AS pearson_r
FROM pairs JOIN feat USING (row_idx) GROUP BY 1, 2""",
        ),
        "corr_spearman": over("coef", f"SELECT pair_ord, n, {stable('spearman', 3)} AS spearman_r FROM coef"),
        "corr_pvalues": over(
            "coef",
            f"SELECT pair_ord, {student_p('pearson')} AS pearson_p, {student_p('spearman')} AS spearman_p FROM coef",
        ),
        "corr_by_workload": over(
            "coef",
            f"""SELECT pair_ord, workload_type, {stable("corr(x, y)", 3)} AS pearson_r, {stable("corr(gx, gy)", 3)} AS spearman_r
FROM ranked GROUP BY 1, 2 HAVING count(*) > 20""",
        ),
        "corr_report": over("report", "SELECT * FROM report"),
        "corr_matrix": over("feat", _matrix_long),
        "corr_matrix_wide": over(
            "feat",
            "SELECT x, " + each("max(r) FILTER (y = '{c}') AS {c}", MATRIX) + " FROM matrix GROUP BY x",
            f"matrix AS ({_matrix_long})",
        ),
        "corr_heatmap": over("feat", _heatmap, f"matrix AS MATERIALIZED ({_matrix_long})"),
        "corr_strong_pairs": over(
            "report",
            "SELECT pair, x_col, y_col, pearson_r FROM report WHERE strength = 'Strong' ORDER BY pair_ord LIMIT 4",
        ),
        "bn_by_type": over("bn", "SELECT issue, count(*) AS event_count FROM bn GROUP BY 1"),
        "bn_by_severity": over(
            "bn",
            """SELECT s.severity, count(bn.severity) AS event_count
FROM (VALUES ('Critical'), ('Warning'), ('Medium')) s(severity) LEFT JOIN bn USING (severity) GROUP BY 1""",
        ),
        "bn_top_hours": over(
            "bn",
            "SELECT hour(timestamp)::INTEGER AS hour, count(*) AS event_count FROM bn GROUP BY 1 "
            "ORDER BY event_count DESC, hour LIMIT 5",
        ),
        "bn_frequency": over(
            "bn",
            "SELECT issue, count(*) AS event_count, arg_min(severity, row_idx * 8 + rule_ord) AS severity "
            "FROM bn GROUP BY 1",
        ),
        "bn_timeline": over(
            "bn",
            "SELECT timestamp, issue, severity, reason, "
            "CASE severity WHEN 'Critical' THEN 1 WHEN 'Warning' THEN 2 ELSE 3 END::INTEGER AS severity_rank FROM bn",
        ),
        "issue_counts_row": over(
            "bn",
            "SELECT " + ", ".join(f"count(*) FILTER (issue = {q}) AS {i}" for i, q in _issue.items()) + " FROM bn",
        ),
        "report_issue_levels": over(
            "bn",
            "SELECT issue, count(*) AS event_count, CASE WHEN contains(issue, 'Critical') OR count(*) > 50 "
            "THEN 'Critical' ELSE 'Warning' END AS report_level FROM bn GROUP BY 1",
        ),
        "an_by_metric": over("an", "SELECT metric, count(*) AS event_count FROM an WHERE is_anomaly GROUP BY 1"),
        "an_by_confidence": over("an", "SELECT confidence, count(*) AS event_count FROM an GROUP BY 1"),
        "anomaly_confidence_counts": over(
            "an",
            "SELECT " + each("count(*) FILTER (confidence = '{c}') AS {c}", ("high", "medium", "low")) + " FROM an",
        ),
        "an_hourly": over(
            "an",
            "SELECT hour(timestamp)::INTEGER AS hour, count(*) AS event_count FROM an WHERE is_anomaly GROUP BY 1",
        ),
        "an_totals": over("an", "SELECT count(*) AS total, count(*) FILTER (is_anomaly) AS confirmed FROM an"),
        "anomaly_heatmap": over(
            "an",
            "SELECT metric, "
            + ", ".join(f"count(*) FILTER (hour(timestamp) = {h}) AS h{h}" for h in range(24))
            + " FROM an WHERE is_anomaly GROUP BY metric",
        ),
        "kpi_row": over(
            "bn an",
            "SELECT "
            + ", ".join(
                f"{stable(f'avg({c})', 0 if c == 'power_consumption' else 1)} AS avg_{c}, "
                f"{stable(f'max({c})', 0)} AS max_{c}"
                for c in METRICS
            )
            + ", (SELECT count(*) FROM bn) AS bottleneck_events,"
            " (SELECT count(*) FROM an WHERE is_anomaly) AS confirmed_anomalies FROM feat",
        ),
        "metric_summary": over(
            "feat",
            _summary_rows(
                {n: stable(e, 1) for n, e in
                 {"mean": "avg({c})", "max": "max({c})", "min": "min({c})", "std": "stddev_samp({c})"}.items()},
                METRIC_LABELS, "feat",
            ),
        ),
        "hourly_averages": over(
            "feat",
            "SELECT hour_of_day, "
            + ", ".join(f"{stable(f'avg({c})', 1)} AS {c}" for c in METRICS)
            + " FROM feat GROUP BY 1",
        ),
        "power_by_workload_chart": over(
            "feat",
            f"SELECT workload_type, {calm('avg(power_consumption)')} AS avg_power, "
            "max(power_consumption) AS max_power FROM feat GROUP BY 1",
        ),
        "workload_distribution": over(
            "feat",
            "SELECT workload_type, count(*) AS row_count, "
            "count(*) / (SELECT count(workload_type) FROM feat)::DOUBLE AS share "
            "FROM feat WHERE workload_type IS NOT NULL GROUP BY 1",
        ),
        "health_gauges": over(
            "feat",
            "\nUNION ALL\n".join(
                (
                    _gauge("GPU Usage", calm("avg(gpu_usage)"), 70, 85),
                    _gauge("Temperature", calm("avg(temperature)"), 70, 85),
                    _gauge("Memory Usage", calm("avg(memory_usage)"), 70, 85),
                    _gauge("Power Draw", f"least(1e2, {calm('avg(power_consumption)')} / 5)", 60, 80),
                )
            ),
        ),
        "describe_metrics": over(
            "src",
            _summary_rows(
                {
                    "count": "count({c})", "mean": calm("avg({c})"), "std": calm("stddev_samp({c})"),
                    "min": "min({c})", "q25": calm("quantile_cont({c}, 0.25)"),
                    "q50": calm("quantile_cont({c}, 0.5)"), "q75": calm("quantile_cont({c}, 0.75)"), "max": "max({c})",
                },
                {c: c for c in METRICS}, "src",
            ),
        ),
        "health_score": over("bn an", f"SELECT *, {SCORE} FROM (SELECT {TOTALS})"),
        "report_header": over(
            "bn an",
            f"""SELECT *, {SCORE} FROM (SELECT {stable("avg(gpu_usage)", 1)} AS avg_gpu, {stable("avg(temperature)", 1)} AS avg_temp,
  {stable("avg(power_consumption)", 0)} AS avg_power, count(*) AS total_rows, {RANGE}, {TOTALS} FROM feat)""",
        ),
        "q1_usage_by_workload": over(
            "feat",
            f"""SELECT workload_type, {sql_round("avg(gpu_usage)", 1)} AS avg_gpu, {sql_round("avg(cpu_usage)", 1)} AS avg_cpu,
  {sql_round("avg(memory_usage)", 1)} AS avg_memory, {sql_round("avg(temperature)", 1)} AS avg_temp,
  {sql_round("avg(power_consumption)", 0)} AS avg_power, count(*) AS sample_count FROM feat GROUP BY 1""",
        ),
        "q2_hot_windows": hot_windows(10),
        "q2_hot_windows_15m": hot_windows(15),
        "q3_memory_by_hour": over(
            "feat",
            f"""SELECT hour_of_day, {sql_round("avg(memory_usage)", 1)} AS avg_memory, round(max(memory_usage), 1) AS max_memory,
  round(min(memory_usage), 1) AS min_memory, {sql_round("avg(memory_pressure)", 3)} AS avg_pressure
FROM feat GROUP BY 1""",
        ),
        "q4_bn_frequency": over(
            "bn",
            "SELECT issue, severity, count(*) AS event_count, min(timestamp) AS first_occurrence, "
            "max(timestamp) AS last_occurrence FROM bn GROUP BY 1, 2",
        ),
        "q5_peak_offpeak": over(
            "feat",
            f"""SELECT CASE WHEN is_peak_hour = 1 THEN 'Peak (9AM-6PM)' ELSE 'Off-Peak' END AS period,
  {sql_round("avg(gpu_usage)", 1)} AS avg_gpu, {sql_round("avg(cpu_usage)", 1)} AS avg_cpu,
  {sql_round("avg(temperature)", 1)} AS avg_temp, {sql_round("avg(power_consumption)", 0)} AS avg_power,
  {sql_round("avg(power_efficiency)", 4)} AS avg_efficiency, count(*) AS total_readings FROM feat GROUP BY 1""",
        ),
        "q6_power_by_workload": over("feat", POWER_BY_WORKLOAD),
        "export_query": over("feat", POWER_BY_WORKLOAD),
        "q7_anomalies_by_hour": over(
            "an",
            f"""SELECT metric, hour(timestamp)::INTEGER AS hour, count(*) AS anomaly_count,
  {sql_round("avg(z_score)", 2)} AS avg_zscore FROM an WHERE is_anomaly GROUP BY 1, 2""",
        ),
        "q8_correlated_events": over(
            "bn an",
            """SELECT b.timestamp, b.issue AS bottleneck_type, b.severity, a.metric AS anomaly_metric, a.z_score, a.confidence
FROM bn b JOIN an a ON date_trunc('minute', b.timestamp) = date_trunc('minute', a.timestamp)
WHERE a.is_anomaly ORDER BY b.timestamp, b.row_idx, b.rule_ord, a.row_idx, a.metric_ord LIMIT 50""",
        ),
        "reopened_q8": over(
            "bn an",
            """SELECT b.timestamp, b.issue AS bottleneck_type, b.severity, a.metric AS anomaly_metric, a.z_score, a.confidence
FROM bn b JOIN an a ON date_trunc('minute', b.timestamp) = date_trunc('minute', a.timestamp)
WHERE a.is_anomaly ORDER BY b.timestamp, b.row_idx, b.rule_ord, a.row_idx, a.metric_ord LIMIT 50""",
        ),
        "reopened_filter": over(
            "feat", "SELECT event_id, gpu_usage FROM feat WHERE timestamp BETWEEN '2024-01-05' AND '2024-01-06 12:00:00'"
        ),
        "adhoc_sql": over(
            "bn",
            "SELECT s.workload_type, b.severity, count(*) AS events FROM bn b JOIN feat s USING (row_idx) GROUP BY 1, 2",
        ),
        "offpeak_gpu": over("inputs", "SELECT offpeak_gpu FROM inputs"),
        "training_balance": over(
            "inputs", "SELECT train_rows, train_cpu, train_gpu, train_cpu < train_gpu * 0.6e0 AS starved FROM inputs"
        ),
        "finding_inputs": over(
            "inputs",
            "SELECT total_rows, avg_temp, max_temp, avg_power, bottlenecks, gpu, memory, memory_critical, thermal, "
            "throttle, power, peak_from, peak_to, confirmed, high, top_metric, pct_safe FROM inputs",
        ),
        "strategy_inputs": over(
            "inputs",
            "SELECT gpu, thermal, memory, power, mode_hour, offpeak_gpu, train_rows, train_cpu, train_gpu FROM inputs",
        ),
        "findings": over("inputs report", _findings),
        "strategies": over("inputs", _strategies),
        "strategy_steps": over("inputs", _steps),
        "downsample_systematic": over(
            "feat",
            f"SELECT event_id, timestamp, {M} FROM feat "
            "WHERE row_idx % (SELECT greatest(1, count(*) // 2000) FROM feat) = 0",
        ),
        "timeline_metrics": over(
            "points",
            "SELECT timestamp, metric, x AS value FROM points WHERE metric <> 'power_consumption' "
            "AND row_idx % (SELECT greatest(1, count(*) // 2000) FROM feat) = 0",
        ),
        "sample_2000": over("feat", "SELECT * FROM sampled", SAMPLE),
        "sample_trend": over("feat", LINE, SAMPLE + ",\n" + fit("sampled")),
        "trend_fit": over(
            "feat",
            "SELECT n, round(slope, 6) AS slope, round(intercept, 6) AS intercept, x_min, x_max FROM fit",
            fit("feat"),
        ),
        "trend_line": over("feat", LINE, fit("feat")),
    }
    host_columns, host_frames = rolling("host_id")
    twins["feature_table_by_host"] = over(
        "raw",
        f"SELECT event_id, host_id, {M}, {host_columns} FROM clean_hosts {host_frames}",
        "numbered AS (SELECT * REPLACE (row_number() OVER (PARTITION BY host_id ORDER BY row_idx) AS row_idx) FROM raw),\n"
        + filled_cte("numbered", "hosts", "host_id")
        + f""",
clean_hosts AS (SELECT row_idx, event_id, host_id, {", ".join(clipped(c) for c in METRICS)} FROM hosts)""",
    )
    clean_hosts = (
        "numbered AS (SELECT * REPLACE (row_number() OVER (PARTITION BY host_id ORDER BY row_idx) AS row_idx) FROM raw),\n"
        + filled_cte("numbered", "hosts", "host_id")
        + f""",
clean_hosts AS MATERIALIZED (SELECT row_idx, event_id, timestamp, host_id, {", ".join(clipped(c) for c in METRICS)} FROM hosts)"""
    )
    in_host = "OVER (PARTITION BY host_id)"
    scaled = ", ".join(
        f"CASE WHEN max({c}) {in_host} = min({c}) {in_host} THEN 0 ELSE "
        + even(f"({c} - min({c}) {in_host}) / (max({c}) {in_host} - min({c}) {in_host})", 4)
        + f" END AS {c}_normalized"
        for c in METRICS
    )
    twins["normalize_by_host"] = over("raw", f"SELECT event_id, host_id, {scaled} FROM clean_hosts", clean_hosts)
    host_points = "\nUNION ALL\n".join(
        f"SELECT event_id, host_id, timestamp, '{c}' AS metric, {c} AS x, {c}_rolling_flag AS rolling_flag FROM host_flags" for c in METRICS
    )
    twins["anomalies_by_host"] = over(
        "raw",
        f"""SELECT host_id, event_id, timestamp, metric, {even("x", 2)} AS value, z_score, zscore_flag, iqr_flag, rolling_flag,
  methods::INTEGER AS methods_flagged, CASE methods WHEN 3 THEN 'high' WHEN 2 THEN 'medium' ELSE 'low' END AS confidence, methods >= 2 AS is_anomaly
FROM (SELECT *, zscore_flag::INT + iqr_flag::INT + rolling_flag::INT AS methods FROM host_scored) WHERE methods >= 1""",
        clean_hosts
        + f""",
host_flags AS (SELECT *, {", ".join(rolling_flag(c) for c in METRICS)} FROM clean_hosts
  WINDOW w15 AS (PARTITION BY host_id ORDER BY row_idx ROWS BETWEEN 14 PRECEDING AND CURRENT ROW)),
host_points AS MATERIALIZED ({host_points}),
host_stats AS MATERIALIZED (
  SELECT host_id, metric, avg(x) AS mean, stddev_samp(x) AS std, quantile_cont(x, 0.25) AS q1, quantile_cont(x, 0.75) AS q3
  FROM host_points GROUP BY ALL),
host_scored AS (
  SELECT p.*, {stable("CASE WHEN std = 0 THEN 0 ELSE abs((x - mean) / std) END", 3)} AS z_score,
    coalesce(std <> 0 AND abs((x - mean) / std) > 3, false) AS zscore_flag,
    coalesce(x < q1 - 1.5e0 * (q3 - q1) OR x > q3 + 1.5e0 * (q3 - q1), false) AS iqr_flag
  FROM host_points p JOIN host_stats s ON p.metric = s.metric AND p.host_id IS NOT DISTINCT FROM s.host_id)""",
    )
    twins["iqr_fences_by_host"] = over(
        "src",
        "\nUNION ALL\n".join(
            f"SELECT host_id, '{c}' AS metric, {calm('q1 - 1.5e0 * (q3 - q1)')} AS lower_fence, {calm('q3 + 1.5e0 * (q3 - q1)')} AS upper_fence "
            f"FROM (SELECT host_id, quantile_cont({c}, 0.25) AS q1, quantile_cont({c}, 0.75) AS q3 FROM src GROUP BY host_id)"
            for c in METRICS
        ),
    )
    zones = (
        "('gpu_usage', 'gpu_cpu', 'Critical', 90e0, NULL), ('cpu_usage', 'gpu_cpu', 'Critical', 90e0, NULL), "
        "('temperature', 'temperature', 'Danger Zone', 85e0, 100e0), ('temperature', 'temperature', 'Throttle', 90e0, NULL), "
        "('memory_usage', 'memory', 'Warning', 85e0, NULL), ('memory_usage', 'memory', 'Critical', 95e0, NULL)"
    )
    twins["limit_readings"] = over(
        "src",
        f"""SELECT z.metric, timeline, label, count(*) AS readings, count(DISTINCT workload_type) AS workloads,
  min(timestamp) AS first_at, max(timestamp) AS last_at, max(value) AS peak
FROM (UNPIVOT src ON {M} INTO NAME metric VALUE value) r
JOIN (VALUES {zones}) z(metric, timeline, label, low, high) ON r.metric = z.metric AND value >= low AND (high IS NULL OR value < high)
GROUP BY ALL""",
    )
    twins["bottleneck_sink"] = over("bn", "SELECT timestamp, issue, reason, severity, severity_icon, recommendation FROM bn")
    twins["anomaly_sink"] = over("an", f"SELECT {ANOMALY_COLUMNS.removeprefix('event_id, ')} FROM an WHERE is_anomaly")
    twins["user_rules"] = over(
        "bn",
        """SELECT event_id, issue, severity, reason FROM bn WHERE issue <> 'Power Limit' UNION ALL
SELECT event_id, 'Warm and Idle', 'Medium', 'Temperature ' || temperature::VARCHAR || '°C at ' || gpu_usage::VARCHAR || '% GPU'
FROM feat WHERE temperature > 75 AND gpu_usage < 30""",
    )
    twins["own_pairs"] = over(
        "feat",
        f"""SELECT 0 AS pair_ord, count(*) AS n, {stable("corr(x, y)", 3)} AS pearson_r, {stable("corr(rx, ry)", 3)} AS spearman_r FROM (
  SELECT x, y, rank() OVER (ORDER BY x) + (count(*) OVER (PARTITION BY x) - 1) / 2e0 AS rx,
    rank() OVER (ORDER BY y) + (count(*) OVER (PARTITION BY y) - 1) / 2e0 AS ry
  FROM (SELECT memory_usage AS x, power_consumption AS y FROM feat) WHERE x IS NOT NULL AND y IS NOT NULL)""",
    )
    frame = "{c} > avg({c}) OVER w + 1.5e0 * coalesce(stddev_samp({c}) OVER w, 0) OR {c} < avg({c}) OVER w - 1.5e0 * coalesce(stddev_samp({c}) OVER w, 0)"
    chosen = "\nUNION ALL\n".join(
        f"SELECT event_id, timestamp, '{c}' AS metric, {c} AS x, min({c}) OVER w < max({c}) OVER w AND ({frame.format(c=c)}) AS rolling_flag "
        "FROM feat WINDOW w AS (ORDER BY row_idx ROWS BETWEEN 7 PRECEDING AND CURRENT ROW)"
        for c in ("temperature", "cpu_usage")
    )
    twins["detector_options"] = over(
        "feat",
        f"""SELECT event_id, timestamp, metric, {even("x", 2)} AS value, z_score, zscore_flag, iqr_flag, rolling_flag,
  methods::INTEGER AS methods_flagged, CASE methods WHEN 3 THEN 'high' WHEN 2 THEN 'medium' ELSE 'low' END AS confidence, methods >= 2 AS is_anomaly
FROM (SELECT *, zscore_flag::INT + iqr_flag::INT + rolling_flag::INT AS methods FROM (
  SELECT o.*, {stable("abs((x - mean) / std)", 3)} AS z_score, abs((x - mean) / std) > 1.5e0 AS zscore_flag,
    x < q1 - 0.5e0 * (q3 - q1) OR x > q3 + 0.5e0 * (q3 - q1) AS iqr_flag
  FROM own_points o JOIN own_stats USING (metric))) WHERE methods >= 1""",
        f"""own_points AS MATERIALIZED ({chosen}),
own_stats AS (SELECT metric, avg(x) AS mean, stddev_samp(x) AS std, quantile_cont(x, 0.25) AS q1, quantile_cont(x, 0.75) AS q3
  FROM own_points GROUP BY metric)""",
    )
    long = each(
        stable("avg({c}) OVER w", 2) + " AS {c}_mean_5000, " + stable("stddev_samp({c}) OVER w", 2) + " AS {c}_std_5000",
        ("gpu_usage", "temperature"),
    )
    last = "ORDER BY row_idx ROWS BETWEEN 4999 PRECEDING AND CURRENT ROW)"
    twins["rolling_5000"] = over("feat", f"SELECT event_id, {long} FROM feat WINDOW w AS ({last}")
    twins["rolling_5000_by_host"] = over("raw", f"SELECT event_id, host_id, {long} FROM raw WINDOW w AS (PARTITION BY host_id {last}")
    twins |= {f"shared_{name}": twins[key] for name, key in SHARED_SCAN.items()}
    for r in rules.RULES:
        twins[f"rule_{r.id}"] = over(
            "bn",
            "SELECT event_id, timestamp, issue, severity, severity_icon, recommendation FROM bn "
            f"WHERE issue = {quoted(r.issue)}",
        )
    return twins


POWER_BY_WORKLOAD = f"""SELECT workload_type, {sql_round("avg(power_consumption)", 0)} AS avg_power,
  round(max(power_consumption), 0) AS max_power, round(min(power_consumption), 0) AS min_power,
  {sql_round("avg(power_efficiency)", 4)} AS avg_efficiency, count(*) AS samples FROM feat GROUP BY 1"""
