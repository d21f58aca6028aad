"""Run registered queries next to their DuckDB twins: python -m checks.compare SF_DIR [key …]"""

from __future__ import annotations

import sys
import time
from pathlib import Path

import duckdb
import pandas as pd
from pyspark.sql import SparkSession

from checks.oracle import oracle_sql
from checks.queries import queries


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for path in sorted(Path(sf_dir).glob("*.parquet")):
        connection.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM read_parquet('{path}')")
    return connection


def canonical(frame: pd.DataFrame) -> pd.DataFrame:
    """Columns by name, rows by value, so that only content counts."""
    frame = frame[sorted(frame.columns)].astype(object).where(frame.notna(), None)
    text = frame.map(lambda v: repr(v) if not isinstance(v, pd.Timestamp) else v.isoformat())
    return frame.iloc[text.sort_values(list(text.columns)).index].reset_index(drop=True)


def mismatch(ours: pd.DataFrame, twin: pd.DataFrame) -> str | None:
    """Why two results differ, or None when they are equal."""
    if sorted(ours.columns) != sorted(twin.columns):
        return f"columns {sorted(ours.columns)} != {sorted(twin.columns)}"
    if len(ours) != len(twin):
        return f"rows {len(ours)} != {len(twin)}"
    a, b = canonical(ours), canonical(twin)
    for c in a.columns:
        for x, y in zip(a[c], b[c]):
            if x != y or (isinstance(x, (bool, str)) != isinstance(y, (bool, str))):
                return f"{c}: {x!r} != {y!r}"
    return None


def main(sf_dir: str, keys: list[str]) -> int:
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    connection, twins, failed = duck(sf_dir), oracle_sql(), []
    for key, query in queries().items():
        if keys and key not in keys:
            continue
        start = time.time()
        ours = query(spark, sf_dir).toPandas()
        took = time.time() - start
        if key not in twins:
            print(f"rows  {key} {len(ours)} ({took:.2f}s)")
            continue
        start = time.time()
        twin = connection.sql(twins[key]).df()
        problem = mismatch(ours, twin)
        if not problem:
            kinds = twin.dtypes.astype(str).to_dict()
            problem_types = {c: (str(t), kinds[c]) for c, t in ours.dtypes.items() if str(t) != kinds[c] and not str(t).startswith("datetime")}
            if problem_types:
                print("      types:", problem_types)
        print(f"{'FAIL ' if problem else 'ok   '} {key} {len(ours)} ({took:.2f}s / {time.time() - start:.2f}s) {problem or ''}", flush=True)
        failed += [key] if problem else []
    print("failed:", failed)
    return len(failed)


if __name__ == "__main__":
    sys.exit(main(sys.argv[1], sys.argv[2:]))
