"""Runs kept at a path, to be opened again by later sessions."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from gridpulse.operators.sequence import Sequence
from gridpulse.plans.run import Run
from gridpulse.schema import ROW, TS
from gridpulse.sources.tables import current, replace

DATE = "date"
ABOUT = "length long, block int, keys array<string>, schemas map<string, string>"


def _clustered(table: DataFrame) -> DataFrame:
    """Ordered by time and laid out by day: a time filter reads the files of its days only."""
    return table.withColumn(DATE, F.to_date(TS)).repartitionByRange(DATE, TS, ROW).sortWithinPartitions(DATE, TS, ROW)


def save_run(run: Run, path: str) -> str:
    """Write all tables of a run, with positions, keys and flags; what was at the path is replaced, all tables at once."""
    spark = run.raw.sparkSession
    held = {"raw": run.raw, "system_metrics": run.metrics.rows, "bottlenecks": run.bottlenecks, "anomalies": run.anomalies}
    laid_out = {name: _clustered(table) for name, table in held.items()}
    # A table without rows has no files that could tell its columns.
    about = [(run.metrics.length, run.metrics.block, list(run.metrics.keys), {n: t.schema.json() for n, t in laid_out.items()})]

    def write(folder: str) -> None:
        for name, table in laid_out.items():
            table.write.partitionBy(DATE).parquet(f"{folder}/{name}")
        spark.createDataFrame(about, ABOUT).coalesce(1).write.json(f"{folder}/about")

    return replace(spark, path, write)


def open_run(spark: SparkSession, path: str) -> Run:
    """The run stored at a path.  Its tables also have the day, `date`, by which they are laid out."""
    folder = current(spark, path)  # one version for all tables
    about = spark.read.schema(ABOUT).json(f"{folder}/about").first()
    tables = {n: spark.read.schema(StructType.fromJson(json.loads(s))).parquet(f"{folder}/{n}") for n, s in about.schemas.items()}
    metrics = Sequence(tables["system_metrics"], about.length, about.block, tuple(about.keys))
    return Run(raw=tables["raw"], metrics=metrics, bottlenecks=tables["bottlenecks"], anomalies=tables["anomalies"])
