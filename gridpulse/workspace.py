"""Tables written to the cluster's shared folder to cut lineage.

A written parquet table survives lost executors, keeps column pruning and
predicate pushdown for its readers, and freezes values (such as row positions)
that must not change when a plan is evaluated twice.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """The folder named by `spark.checkpoint.dir`.

    Only a local-mode session without that setting (tests) gets a temporary one;
    on a cluster a machine-local folder would not be visible to all executors.
    """
    sc = spark.sparkContext
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if configured:
        return configured.rstrip("/")
    if not sc.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors can reach")
    sc.setCheckpointDir(tempfile.mkdtemp(prefix="gridpulse-"))
    return sc.getCheckpointDir().rstrip("/")


def new_path(spark: SparkSession, name: str) -> str:
    """A path in the shared folder that no other run uses."""
    app = spark.sparkContext.applicationId
    return f"{shared_dir(spark)}/gridpulse/{app}/{name}-{uuid.uuid4().hex}"


def store(df: DataFrame, name: str) -> DataFrame:
    """Write `df` to the shared folder and return a scan of what was written."""
    spark = df.sparkSession
    path = new_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def release(spark: SparkSession) -> None:
    """Delete every table this application stored."""
    app = spark.sparkContext.applicationId
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(f"{shared_dir(spark)}/gridpulse/{app}")
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)
