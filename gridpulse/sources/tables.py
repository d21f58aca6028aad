"""Tables at a path that are replaced as a whole or not at all.

A table is written to a version folder of its own.  Only when all of it is there, an empty marker file named after the
version appears in `_current`; creating one file is atomic on HDFS, object stores and local disks alike.  Readers take
the version of the latest marker.  A driver lost half-way leaves a folder that no marker names, and the old table.

    path/v-<hex>/…                       the versions
    path/_current/000000000007.v-<hex>   the markers

The version before the current one stays, so that a reader who opened it can finish.
"""

from __future__ import annotations

import time
import uuid
from collections.abc import Callable

from py4j.java_gateway import JavaObject
from pyspark.sql import DataFrame, SparkSession

MARKERS = "_current"
KEPT = 2  # versions that stay: the current one and the one before


def _path(spark: SparkSession, *parts: str) -> JavaObject:
    return spark.sparkContext._jvm.org.apache.hadoop.fs.Path("/".join(parts))


def _files(spark: SparkSession, path: str) -> JavaObject:
    return _path(spark, path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def _names(spark: SparkSession, folder: str) -> list[str]:
    files = _files(spark, folder)
    if not files.exists(_path(spark, folder)):
        return []
    return sorted(s.getPath().getName() for s in files.listStatus(_path(spark, folder)))


def _markers(spark: SparkSession, path: str) -> list[str]:
    return [n for n in _names(spark, f"{path}/{MARKERS}") if ".v-" in n]


def _version(marker: str) -> str:
    return marker.split(".", 1)[1]


def current(spark: SparkSession, path: str) -> str:
    """The folder that holds the table now; the path itself where nothing was ever replaced."""
    markers = _markers(spark, path)
    return f"{path}/{_version(markers[-1])}" if markers else path


def read(spark: SparkSession, path: str) -> DataFrame:
    """The current version of a table; it stays readable across one replacement."""
    return spark.read.parquet(current(spark, path))


def replace(spark: SparkSession, path: str, write: Callable[[str], None]) -> str:
    """Let `write(folder)` write a new version, then make it the current one.  Returns the path.

    If `write` fails, the old version stays current and the failed one is removed.  Of writers at the same time the one
    with the latest marker wins, whole.
    """
    path = path.rstrip("/")
    files = _files(spark, path)
    version = f"v-{uuid.uuid4().hex}"
    try:
        write(f"{path}/{version}")
    except BaseException:
        files.delete(_path(spark, path, version), True)
        raise
    markers = _markers(spark, path)
    number = int(markers[-1].split(".")[0]) + 1 if markers else 1
    files.create(_path(spark, path, MARKERS, f"{number:012d}.{version}"), False).close()
    for marker in _markers(spark, path)[:-KEPT]:
        files.delete(_path(spark, path, _version(marker)), True)
        files.delete(_path(spark, path, MARKERS, marker), False)
    return path


def vacuum(spark: SparkSession, path: str, hours: float = 24.0) -> int:
    """Delete versions that no marker names, left behind by lost drivers, and return how many.

    Younger ones than `hours` may still be being written and stay.
    """
    named = {_version(m) for m in _markers(spark, path)}
    files, oldest, gone = _files(spark, path), (time.time() - hours * 3600) * 1000, 0
    for name in _names(spark, path):
        folder = _path(spark, path, name)
        if name.startswith("v-") and name not in named and files.getFileStatus(folder).getModificationTime() <= oldest:
            gone += bool(files.delete(folder, True))
    return gone
