"""Values per key, brought to the rows of the key."""

from __future__ import annotations

from collections.abc import Sequence as Seq
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Parts that the rows of one key are dealt to when they are shuffled for a join.
PARTS = 32


def same_keys(keys: Seq[str], prefix: str) -> Column:
    """Keys equal those with the prefix; null equals null."""
    return reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(prefix + c)) for c in keys])


def joined_by_key(rows: DataFrame, per_key: DataFrame, keys: Seq[str], parts: int = PARTS) -> DataFrame:
    """All rows with the columns of their key's one row; null is a key.

    Spark sends `per_key` to all tasks if it is small.  If not, both sides are shuffled: then rows are also dealt to parts by chance, and
    `per_key` goes to all of them, so that a key with a third of all rows does not fill one task.
    """
    of_key = per_key.withColumnsRenamed({c: f"_k_{c}" for c in keys})
    dealt = rows.withColumn("_part", F.pmod(F.xxhash64(*rows.columns), F.lit(parts)))
    repeated = of_key.withColumn("_k_part", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(parts - 1).cast("long"))))
    on = same_keys(keys, "_k_") & (F.col("_part") == F.col("_k_part"))
    return dealt.join(repeated, on, "left").drop("_part", "_k_part", *[f"_k_{c}" for c in keys])
