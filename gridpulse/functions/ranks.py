"""Average ranks (ties share the mean of their positions) for several variables at once.

Values are counted before they are ordered, so repeated values cost one row.  The counts of all variables, over all rows and inside
groups, are one ordered series: one range exchange, and prefix sums that no single task sees whole.  There is one path for
every size; whether a variable's ranks then reach the rows by a broadcast or a shuffle is left to Spark, which knows the stored table's size.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridpulse.operators.sequence import Sequence
from gridpulse.schema import ROW
from gridpulse.workspace import store

# A value that fills more than 1/HOT_SHARE of the rows is joined by broadcast;
# per variable there can be at most HOT_SHARE such values (in each group they occur in).
HOT_SHARE = 1000

# Rows that need no shuffled look-up are dealt to so many keys that match nothing.
SPREAD = 1009


def average_ranks(rows: DataFrame, length: int, variables: dict[str, Column], group: str) -> DataFrame:
    """One row per input row: `row_idx`, `group`, and per variable `<name>_rank`
    (over all rows) and `<name>_group_rank` (inside the row's group); null where the variable is null.
    """
    long = rows.select(
        ROW,
        group,
        F.inline(
            F.array(*[F.struct(F.lit(i).alias("var"), v.alias("x")) for i, v in enumerate(variables.values())])
        ),
    ).where(F.col("x").isNotNull())
    counts = store(long.groupBy(group, "var", "x").agg(F.count(F.lit(1)).alias("cnt")), "value_counts")
    ranks = store(_ranked(counts, group), "ranks")
    return store(_look_up(rows, ranks, length // HOT_SHARE, variables, group), "row_ranks")


def _mean_position(upto: Column, ties: Column) -> Column:
    return upto - (ties - 1) / 2


def _ranked(counts: DataFrame, group: str) -> DataFrame:
    """(_var, _group, _x, rank, group_rank, ties, _spread) of every counted value."""
    overall = counts.groupBy("var", "x").agg(F.sum("cnt").alias("cnt"))
    everyone = overall.select(F.lit(0).alias("scope"), F.lit(None).cast(counts.schema[group].dataType).alias(group), "var", "x", "cnt")
    both = everyone.unionByName(counts.select(F.lit(1).alias("scope"), group, "var", "x", "cnt"))
    summed = Sequence.of(both, order=("x",), keys=("scope", group, "var")).running_sum("cnt", "_upto")
    placed = store(summed.select("scope", group, "var", "x", "cnt", _mean_position(F.col("_upto"), F.col("cnt")).alias("at")), "value_ranks")
    total = placed.where("scope = 0").select("var", "x", F.col("at").alias("rank"), F.col("cnt").alias("ties"))
    inside = placed.where("scope = 1").select(F.col(group).alias("_group"), "var", "x", F.col("at").alias("group_rank"))
    # stored, as a literal would fold out of the join's keys
    return inside.join(total, ["var", "x"]).select(
        F.col("var").alias("_var"), "_group", F.col("x").alias("_x"), "rank", "group_rank", "ties", F.lit(-1).alias("_spread")
    )


def _look_up(rows: DataFrame, ranks: DataFrame, limit: int, variables: dict[str, Column], group: str) -> DataFrame:
    """Two left joins per variable.  Frequent values come by broadcast; the rows that hold them, or none, are
    dealt out over `SPREAD` keys in the join for the rest, so neither a hot value nor nulls fill one partition.
    """
    out = rows.select(ROW, group, *[v.alias(f"_x{i}") for i, v in enumerate(variables.values())])
    for i, name in enumerate(variables):
        table = ranks.where(F.col("_var") == i).drop("_var")
        hot = table.where(F.col("ties") > limit).select(
            F.col("_group").alias("_hot_group"), F.col("_x").alias("_hot_x"), F.struct("rank", "group_rank").alias("_hot")
        )
        rest = table.where(F.col("ties") <= limit).select(
            "_group", "_x", "_spread", F.struct("rank", "group_rank").alias("_rest")
        )
        x = F.col(f"_x{i}")
        out = out.join(F.broadcast(hot), (x == F.col("_hot_x")) & F.col(group).eqNullSafe(F.col("_hot_group")), "left")
        done = F.col("_hot").isNotNull() | x.isNull()
        out = out.withColumn("_at", F.when(done, (F.col(ROW) % SPREAD).cast("int")).otherwise(-1))
        same = (x == F.col("_x")) & F.col(group).eqNullSafe(F.col("_group")) & (F.col("_at") == F.col("_spread"))
        found = F.coalesce("_hot", "_rest")
        out = out.join(rest, same, "left").withColumns(
            {f"{name}_{kind}": found[kind] for kind in ("rank", "group_rank")}
        ).drop("_hot_group", "_hot_x", "_hot", "_at", "_group", "_x", "_spread", "_rest", f"_x{i}")
    return out
