"""Trailing row frames of any length over an ordered series.

`Sequence.trailing` repeats the rows before a block in front of it, which is right for frames shorter than a block.
Here the series is cut into blocks as long as the frame.  A frame then ends in its row's own block and begins in the
block before, or is the own block: it is *the rows from its first one to the end of that block* and *the rows of the own
block so far*.  Both are running aggregates, one backwards and one forwards, so a row costs the same whatever the frame's length.
The two halves meet by an equi-join on position: the row that begins a frame is `width - 1` before the row that ends it.

Counts, means and squared deviations of the halves are merged by their exact formula, not by differences of running sums over
the whole series, which would lose the small numbers.

Scale: one exchange by block, one by position; a task holds one frame, in the window operator's buffer, which spills.
"""

from __future__ import annotations

from collections.abc import Sequence as Seq
from dataclasses import replace

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from gridpulse.operators.sequence import BLOCK, Sequence
from gridpulse.schema import ROW

_OWN, _EARLIER = "_own_{}", "_earlier_{}"


def mean_name(metric: str, width: int) -> str:
    return f"{metric}_mean_{width}"


def std_name(metric: str, width: int) -> str:
    return f"{metric}_std_{width}"


def _moments(metric: str, window: WindowSpec | None = None) -> Column:
    """Count, mean and sum of squared deviations of the rows so far (of a group, without a window); zeros where none has a value."""

    def over(aggregate: Column) -> Column:
        return aggregate.over(window.rowsBetween(Window.unboundedPreceding, 0)) if window else aggregate

    n = over(F.count(metric))
    mean = F.coalesce(over(F.avg(metric)), F.lit(0.0))
    squares = F.coalesce(over(F.var_pop(metric)), F.lit(0.0)) * n
    return F.struct(n.alias("n"), mean.alias("mean"), squares.alias("squares"))


def _mean_and_std(metric: str) -> tuple[Column, Column]:
    own, earlier = F.col(_OWN.format(metric)), F.col(_EARLIER.format(metric))

    def part(side: Column, name: str) -> Column:
        return F.coalesce(side[name], F.lit(0))

    a, b = part(own, "n"), part(earlier, "n")
    n = a + b
    apart = part(earlier, "mean") - part(own, "mean")
    mean = part(own, "mean") + apart * b / n
    squares = part(own, "squares") + part(earlier, "squares") + apart * apart * a * b / n
    return F.when(n > 0, mean), F.when(n > 1, F.sqrt(squares / (n - 1)))


def long_rolling(seq: Sequence, metrics: Seq[str], width: int) -> Sequence:
    """Add `<metric>_mean_<width>` and `<metric>_std_<width>` over the last `width` rows, the row itself included.

    Frames stop at the start of the series (of the key, if the series has keys).  Missing readings are passed over; without any in
    the frame the mean is null, with fewer than two the sample deviation is.
    """
    if width < 2:
        raise ValueError("a long frame has two rows or more")
    cut = replace(seq, block=width)
    blocks = cut.blocked(0)
    own = blocks.withColumns({_OWN.format(m): _moments(m, cut.forward) for m in metrics})
    frames = _with_earlier(own, _frame_starts(cut, blocks, metrics), (ROW, *seq.keys), metrics)
    if seq.keys:
        frames = _with_earlier(frames, _whole_keys(cut, blocks, metrics), (BLOCK, *seq.keys), metrics)
    fits = F.col(ROW) % width == width - 1  # the frame is the own block
    frames = frames.withColumns({_EARLIER.format(m): F.when(~fits, F.col(_EARLIER.format(m))) for m in metrics})
    added: dict[str, Column] = {}
    for m in metrics:
        added[mean_name(m, width)], added[std_name(m, width)] = _mean_and_std(m)
    helpers = [n.format(m) for m in metrics for n in (_OWN, _EARLIER)]
    return seq.with_rows(frames.withColumns(added).drop(BLOCK, *helpers))


def _frame_starts(cut: Sequence, blocks: DataFrame, metrics: Seq[str]) -> DataFrame:
    """By the position where its frame ends: what a frame has of the block it begins in."""
    to_end = blocks.withColumns({_EARLIER.format(m): _moments(m, cut.backward) for m in metrics})
    moved = to_end.withColumn(ROW, F.col(ROW) + (cut.block - 1))
    return moved.select(ROW, *cut.keys, *[_EARLIER.format(m) for m in metrics])


def _whole_keys(cut: Sequence, blocks: DataFrame, metrics: Seq[str]) -> DataFrame:
    """By the following block: all that a key has in a block, for frames cut off by the start of their key."""
    following = (F.col(BLOCK) + 1).alias(BLOCK)
    return blocks.groupBy(following, *cut.keys).agg(*[_moments(m).alias(_EARLIER.format(m)) for m in metrics])


def _with_earlier(rows: DataFrame, found: DataFrame, on: Seq[str], metrics: Seq[str]) -> DataFrame:
    """Rows with what was found for them, unless they have it already; a null key equals a null key."""
    right = found.withColumnsRenamed({c: f"_found_{c}" for c in found.columns})
    same = [rows[c] == right[f"_found_{c}"] if c in (ROW, BLOCK) else rows[c].eqNullSafe(right[f"_found_{c}"]) for c in on]
    joined = rows.join(right, same, "left")
    names = [_EARLIER.format(m) for m in metrics]
    known = {n: F.coalesce(*[F.col(c) for c in (n, f"_found_{n}") if c in joined.columns]) for n in names}
    return joined.withColumns(known).drop(*right.columns)
