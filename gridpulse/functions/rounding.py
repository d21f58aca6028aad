"""Rounding rules shared by all operators.

`half_even` rounds ties to the even neighbour (the rule for stored features).
`denoise` first removes the last bits of a floating sum, which depend on the
order in which partial sums were merged, so a rounded result is reproducible
under any partitioning.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def half_even(x: Column, digits: int) -> Column:
    scale = F.lit(float(10**digits))
    return F.rint(x * scale) / scale


def denoise(x: Column) -> Column:
    return half_even(x, 8)


def stable(x: Column, digits: int) -> Column:
    """Half-even rounding of an order-sensitive aggregate."""
    return half_even(denoise(x), digits)
