"""Two-sided p-value of a correlation coefficient.

p = I_{1-r²}((n-2)/2, 1/2), the regularised incomplete beta function.  It runs on
aggregated rows only (one per pair and workload), never on data rows.
"""

from __future__ import annotations

import math

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType


def _p_function():
    # Nested, so that the functions travel to executors by value and the package
    # need not be installed there.
    def nonzero(v: float) -> float:
        return v if abs(v) > 1e-300 else 1e-300

    def log_gamma_ratio(a: float, b: float) -> float:
        """log(Γ(a + b) / Γ(a)); for b = 1/2 and a large a by its asymptotic series, where the difference would cancel."""
        if b != 0.5 or a < 50:
            return math.lgamma(a + b) - math.lgamma(a)
        return 0.5 * math.log(a) - 1 / (8 * a) + 1 / (192 * a**3) - 1 / (640 * a**5) + 17 / (14336 * a**7)

    def fraction(a: float, b: float, x: float) -> float:
        """Continued fraction of the incomplete beta function (modified Lentz)."""
        c, d = 1.0, 1.0 / nonzero(1.0 - (a + b) * x / (a + 1.0))
        value = d
        for m in range(1, 500 + 20 * int(math.sqrt(max(a, b)))):
            for term in (
                m * (b - m) * x / ((a + 2 * m - 1) * (a + 2 * m)),
                -(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 2 * m + 1)),
            ):
                d = 1.0 / nonzero(1.0 + term * d)
                c = nonzero(1.0 + term / c)
                value *= c * d
            if abs(c * d - 1.0) < 1e-15:
                return value
        raise ArithmeticError(f"the p-value did not converge: {a}, {b}, {x}")

    def incomplete_beta(a: float, b: float, y: float) -> float:
        """I_x(a, b) at x = 1 - y; y is given, as 1 - x would lose its digits."""
        if y <= 0.0 or y >= 1.0:
            return 1.0 if y <= 0.0 else 0.0
        log_front = log_gamma_ratio(a, b) - math.lgamma(b) + a * math.log1p(-y) + b * math.log(y)
        if 1.0 - y < (a + 1.0) / (a + b + 2.0):
            return math.exp(log_front) * fraction(a, b, 1.0 - y) / a
        return 1.0 - math.exp(log_front) * fraction(b, a, y) / b

    def p(r: float | None, n: int) -> float:
        if r is None or math.isnan(r) or n <= 2:
            return math.nan
        return incomplete_beta((n - 2) / 2.0, 0.5, min(1.0, r * r))

    return p


correlation_p = _p_function()


def correlation_p_value(r: str, n: str) -> Column:
    p = correlation_p

    @F.pandas_udf(DoubleType())
    def p_values(r: pd.Series, n: pd.Series) -> pd.Series:
        return pd.Series([p(ri, ni) for ri, ni in zip(r, n)], dtype="float64")

    return p_values(r, n)
