"""Two-sided p-value of Student's t, for rows that are already aggregated.

Spark SQL has no t distribution, so the regularised incomplete beta function is evaluated in a
pandas UDF. It sees one row per test, never raw data.
"""

from __future__ import annotations

import math

import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _beta_fraction(a: float, b: float, x: float) -> float:
    """Continued fraction of the incomplete beta function, by Lentz's method."""
    tiny = 1e-300
    c, d = 1.0, 1.0 - (a + b) * x / (a + 1.0)
    d = 1.0 / (d if abs(d) > tiny else tiny)
    value = d
    for m in range(1, 10_000):
        even = m * (b - m) * x / ((a + 2 * m - 1) * (a + 2 * m))
        odd = -(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 2 * m + 1))
        for term in (even, odd):
            d = 1.0 + term * d
            d = 1.0 / (d if abs(d) > tiny else tiny)
            c = 1.0 + term / c
            c = c if abs(c) > tiny else tiny
            value *= c * d
        if abs(c * d - 1.0) < 1e-15:
            break
    return value


def incomplete_beta(a: float, b: float, x: float) -> float:
    if x <= 0.0:
        return 0.0
    if x >= 1.0:
        return 1.0
    if x > (a + 1.0) / (a + b + 2.0):
        return 1.0 - incomplete_beta(b, a, 1.0 - x)
    scale = math.lgamma(a + b) - math.lgamma(a) - math.lgamma(b)
    return math.exp(scale + a * math.log(x) + b * math.log1p(-x)) * _beta_fraction(a, b, x) / a


def two_sided_p(t: float, df: float) -> float:
    return incomplete_beta(df / 2.0, 0.5, df / (df + t * t))


@F.pandas_udf(T.DoubleType())
def p_value(t: pd.Series, df: pd.Series) -> pd.Series:
    pairs = zip(t, df)
    return pd.Series([None if pd.isna(a) or pd.isna(b) or b <= 0 else two_sided_p(a, b) for a, b in pairs], dtype="float64")
