"""Tail probabilities for the test reports, computed on result rows only."""

from __future__ import annotations

import math

import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql import types as T


def chi2_tail(stat: float, dof: int) -> float:
    """P(X >= stat) for chi-square with integer ``dof``: the finite closed form."""
    if dof < 1:
        return 1.0
    half = stat / 2.0
    if dof % 2 == 0:
        term, total = 1.0, 1.0
        for i in range(1, dof // 2):
            term *= half / i
            total += term
        return min(1.0, math.exp(-half) * total)
    total = 0.0
    for i in range((dof - 1) // 2):
        k = i + 0.5
        total += math.exp(k * math.log(half) - math.lgamma(k + 1.0)) if half > 0 else 0.0
    return min(1.0, math.erfc(math.sqrt(half)) + math.exp(-half) * total)


def _beta_fraction(a: float, b: float, x: float) -> float:
    """Continued fraction of the regularised incomplete beta function."""
    tiny = 1e-300
    c, d = 1.0, 1.0 - (a + b) * x / (a + 1.0)
    d = 1.0 / (d if abs(d) > tiny else tiny)
    out = d
    for m in range(1, 500):
        for num in (
            m * (b - m) * x / ((a + 2 * m - 1) * (a + 2 * m)),
            -(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 2 * m + 1)),
        ):
            d = 1.0 + num * d
            c = 1.0 + num / c
            d = 1.0 / (d if abs(d) > tiny else tiny)
            c = c if abs(c) > tiny else tiny
            out *= d * c
        if abs(d * c - 1.0) < 1e-15:
            break
    return out


def student_two_sided(t: float, dof: float) -> float:
    """P(|T| >= |t|) for Student's t."""
    if math.isnan(t) or dof <= 0:
        return math.nan
    x = dof / (dof + t * t)
    if x <= 0.0:
        return 0.0
    if x >= 1.0:
        return 1.0
    a, b = dof / 2.0, 0.5
    front = math.exp(
        math.lgamma(a + b) - math.lgamma(a) - math.lgamma(b) + a * math.log(x) + b * math.log1p(-x)
    )
    if x < (a + 1.0) / (a + b + 2.0):
        return front * _beta_fraction(a, b, x) / a
    return 1.0 - front * _beta_fraction(b, a, 1.0 - x) / b


@F.pandas_udf(T.DoubleType())
def chi2_p(stat: pd.Series, dof: pd.Series) -> pd.Series:
    return pd.Series([None if pd.isna(s) else chi2_tail(s, int(d)) for s, d in zip(stat, dof)], dtype="float64")


@F.pandas_udf(T.DoubleType())
def student_p(t: pd.Series, dof: pd.Series) -> pd.Series:
    return pd.Series([None if pd.isna(s) else student_two_sided(s, d) for s, d in zip(t, dof)], dtype="float64")
