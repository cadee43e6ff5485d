"""Tail probabilities of F, t and chi-squared for a handful of result scalars.

Built on the regularised incomplete beta and gamma functions, evaluated with
their textbook series and continued fractions.
"""

from __future__ import annotations

import math

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

_EPS = 1e-16
_TINY = 1e-300


def _continued_fraction(terms, limit: int = 10_000) -> float:
    """Evaluate b0 + a1/(b1 + a2/(b2 + ...)) by the modified Lentz method.

    ``terms`` yields (a_j, b_j), the first pair being (unused, b0).
    """
    _, b0 = next(terms)
    value = b0 or _TINY
    c, d = value, 0.0
    for _, (a, b) in zip(range(limit), terms):
        d = b + a * d or _TINY
        c = b + a / c or _TINY
        d = 1.0 / d
        step = c * d
        value *= step
        if abs(step - 1.0) < _EPS:
            return value
    if abs(step - 1.0) > 1e-9:
        raise ArithmeticError(f"a continued fraction did not settle in {limit} terms")
    return value


def beta_reg(a: float, b: float, x: float) -> float:
    """Regularised incomplete beta function I_x(a, b)."""
    if x <= 0.0:
        return 0.0
    if x >= 1.0:
        return 1.0
    if x > (a + 1.0) / (a + b + 2.0):
        return 1.0 - beta_reg(b, a, 1.0 - x)

    def terms():
        yield 0.0, 1.0
        m = 0
        while True:
            yield -(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 2 * m + 1)), 1.0
            m += 1
            yield m * (b - m) * x / ((a + 2 * m - 1) * (a + 2 * m)), 1.0

    log_front = (
        math.lgamma(a + b) - math.lgamma(a) - math.lgamma(b)
        + a * math.log(x) + b * math.log1p(-x)
    )
    return math.exp(log_front) / (a * _continued_fraction(terms()))


def gamma_upper_reg(s: float, x: float) -> float:
    """Regularised upper incomplete gamma function Q(s, x)."""
    if x <= 0.0:
        return 1.0
    front = math.exp(-x + s * math.log(x) - math.lgamma(s))
    if x < s + 1.0:
        term = total = 1.0 / s
        n = s
        while abs(term) > abs(total) * _EPS:
            n += 1.0
            term *= x / n
            total += term
        return max(0.0, 1.0 - front * total)

    def terms():
        yield 0.0, x + 1.0 - s
        j = 1
        while True:
            yield -j * (j - s), x + 2.0 * j + 1.0 - s
            j += 1

    return front / _continued_fraction(terms())


def f_sf(stat: float | None, d1: float | None, d2: float | None) -> float | None:
    """P(F > stat) with d1 and d2 degrees of freedom."""
    if stat is None or d1 is None or d2 is None or math.isnan(stat) or d1 <= 0 or d2 <= 0:
        return None
    if math.isinf(stat):
        return 0.0 if stat > 0 else 1.0
    if stat <= 0:
        return 1.0
    return beta_reg(d2 / 2.0, d1 / 2.0, d2 / (d2 + d1 * stat))


def t_two_sided(stat: float | None, df: float | None) -> float | None:
    """P(|T| > |stat|) with df degrees of freedom."""
    if stat is None or df is None or math.isnan(stat) or df <= 0:
        return None
    if math.isinf(stat):
        return 0.0
    return beta_reg(df / 2.0, 0.5, df / (df + stat * stat))


def chi2_sf(stat: float | None, df: float | None) -> float | None:
    """P(X > stat) for a chi-squared variable with df degrees of freedom."""
    if stat is None or df is None or math.isnan(stat) or df <= 0:
        return None
    return gamma_upper_reg(df / 2.0, stat / 2.0)


@F.pandas_udf(T.DoubleType())
def _f_sf_column(stat: pd.Series, d1: pd.Series, d2: pd.Series) -> pd.Series:
    return pd.Series([f_sf(*row) for row in zip(stat, d1, d2)], dtype="float64")


def f_sf_column(stat: Column, d1: Column, d2: Column) -> Column:
    """``f_sf`` on a result table of a few rows."""
    return _f_sf_column(stat.cast("double"), d1.cast("double"), d2.cast("double"))
