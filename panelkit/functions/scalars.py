"""Scalar expressions over Spark columns."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from panelkit.spec import YEAR_MAX, YEAR_MIN


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def to_number(c: Column | str) -> Column:
    """Lenient cast to double: bad text and NaN become null."""
    number = _col(c).try_cast("double")
    return F.when(~F.isnan(number), number)


def to_period(c: Column | str) -> Column:
    """Lenient cast to an integer period; a fractional or bad value gives null."""
    number = to_number(c)
    return F.when(number == F.floor(number), number.try_cast("int"))


def ratio(num: Column | str, den: Column | str) -> Column:
    """Division that yields null for a zero denominator."""
    return F.try_divide(_col(num).cast("double"), _col(den).cast("double"))


def squared_error(actual: Column | str, predicted: Column | str) -> Column:
    diff = _col(actual) - _col(predicted)
    return diff * diff


def slug(c: Column | str) -> Column:
    """Lower-case with spaces turned into underscores."""
    return F.replace(F.lower(_col(c)), F.lit(" "), F.lit("_"))


def is_year(c: Column | str) -> Column:
    return _col(c).between(YEAR_MIN, YEAR_MAX)


def half_life(rho: Column | str) -> Column:
    """Periods until a shock has halved; null unless 0 < rho < 1."""
    r = _col(rho)
    inside = (r > 0) & (r < 1)
    return F.when(inside, -F.log(F.lit(2.0)) / F.log(F.when(inside, r)))


def persistence_label(rho: Column | str) -> Column:
    """STRONG / MODERATE / WEAK for 0 < rho < 1, else EXPLOSIVE or NONE."""
    r = _col(rho)
    return (
        F.when(r >= 1, "EXPLOSIVE")
        .when(r > 0.7, "STRONG")
        .when(r > 0.4, "MODERATE")
        .when(r > 0, "WEAK")
        .otherwise("NONE")
    )


def level_band(c: Column | str, low: float = -1.0, high: float = 0.5) -> Column:
    """``low`` below the first cut, ``high`` above the second, else ``moderate``."""
    v = _col(c)
    return F.when(v < low, "low").when(v > high, "high").when(v.isNotNull(), "moderate")


def trend_label(delta: Column | str) -> Column:
    d = _col(delta)
    return F.when(d > 0, "Improving").when(d < 0, "Declining").when(d == 0, "Stable")


#: Upper limits of p and the label each earns, strictest first.
SIGNIFICANCE_LEVELS: Sequence[tuple[float, str]] = (
    (0.001, "***"),
    (0.01, "**"),
    (0.05, "*"),
)


def significance_label(p: Column | str) -> Column:
    """The strictest label ``p`` earns, else ``ns``."""
    v = _col(p)
    labels = [F.when(v < limit, label) for limit, label in SIGNIFICANCE_LEVELS]
    return F.coalesce(*labels, F.when(v.isNotNull(), "ns"))


def performance_tier(r2: Column | str) -> Column:
    """``excellent`` from 0.75, ``good`` from 0.65, else ``moderate``."""
    v = _col(r2)
    return F.when(v >= 0.75, "excellent").when(v >= 0.65, "good").when(v.isNotNull(), "moderate")


def median_of(values: Sequence[Column], least: int = 1) -> Column:
    """Median of the non-null values of a few columns; null if fewer than ``least``.

    The sorted values are bound to a lambda variable, so the expression names
    every value once and stays small enough to compile well.
    """

    def middle(ordered: Column) -> Column:
        n = F.size(ordered)
        low = F.get(ordered, F.floor((n - 1) / 2).cast("int"))
        high = F.get(ordered, F.floor(n / 2).cast("int"))
        return F.when(n >= max(least, 1), (low + high) / 2)

    bound = F.array(F.sort_array(F.array_compact(F.array(*values))))
    return F.get(F.transform(bound, middle), F.lit(0))
