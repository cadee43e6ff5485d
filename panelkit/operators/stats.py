"""Distribution summaries: moments, quantiles, correlation, histogram, density."""

from __future__ import annotations

import math
from collections.abc import Sequence
from functools import reduce
from itertools import combinations_with_replacement

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelkit.operators.ordered import quantile_columns
from panelkit.operators.quantiles import column_quantiles
from panelkit.runtime import lookup_side

#: Bins of the density estimate to a bandwidth.
KDE_BINS = 16


def _moments(value: str) -> list[Column]:
    return [
        F.count(value).cast("bigint").alias("count"),
        F.avg(value).alias("mean"),
        F.stddev_samp(value).alias("std"),
        F.min(value).alias("min"),
        F.max(value).alias("max"),
    ]


def _stack(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    wide = df.select(*[F.col(c).cast("double").alias(c) for c in columns])
    return wide.unpivot([], list(columns), "column", "value")


def describe(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Count, mean, std, min, quartiles and max; one row per column."""
    quartiles = column_quantiles(df, columns, [0.25, 0.5, 0.75])
    rows = df.sparkSession.createDataFrame(
        [(c, q[0.25], q[0.5], q[0.75]) for c, q in quartiles.items()], "column string, p25 double, p50 double, p75 double"
    )
    basics = _stack(df, columns).groupBy("column").agg(*_moments("value"))
    return basics.join(F.broadcast(rows), "column", "left").select(  # a row for each column
        "column", "count", "mean", "std", "min", "p25", "p50", "p75", "max"
    )


def target_summary(df: DataFrame, value: str) -> DataFrame:
    """Mean, sample standard deviation, min and max of one column."""
    return df.agg(*_moments(value)).select("mean", "std", "min", "max")


def correlation_matrix(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Pearson correlation of all pairs in one aggregate: (f1, f2, r).

    Each pair uses the rows where both are present. A column without variance
    gives null.
    """
    pairs = list(combinations_with_replacement(columns, 2))

    def correlation(a: str, b: str) -> Column:
        both = F.col(a).isNotNull() & F.col(b).isNotNull()
        spread = F.stddev_samp(F.when(both, F.col(a))) * F.stddev_samp(F.when(both, F.col(b)))
        return F.try_divide(F.covar_samp(a, b), spread)

    row = df.agg(*[correlation(a, b).alias(f"r{i}") for i, (a, b) in enumerate(pairs)])
    cells = []
    for i, (a, b) in enumerate(pairs):
        for x, y in {(a, b), (b, a)}:
            cells.append(
                F.struct(F.lit(x).alias("f1"), F.lit(y).alias("f2"), F.col(f"r{i}").alias("r"))
            )
    return row.select(F.inline(F.array(*cells)))


def strong_pairs(
    correlations: DataFrame, columns: Sequence[str], threshold: float = 0.7
) -> DataFrame:
    """Pairs of the upper triangle with |r| above the threshold."""
    rank = F.create_map(*[F.lit(v) for i, c in enumerate(columns) for v in (c, i)])
    upper = rank[F.col("f1")] < rank[F.col("f2")]
    return correlations.where(upper & (F.abs("r") > threshold))


def _keyed(df: DataFrame, by: Sequence[str]) -> tuple[DataFrame, list[str], list[str]]:
    """Give an ungrouped frame a constant key, so one code path serves both."""
    if by:
        return df, list(by), []
    return df.withColumn("_all", F.lit(0)), ["_all"], ["_all"]


def histogram(
    df: DataFrame, value: str, bins: int, by: Sequence[str] = (), density: bool = False
) -> DataFrame:
    """Equal-width bins between min and max, the last one closed; empty bins included.

    Columns: by..., bin, bin_start, bin_end, n and, if asked for, density.
    """
    rows, keys, extra = _keyed(df.select(*by, value), by)
    rows = rows.where(F.col(value).isNotNull())
    limits = rows.groupBy(*keys).agg(
        F.min(value).alias("_min"), F.max(value).alias("_max"), F.count(value).alias("_total")
    )
    flat = F.col("_min") == F.col("_max")
    limits = lookup_side(
        limits.select(
            *keys,
            F.when(flat, F.col("_min") - 0.5).otherwise(F.col("_min")).alias("_lo"),
            F.when(flat, F.col("_max") + 0.5).otherwise(F.col("_max")).alias("_hi"),
            "_total",
        )
    )
    span = F.col("_hi") - F.col("_lo")
    position = F.floor((F.col(value) - F.col("_lo")) / span * bins)
    counts = (
        rows.join(limits, keys)
        .groupBy(*keys, F.least(position, F.lit(bins - 1)).cast("int").alias("bin"))
        .agg(F.count(F.lit(1)).alias("n"))
    )
    frame = limits.withColumn("bin", F.explode(F.sequence(F.lit(0), F.lit(bins - 1))))
    n = F.coalesce("n", F.lit(0)).cast("bigint")
    out = [
        *[F.col(c) for c in by],
        F.col("bin").cast("bigint").alias("bin"),
        (F.col("_lo") + span * F.col("bin") / bins).alias("bin_start"),
        (F.col("_lo") + span * (F.col("bin") + 1) / bins).alias("bin_end"),
        n.alias("n"),
    ]
    if density:
        out.append((n / (F.col("_total") * (span / bins))).alias("density"))
    return frame.join(counts, [*keys, "bin"], "left").select(*out)


def _with_fences(df: DataFrame, value: str, by: Sequence[str]) -> tuple[DataFrame, list[str]]:
    rows, keys, _ = _keyed(df.select(*by, value), by)
    rows = rows.where(F.col(value).isNotNull())
    quartiles = quantile_columns(rows, keys, value, {"q1": 0.25, "median": 0.5, "q3": 0.75})
    reach = 1.5 * (F.col("q3") - F.col("q1"))
    fences = lookup_side(
        quartiles.withColumn("_lo", F.col("q1") - reach).withColumn("_hi", F.col("q3") + reach)
    )
    return rows.join(fences, keys), keys


def box_summary(df: DataFrame, value: str, by: Sequence[str] = ()) -> DataFrame:
    """Quartiles, whiskers at the last value inside 1.5 IQR, and outlier count."""
    rows, keys = _with_fences(df, value, by)
    v = F.col(value)
    inside = v.between(F.col("_lo"), F.col("_hi"))
    stats = rows.groupBy(*keys).agg(
        F.max("q1").alias("q1"),
        F.max("median").alias("median"),
        F.max("q3").alias("q3"),
        F.min(F.when(inside, v)).alias("whisker_low"),
        F.max(F.when(inside, v)).alias("whisker_high"),
        F.avg(v).alias("mean"),
        F.sum((~inside).cast("bigint")).cast("bigint").alias("n_outliers"),
        F.count(v).cast("bigint").alias("n"),
    )
    return stats.drop("_all")


def box_outliers(df: DataFrame, value: str, by: Sequence[str] = ()) -> DataFrame:
    """The values beyond the whiskers: (by..., value)."""
    rows, _ = _with_fences(df, value, by)
    return rows.where(~F.col(value).between(F.col("_lo"), F.col("_hi"))).select(*by, value)


def kde(
    df: DataFrame,
    value: str,
    by: Sequence[str] = (),
    points: int = 100,
    min_variance: float = 1e-10,
) -> DataFrame:
    """Gaussian density estimate with Scott's bandwidth on an even grid.

    Rows are binned, a sixteenth of a bandwidth to a bin, and a bin keeps the sums of the
    powers 0 to 6 of its rows' distances from its middle. The kernels of its rows
    around a grid point are then a series in Hermite polynomials, whose rest is at most
    5e-13 of a kernel's peak for every row. So one pass over the rows, combined
    map-side, leaves bins, and only these meet the grid points. Groups whose
    variance is at most ``min_variance`` are left out.
    """
    rows, keys, _ = _keyed(df.select(*by, value), by)
    rows = rows.where(F.col(value).isNotNull())
    shape = (
        rows.groupBy(*keys)
        .agg(
            F.count(value).cast("double").alias("_n"),
            F.min(value).alias("_lo"),
            F.max(value).alias("_hi"),
            F.stddev_samp(value).alias("_std"),
            F.var_pop(value).alias("_var"),
        )
        .where(F.col("_var") > min_variance)
        .withColumn("_h", F.pow("_n", F.lit(-0.2)) * F.col("_std"))
    )
    shape = lookup_side(shape)
    step = (F.col("_hi") - F.col("_lo")) / (points - 1)
    place = (F.col(value) - F.col("_lo")) / F.col("_h")
    binned = rows.join(shape, keys).select(*keys, place.alias("_at"), F.floor(place * KDE_BINS).alias("_bin"))
    middle = (F.col("_bin") + 0.5) / KDE_BINS
    away = F.col("_at") - middle
    powers = [F.sum(F.pow(away, F.lit(float(k))) if k else F.lit(1.0)).alias(f"_m{k}") for k in range(7)]
    grid = (
        binned.groupBy(*keys, "_bin").agg(*powers).join(shape, keys)
        .withColumn("point", F.explode(F.sequence(F.lit(0), F.lit(points - 1))))
        .withColumn("_u", step * F.col("point") / F.col("_h") - middle)
    )
    u, u2 = F.col("_u"), F.col("_u") * F.col("_u")
    hermite = [
        F.lit(1.0), u, u2 - 1, u * (u2 - 3), (u2 - 6) * u2 + 3, u * ((u2 - 10) * u2 + 15), ((u2 - 15) * u2 + 45) * u2 - 15,
    ]
    series = reduce(lambda x, y: x + y, [h * F.col(f"_m{k}") / math.factorial(k) for k, h in enumerate(hermite)])
    sums = grid.groupBy(*keys, "point").agg(F.sum(F.exp(u2 * -0.5) * series).alias("_sum"))
    scale = F.col("_n") * F.col("_h") * math.sqrt(2.0 * math.pi)
    return sums.join(shape, keys).select(
        *by,
        F.col("point").cast("bigint").alias("point"),
        (F.col("_lo") + step * F.col("point")).alias("x"),
        (F.col("_sum") / scale).alias("density"),
    )
