"""Evolution of a value over periods, overall and by region.

The per-period aggregates are plain group-bys with map-side partial sums. They
also accept a streaming DataFrame.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from panelkit.functions.scalars import trend_label
from panelkit.spec import PanelSpec


def assign_region(
    df: DataFrame, spec: PanelSpec, lookup: DataFrame, default: str = "Other"
) -> DataFrame:
    """Add ``region`` from a lookup of (entity, region), else ``default``."""
    table = lookup.select(spec.entity, "region")
    return df.join(table, spec.entity, "left").withColumn(
        "region", F.coalesce("region", F.lit(default))
    )


def period_evolution(df: DataFrame, spec: PanelSpec, value: str) -> DataFrame:
    """Per period: sum, count and average of the value."""
    return df.groupBy(spec.time).agg(
        F.sum(value).alias("total"),
        F.count(value).cast("bigint").alias("n"),
        F.avg(value).alias("average"),
    )


def _first_by(order: list[Column], payload: Column) -> Column:
    """The payload of the row that sorts first, as a mergeable aggregate."""
    return F.min(F.struct(*[o.alias(f"k{i}") for i, o in enumerate(order)], payload.alias("v")))["v"]


def evolution_summary(evolution: DataFrame, spec: PanelSpec) -> DataFrame:
    """One row over the period averages.

    Span, mean of the averages, lowest and highest with the period they occur
    in (the earliest on ties), change from first to last, and average count.
    """
    t, a = F.col(spec.time), F.col("average")
    known = evolution.where(a.isNotNull())
    return known.agg(
        F.min(t).cast("bigint").alias("first_period"),
        F.max(t).cast("bigint").alias("last_period"),
        F.avg(a).alias("overall_average"),
        F.min(a).alias("lowest"),
        _first_by([a, t], t).cast("bigint").alias("lowest_period"),
        F.max(a).alias("highest"),
        _first_by([-a, t], t).cast("bigint").alias("highest_period"),
        (_first_by([-t], a) - _first_by([t], a)).alias("total_change"),
        F.floor(F.avg("n")).cast("bigint").alias("average_count"),
    )


def region_evolution(df: DataFrame, spec: PanelSpec, value: str) -> DataFrame:
    """Per region and period: mean, sample standard deviation, count."""
    return df.groupBy("region", spec.time).agg(
        F.avg(value).alias("mean"),
        F.stddev_samp(value).alias("std"),
        F.count(value).cast("bigint").alias("n"),
    )


def region_change(by_region: DataFrame, spec: PanelSpec) -> DataFrame:
    """Change of the regional mean from first to last period, given two or more."""
    t, m = F.col(spec.time), F.col("mean")
    return (
        by_region.groupBy("region")
        .agg(
            F.count(F.lit(1)).alias("_periods"),
            F.min(t).cast("bigint").alias("first_period"),
            F.max(t).cast("bigint").alias("last_period"),
            (_first_by([-t], m) - _first_by([t], m)).alias("change"),
        )
        .where(F.col("_periods") >= 2)
        .drop("_periods")
    )


def period_buckets(
    df: DataFrame, spec: PanelSpec, value: str, start: int, width: int, tolerance: float = 0.0
) -> DataFrame:
    """Mean, spread and trend of the value per bucket of ``width`` periods.

    The trend compares with the bucket before; the few buckets fit one window.
    """
    bucket = F.floor((F.col(spec.time) - start) / width).cast("int")
    stats = df.groupBy(bucket.alias("bucket")).agg(
        F.min(spec.time).cast("bigint").alias("first_period"),
        F.max(spec.time).cast("bigint").alias("last_period"),
        F.avg(value).alias("mean"),
        F.stddev_samp(value).alias("std"),
    )
    change = F.col("mean") - F.lag("mean").over(Window.orderBy("bucket"))
    settled = F.when(F.abs(change) <= tolerance, F.lit(0.0)).otherwise(change)
    return stats.withColumn("trend", trend_label(settled))

