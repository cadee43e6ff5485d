"""Membership, coverage and missing-value checks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelkit.functions.scalars import ratio
from panelkit.operators.quantiles import column_quantiles
from panelkit.runtime import broadcast_if_small, stored
from panelkit.spec import PanelSpec

#: Highest share of empty feature cells an entity may have.
MAX_MISSING = 0.30


def whitelist_entities(df: DataFrame, spec: PanelSpec, allowed: DataFrame) -> DataFrame:
    """Rows of entities listed in ``allowed`` (a column named like the entity).

    A semi join: Spark broadcasts the list if it turns out small, and splits a
    skewed entity if it does not.
    """
    return df.join(allowed.select(spec.entity), spec.entity, "left_semi")


def removed_entities(df: DataFrame, spec: PanelSpec, allowed: DataFrame) -> DataFrame:
    """Distinct entities that are not listed in ``allowed``."""
    names = df.groupBy(spec.entity).agg(F.count(F.lit(1)).cast("bigint").alias("n_rows"))
    return names.join(allowed.select(spec.entity), spec.entity, "left_anti")


def missing_by_entity(
    df: DataFrame, spec: PanelSpec, count_time: bool = False
) -> DataFrame:
    """Share of empty feature cells per entity: (entity, n_rows, missing, share).

    ``count_time`` also counts the (never empty) period among the features.
    """
    nulls = sum((F.col(c).isNull().cast("bigint") for c in spec.features), F.lit(0))
    width = len(spec.features) + int(count_time)
    return df.groupBy(spec.entity).agg(
        F.count(F.lit(1)).cast("bigint").alias("n_rows"),
        F.sum(nulls).cast("bigint").alias("missing"),
    ).withColumn("share", F.coalesce(ratio("missing", F.col("n_rows") * width), F.lit(0.0)))


def coverage_filter(
    df: DataFrame, spec: PanelSpec, limit: float = MAX_MISSING, count_time: bool = False
) -> DataFrame:
    """Keep the entities whose share of empty feature cells is at most ``limit``.

    The list of kept entities is written first. If it is small it is broadcast
    and the rows are not shuffled; else Spark shuffles and splits hot entities.
    """
    share = missing_by_entity(df, spec, count_time)
    kept = stored(share.where(F.col("share") <= limit).select(spec.entity))
    return whitelist_entities(df, spec, broadcast_if_small(kept))


def null_report(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Empty cells per column: (column, nulls). One pass, one output row per column."""
    counts = df.agg(
        *[F.sum(F.col(c).isNull().cast("bigint")).alias(c) for c in columns]
    )
    return counts.unpivot([], list(columns), "column", "nulls").select(
        "column", F.coalesce("nulls", F.lit(0)).cast("bigint").alias("nulls")
    )


def iqr_filter(df: DataFrame, columns: Sequence[str], factor: float = 1.5) -> DataFrame:
    """Drop rows with a value beyond ``factor`` interquartile ranges of the quartiles."""
    keep = F.lit(True)
    for c, q in column_quantiles(df, columns, [0.25, 0.75]).items():
        reach = factor * (q[0.75] - q[0.25])
        inside = F.col(c).between(q[0.25] - reach, q[0.75] + reach)
        keep = keep & (F.col(c).isNull() | inside)
    return df.where(keep)
