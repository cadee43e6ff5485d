"""Splits by period, slices, lags and changes over time."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelkit.functions.scalars import trend_label
from panelkit.operators.ordered import CHUNK, add_previous
from panelkit.spec import PanelSpec


def last_train_period(
    first: int,
    last: int,
    train_end: int | None = None,
    test_periods: int | None = None,
    test_ratio: float = 0.2,
) -> int:
    """Last period of the train part.

    An explicit end wins over a number of test periods, which wins over a ratio
    of the spanned periods.
    """
    if train_end is not None:
        return train_end
    if test_periods is None:
        test_periods = int((last - first + 1) * test_ratio)
    return last - test_periods


def split_at(df: DataFrame, spec: PanelSpec, train_end: int) -> tuple[DataFrame, DataFrame]:
    """Rows up to and including ``train_end``, and rows after it."""
    time = F.col(spec.time)
    return df.where(time <= train_end), df.where(time > train_end)


def split_period(
    df: DataFrame,
    spec: PanelSpec,
    train_end: int | None = None,
    test_periods: int | None = None,
    test_ratio: float = 0.2,
) -> int:
    """The last train period of ``df`` under the rule of ``last_train_period``."""
    if train_end is not None:
        return train_end
    lo, hi = df.agg(F.min(spec.time), F.max(spec.time)).first()
    if lo is None:
        raise ValueError("the panel is empty")
    return last_train_period(lo, hi, None, test_periods, test_ratio)


def temporal_split(
    df: DataFrame,
    spec: PanelSpec,
    train_end: int | None = None,
    test_periods: int | None = None,
    test_ratio: float = 0.2,
) -> tuple[DataFrame, DataFrame]:
    """Split by an end period, a number of last periods or a ratio."""
    return split_at(df, spec, split_period(df, spec, train_end, test_periods, test_ratio))


def tag_split(df: DataFrame, spec: PanelSpec, train_end: int) -> DataFrame:
    """The panel with a ``split`` column holding ``train`` or ``test``."""
    label = F.when(F.col(spec.time) <= train_end, "train").otherwise("test")
    return df.withColumn("split", label)


def recombine(train: DataFrame, test: DataFrame) -> DataFrame:
    """All rows of both parts."""
    return train.unionByName(test)


def at_period(df: DataFrame, spec: PanelSpec, period: int) -> DataFrame:
    return df.where(F.col(spec.time) == period)


def of_entity(df: DataFrame, spec: PanelSpec, entity) -> DataFrame:
    return df.where(F.col(spec.entity) == entity)


def latest_slice(df: DataFrame, spec: PanelSpec) -> DataFrame:
    """Rows of the last period that occurs."""
    newest = df.agg(F.max(spec.time).alias("newest")).scalar()
    return df.where(F.col(spec.time) == newest)


def recent_first(df: DataFrame, spec: PanelSpec, columns: Sequence[str]) -> DataFrame:
    """The wanted columns that exist, latest period first."""
    present = [c for c in columns if c in df.columns]
    return df.orderBy(F.col(spec.time).desc()).select(*present)


def entities(df: DataFrame, spec: PanelSpec) -> DataFrame:
    """Distinct entities in order."""
    return df.select(spec.entity).distinct().orderBy(spec.entity)


def periods(df: DataFrame, spec: PanelSpec) -> DataFrame:
    """Distinct periods in order."""
    return df.select(spec.time).distinct().orderBy(spec.time)


def lag_name(variable: str, lags: int) -> str:
    return f"{variable}_lag{lags}"


def add_lag(
    df: DataFrame,
    spec: PanelSpec,
    variable: str,
    lags: int = 1,
    gap_aware: bool = False,
    chunk: int = CHUNK,
) -> DataFrame:
    """Add ``<variable>_lag<n>``: the value ``lags`` rows earlier in the entity.

    With ``gap_aware`` the lag is null unless exactly ``lags`` periods separate
    the two rows.
    """
    name = lag_name(variable, lags)
    if not gap_aware:
        return add_previous(df, spec, {name: variable}, lags, chunk)
    both = add_previous(df, spec, {name: variable, "_then": spec.time}, lags, chunk)
    adjacent = F.col(spec.time) - F.col("_then") == lags
    return both.withColumn(name, F.when(adjacent, F.col(name))).drop("_then")


def latest_delta(
    df: DataFrame, spec: PanelSpec, value: str, chunk: int = CHUNK
) -> DataFrame:
    """Per entity: latest period, latest and previous value, change and trend."""
    with_before = add_previous(
        df.select(*spec.keys, value), spec, {"_before": value, "_then": spec.time}, 1, chunk
    )
    # a single row has no predecessor and compares with itself
    previous = F.when(F.col("_then").isNull(), F.col(value)).otherwise(F.col("_before"))
    newest = with_before.groupBy(spec.entity).agg(
        F.max(spec.time).alias("latest_period"),
        F.max_by(value, spec.time).alias("latest"),
        F.max_by(previous, F.col(spec.time)).alias("previous"),
    )
    delta = F.col("latest") - F.col("previous")
    return newest.withColumn("delta", delta).withColumn("trend", trend_label("delta"))
