"""Fill gaps per entity by progressive time-window medians."""

from __future__ import annotations

from bisect import bisect_left, bisect_right
from collections.abc import Iterator, Mapping, Sequence
from statistics import median

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from panelkit.functions.scalars import median_of
from panelkit.operators.ordered import CHUNK, add_last_observed, add_neighbours
from panelkit.operators.quantiles import column_quantiles
from panelkit.spec import PanelSpec

#: Half-widths of the windows, tried in this order.
RADII = (1, 2, 4)
#: Observed values a window needs before its median counts.
MIN_VALUES = 2


def global_medians(df: DataFrame, columns: Sequence[str]) -> dict[str, float]:
    """Exact median of the observed values of each column; one scalar per column."""
    return {c: q[0.5] for c, q in column_quantiles(df, columns, [0.5]).items()}


def _window_median(near: Mapping[int, str], time: Column, column: str, radius: int) -> Column:
    """Median of the observed values within ``radius`` periods, if there are enough."""
    values = [
        F.when(F.abs(F.col(f"{name}.at") - time) <= radius, F.col(f"{name}.{column}"))
        for offset, name in near.items()
        if abs(offset) <= radius
    ]
    return median_of(values, MIN_VALUES)


def impute_window_median(
    df: DataFrame,
    spec: PanelSpec,
    columns: Sequence[str] | None = None,
    radii: Sequence[int] = RADII,
    fit_on: DataFrame | None = None,
    stages: bool = False,
    chunk: int = CHUNK,
) -> DataFrame:
    """Fill nulls with the median of observed values in ever wider windows.

    What no window can fill gets the column's median over ``fit_on`` (default:
    all rows). Only observed values count, so the result does not depend on the
    order of the fills. With ``stages`` a column ``<name>_stage`` tells how each
    cell came about: 0 observed, 1..n the window, n+1 the overall median.
    """
    columns = list(columns or spec.features)
    medians = global_medians(fit_on if fit_on is not None else df, columns)
    around, near = add_neighbours(df, spec, columns, max(radii), chunk)
    time = F.col(spec.time)
    fills, marks = {}, {}
    for c in columns:
        tries = [_window_median(near, time, c, r) for r in radii]
        overall = F.lit(medians.get(c)).cast("double")
        fills[c] = F.when(F.col(c).isNotNull(), F.col(c)).otherwise(
            F.coalesce(*tries, overall)
        )
        mark = F.when(F.col(c).isNotNull(), 0)
        for stage, attempt in enumerate(tries, start=1):
            mark = mark.when(attempt.isNotNull(), stage)
        marks[f"{c}_stage"] = mark.when(overall.isNotNull(), len(radii) + 1)
    kept = [F.col(c) if c not in fills else fills[c].alias(c) for c in df.columns]
    if stages:
        kept += [m.cast("int").alias(name) for name, m in marks.items()]
    return around.select(*kept)


def impute_report(staged: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Cells per column and fill stage, from the stage columns of the imputation."""
    long = staged.select(*[F.col(f"{c}_stage").alias(c) for c in columns]).unpivot(
        [], list(columns), "column", "stage"
    )
    return long.groupBy("column", "stage").agg(F.count(F.lit(1)).alias("cells"))


def fill_series(
    periods: Sequence[int],
    values: Sequence[float | None],
    radii: Sequence[int],
    overall: float | None,
) -> list[float | None]:
    """Fill one entity's ordered series; earlier fills feed the later windows."""
    out = list(values)
    for i, value in enumerate(values):
        if value is not None:
            continue
        for r in radii:
            window = out[bisect_left(periods, periods[i] - r) : bisect_right(periods, periods[i] + r)]
            seen = [v for v in window if v is not None]
            if len(seen) >= MIN_VALUES:
                out[i] = median(seen)
                break
        else:
            out[i] = overall
    return out


def impute_sequential(
    df: DataFrame,
    spec: PanelSpec,
    columns: Sequence[str] | None = None,
    radii: Sequence[int] = RADII,
) -> DataFrame:
    """As ``impute_window_median``, but fills of earlier periods feed later windows.

    A fill can depend on all earlier ones of its entity, so an entity is handled
    as a whole. That needs declared ``period_bounds``, which bound its rows; a
    row outside them raises. Tasks stream over entities in order and hold one
    batch at a time.
    """
    if spec.period_bounds is None:
        raise ValueError("sequential imputation needs a PanelSpec with period_bounds")
    columns = list(columns or spec.features)
    medians = global_medians(df, columns)
    entity, time = spec.entity, spec.time

    def fill(pdf: pd.DataFrame) -> pd.DataFrame:
        names = pdf[entity].to_numpy()
        starts = [0, *(np.flatnonzero(names[1:] != names[:-1]) + 1).tolist(), len(names)]
        periods = pdf[time].tolist()
        filled = {}
        for c in columns:
            values = [None if v != v else v for v in pdf[c].astype("float64").tolist()]
            done: list[float | None] = []
            for lo, hi in zip(starts, starts[1:]):
                done += fill_series(periods[lo:hi], values[lo:hi], radii, medians.get(c))
            filled[c] = pd.Series(done, index=pdf.index, dtype="float64")
        return pdf.assign(**filled)

    def whole_entities(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        """Cut the ordered stream between entities, never inside one."""
        rest = None
        for batch in batches:
            if batch.empty:
                continue
            rest = batch if rest is None else pd.concat([rest, batch], ignore_index=True)
            same = (rest[entity] == rest[entity].iloc[-1]).to_numpy()
            cut = int(same.argmax())  # rows of the last entity may continue
            if cut:
                yield fill(rest.iloc[:cut])
                rest = rest.iloc[cut:]
        if rest is not None:
            yield fill(rest)

    schema = T.StructType(
        [
            T.StructField(f.name, T.DoubleType()) if f.name in columns else f
            for f in df.schema.fields
        ]
    )
    outside = F.raise_error(F.lit(f"a row lies outside the period bounds {spec.period_bounds}"))
    inside = F.when(spec.within_bounds(), True).otherwise(outside.cast("boolean"))
    ordered = df.where(inside).repartition(entity).sortWithinPartitions(entity, time)
    return ordered.mapInPandas(whole_entities, schema)


def forward_fill(
    df: DataFrame, spec: PanelSpec, columns: Sequence[str] | None = None, chunk: int = CHUNK
) -> DataFrame:
    """Carry the latest observed value of each entity forward."""
    columns = list(columns or spec.features)
    filled = add_last_observed(df, spec, {f"_f_{c}": c for c in columns}, chunk)
    return filled.select(
        *[F.col(f"_f_{c}").alias(c) if c in columns else F.col(c) for c in df.columns]
    )
