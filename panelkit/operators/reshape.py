"""Shape raw indicator tables into one panel."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from panelkit.functions.scalars import to_number, to_period
from panelkit.spec import YEAR_MAX, YEAR_MIN, PanelSpec

# Column names that may hold the entity, and metadata columns.
ENTITY_NAMES = ("Country Name", "Country", "Country name", "country_name", "country")
METADATA_NAMES = ("Indicator Name", "Indicator Code")


def drop_empty_columns(df: DataFrame) -> DataFrame:
    """Drop columns that are null in every row; one aggregate over all columns."""
    if not df.columns:
        return df
    seen = df.agg(
        *[F.max(F.col(f"`{c}`").isNotNull()).alias(str(i)) for i, c in enumerate(df.columns)]
    ).first()
    kept = [c for i, c in enumerate(df.columns) if seen[i]]
    return df.select(*[F.col(f"`{c}`") for c in kept])


def resolve_entity(
    df: DataFrame, name: str = "entity", candidates: Sequence[str] = ENTITY_NAMES
) -> DataFrame:
    """Rename the entity column: the first known name, else the first column."""
    found = next((c for c in df.columns if c in candidates), df.columns[0])
    return df.withColumnRenamed(found, name)


def drop_metadata(df: DataFrame, names: Sequence[str] = METADATA_NAMES) -> DataFrame:
    return df.drop(*names)


def period_columns(df: DataFrame, exclude: Sequence[str] = ()) -> list[str]:
    """Columns whose name is a whole number between 1900 and 2100."""

    def is_period(name: str) -> bool:
        try:
            return YEAR_MIN <= int(name) <= YEAR_MAX
        except ValueError:
            return False

    return [c for c in df.columns if c not in exclude and is_period(c)]


def wide_to_long(
    df: DataFrame,
    ids: Sequence[str],
    periods: Sequence[str],
    value: str,
    time: str = "period",
) -> DataFrame:
    """One row per id and period column; empty cells stay as null rows."""
    numbers = df.select(
        *[F.col(f"`{c}`") for c in ids], *[to_number(f"`{c}`").alias(c) for c in periods]
    )
    long = numbers.unpivot(list(ids), [F.col(f"`{c}`") for c in periods], time, value)
    return long.withColumn(time, to_period(time)).where(F.col(time).isNotNull())


def coerce_numeric(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Cast the columns to double; what is not a number becomes null."""
    return df.withColumns({c: to_number(f"`{c}`") for c in columns})


def drop_null_rows(df: DataFrame, subset: Sequence[str]) -> DataFrame:
    return df.na.drop(subset=list(subset))


def complete_cases(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Rows without any null among ``columns`` (default: all columns)."""
    return df.na.drop("any", subset=list(columns) if columns else None)


def recode(df: DataFrame, column: str, mapping: Mapping[str, str]) -> DataFrame:
    """Replace whole values of a string column by a small literal mapping."""
    return df.replace(dict(mapping), subset=[column]) if mapping else df


def fold_outer_join(frames: Sequence[DataFrame], spec: PanelSpec) -> DataFrame:
    """Full outer join of indicators on (entity, period), in one shuffle.

    Each frame holds one row per key; a frame that repeats one raises when the
    result is read (``join_chain`` takes such frames). Stacking the frames and
    grouping by the key gives the rows of the chained outer joins, whatever
    their number, with a single exchange. The first frame that has a column
    provides it; the code column is no key and takes the first non-null value
    in the order of the frames.
    """
    keys = spec.keys
    code = [spec.code] if spec.code else []
    taken: set[str] = set()
    parts = []
    for i, f in enumerate(frames):
        own = [c for c in f.columns if c not in keys and c not in taken or c in code]
        taken.update(own)
        parts.append(f.select(*keys, *own, F.lit(i).alias("_frame")))
    stacked = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
    frame = F.col("_frame")
    columns = [c for c in stacked.columns if c not in keys and c != "_frame"]
    folded = stacked.groupBy(*keys).agg(
        *[
            F.min_by(c, F.when(F.col(c).isNotNull(), frame)).alias(c) if c in code else F.max(c).alias(c)
            for c in columns
        ],
        *[F.count_if(frame == i).alias(f"_rows_{i}") for i in range(len(parts))],
    )
    repeated = reduce(lambda a, b: a | b, [F.col(f"_rows_{i}") > 1 for i in range(len(parts))])
    message = F.concat(
        F.lit("a frame of the outer join repeats the key "),
        F.concat_ws(", ", *[F.col(k).cast("string") for k in keys]),
    )
    single = F.when(repeated, F.raise_error(message).cast("boolean")).otherwise(F.lit(True))
    return folded.where(single).select(*keys, *columns)


def join_chain(frames: Sequence[DataFrame], spec: PanelSpec) -> DataFrame:
    """The same as a chain of full outer joins, for inputs with repeated keys."""
    keys = spec.keys

    def step(a: DataFrame, b: DataFrame) -> DataFrame:
        clash = [c for c in b.columns if c in a.columns and c not in keys]
        if spec.code and spec.code in clash:
            b = b.withColumnRenamed(spec.code, "_code")
            clash.remove(spec.code)
            both = a.join(b.drop(*clash), keys, "full")
            merged = F.coalesce(F.col(spec.code), F.col("_code"))
            return both.withColumn(spec.code, merged).drop("_code")
        return a.join(b.drop(*clash), keys, "full")

    return reduce(step, frames)


def numeric_columns(df: DataFrame, exclude: Sequence[str] = ()) -> list[str]:
    return [
        f.name
        for f in df.schema.fields
        if isinstance(f.dataType, T.NumericType) and f.name not in exclude
    ]
