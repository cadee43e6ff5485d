"""Column roles of a panel, and checks that a DataFrame fulfils them."""

from __future__ import annotations

from dataclasses import dataclass, field, replace

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Calendar years accepted as a period column or value.
YEAR_MIN, YEAR_MAX = 1900, 2100


@dataclass(frozen=True)
class PanelSpec:
    """Names the key, target and feature columns of an (entity, period) panel.

    ``period_bounds`` states the closed range every period lies in. As
    (entity, period) is a key, it also bounds the rows of one entity, which lets
    per-entity windows run on one task each. Without bounds the ordered
    operators split each entity into chunks of periods instead.
    """

    entity: str = "entity"
    time: str = "period"
    target: str | None = None
    features: tuple[str, ...] = field(default_factory=tuple)
    code: str | None = None
    period_bounds: tuple[int, int] | None = None

    @property
    def keys(self) -> list[str]:
        return [self.entity, self.time]

    @property
    def columns(self) -> list[str]:
        extra = [self.code] if self.code else []
        target = [self.target] if self.target else []
        return [self.entity, *extra, self.time, *target, *self.features]

    def with_features(self, *features: str) -> "PanelSpec":
        return replace(self, features=tuple(features))

    def infer_features(self, df: DataFrame) -> "PanelSpec":
        """Take every numeric column that is neither key nor target as a feature."""
        taken = {self.entity, self.time, self.target, self.code}
        names = [
            f.name
            for f in df.schema.fields
            if isinstance(f.dataType, T.NumericType) and f.name not in taken
        ]
        return self.with_features(*names)

    def window(self) -> Window:
        return Window.partitionBy(self.entity).orderBy(self.time)

    def within_bounds(self) -> Column:
        """True where the period lies in the declared range."""
        if self.period_bounds is None:
            return F.col(self.time).isNotNull()
        return F.col(self.time).between(*self.period_bounds)

    def checked_time(self) -> Column:
        """The period: one outside the declared range raises, a missing one stays null."""
        time = F.col(self.time)
        if self.period_bounds is None:
            return time
        message = F.concat(F.lit(f"{self.time} outside {self.period_bounds}: "), time.cast("string"))
        return F.when(time.isNull() | self.within_bounds(), time).otherwise(F.raise_error(message).cast("int"))

    def require_columns(self, df: DataFrame) -> None:
        missing = [c for c in self.columns if c not in df.columns]
        if missing:
            raise ValueError(f"the table lacks {missing}")

    def validate(self, df: DataFrame) -> DataFrame:
        """Check columns, that there are rows, period bounds, and that the key is unique."""
        self.require_columns(df)
        if df.isEmpty():
            raise ValueError("the panel is empty")
        if not df.where(~F.coalesce(self.within_bounds(), F.lit(False))).isEmpty():
            raise ValueError(f"periods must be present and lie in {self.period_bounds}")
        clash = duplicate_keys(df, self).limit(1).collect()
        if clash:
            raise ValueError(f"duplicate panel key: {clash[0].asDict()}")
        return df


def duplicate_keys(df: DataFrame, spec: PanelSpec) -> DataFrame:
    """Keys that occur more than once, with their row count."""
    counts = df.groupBy(*spec.keys).agg(F.count(F.lit(1)).alias("rows"))
    return counts.where(F.col("rows") > 1)


def panel_profile(df: DataFrame, spec: PanelSpec) -> DataFrame:
    """One row: rows, distinct entities and periods, first and last period.

    Distinct counts go through ``groupBy`` on the value, so no single task ever
    holds the set of entities.
    """
    entities = df.groupBy(spec.entity).agg(
        F.count(F.lit(1)).alias("n"),
        F.min(spec.time).alias("lo"),
        F.max(spec.time).alias("hi"),
    )
    periods = df.groupBy(spec.time).agg(F.lit(1).alias("one"))
    n_periods = periods.agg(F.count(F.col(spec.time)).alias("n")).scalar()
    return entities.agg(
        F.coalesce(F.sum("n"), F.lit(0)).cast("bigint").alias("n_rows"),
        F.count(F.col(spec.entity)).cast("bigint").alias("n_entities"),
        n_periods.cast("bigint").alias("n_periods"),
        F.min("lo").cast("bigint").alias("first_period"),
        F.max("hi").cast("bigint").alias("last_period"),
    )
