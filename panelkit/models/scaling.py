"""z-scores with the population standard deviation."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class ZScores:
    """Mean and population standard deviation per feature, taken from one frame."""

    features: tuple[str, ...]
    means: tuple[float, ...]
    stds: tuple[float, ...]

    @classmethod
    def of(cls, df: DataFrame, features: Sequence[str]) -> "ZScores":
        """One aggregate; a feature without variance keeps scale 1."""
        row = df.agg(
            *[F.avg(c).alias(f"m{i}") for i, c in enumerate(features)],
            *[F.stddev_pop(c).alias(f"s{i}") for i, c in enumerate(features)],
        ).first()
        k = range(len(features))
        return cls(
            tuple(features),
            tuple(float(row[f"m{i}"] or 0.0) for i in k),
            tuple(float(row[f"s{i}"] or 0.0) or 1.0 for i in k),
        )

    def column(self, feature: str) -> Column:
        i = self.features.index(feature)
        return (F.col(feature) - F.lit(self.means[i])) / F.lit(self.stds[i])

    def columns(self, prefix: str = "_z_") -> list[Column]:
        return [self.column(c).alias(f"{prefix}{c}") for c in self.features]

    def apply(self, df: DataFrame) -> DataFrame:
        """Replace the features by their z-scores."""
        return df.withColumns({c: self.column(c) for c in self.features})
