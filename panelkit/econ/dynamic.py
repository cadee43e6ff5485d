"""The dynamic panel model: the target explained by its own lag and the features."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelkit.econ.diagnostics import diagnostics, diagnostics_table
from panelkit.econ.within import PanelFit, fit_two_way
from panelkit.functions.scalars import half_life, persistence_label
from panelkit.operators.metrics import panel_metrics
from panelkit.operators.reshape import complete_cases
from panelkit.operators.temporal import add_lag, lag_name, split_at, split_period
from panelkit.spec import PanelSpec


def persistence(coefficients: DataFrame, term: str) -> DataFrame:
    """Persistence of shocks from the coefficient of the lagged target.

    The half-life is null unless 0 < rho < 1.
    """
    return coefficients.where(F.col("term") == term).select(
        F.col("coefficient").alias("rho"),
        "p_value",
        (F.col("p_value") < 0.05).alias("significant"),
        half_life("coefficient").alias("half_life"),
        persistence_label("coefficient").alias("interpretation"),
    )


@dataclass
class DynamicPanel:
    """Split, lag, fit, score and test a panel.

    The lag is taken on the full panel before splitting, so the first test
    period keeps its predecessor. ``lag_within_split`` takes it inside each
    part instead.
    """

    df: DataFrame
    spec: PanelSpec
    lag_within_split: bool = False
    train_end: int | None = None
    fit_: PanelFit | None = None
    lags: int = 1

    def load(self) -> "DynamicPanel":
        self.df = self.spec.validate(self.df)
        return self

    def split(
        self,
        train_end: int | None = None,
        test_periods: int | None = None,
        test_ratio: float = 0.2,
    ) -> "DynamicPanel":
        self.train_end = split_period(self.df, self.spec, train_end, test_periods, test_ratio)
        return self

    @property
    def lag_term(self) -> str:
        return lag_name(self.spec.target, self.lags)

    @property
    def terms(self) -> list[str]:
        return [*self.spec.features, self.lag_term]

    def lagged(self, part: str = "full") -> DataFrame:
        """The panel, its ``train`` or its ``test`` part, with the lagged target."""

        def lag(df: DataFrame) -> DataFrame:
            return add_lag(df, self.spec, self.spec.target, self.lags)

        if part == "full":
            return lag(self.df)
        if self.train_end is None:
            raise RuntimeError("split the panel first")
        which = 0 if part == "train" else 1
        if self.lag_within_split:
            return lag(split_at(self.df, self.spec, self.train_end)[which])
        return split_at(lag(self.df), self.spec, self.train_end)[which]

    def fit(self, lags: int = 1, use_train_only: bool = False, **options) -> "DynamicPanel":
        self.lags = lags
        data = self.lagged("train" if use_train_only else "full")
        self.fit_ = fit_two_way(data, self.spec, self.terms, **options)
        return self

    def _fitted(self) -> PanelFit:
        if self.fit_ is None:
            raise RuntimeError("the dynamic panel has not been fitted")
        return self.fit_

    def persistence(self) -> DataFrame:
        return persistence(self._fitted().coefficients(), self.lag_term)

    def predict_test(self, effects: str = "none") -> DataFrame:
        """Predictions on the test part: (model, entity, period, y_true, y_pred)."""
        fit = self._fitted()
        rows = complete_cases(
            self.lagged("test").select(*self.spec.keys, self.spec.target, *self.terms)
        )
        return fit.predict(rows, effects).select(
            F.lit("Dynamic Panel (FE)").alias("model"),
            *self.spec.keys,
            F.col(self.spec.target).alias("y_true"),
            "y_pred",
        )

    def evaluate_on_test(self, effects: str = "none") -> DataFrame:
        """(model, n_test, mse, rmse, mae, r2) on the test part."""
        return panel_metrics(self.predict_test(effects))

    def summary(self) -> DataFrame:
        return self._fitted().statistics()

    def diagnostics(self) -> dict[str, dict]:
        return diagnostics(self._fitted())

    def diagnostics_table(self) -> DataFrame:
        return diagnostics_table(self._fitted())
