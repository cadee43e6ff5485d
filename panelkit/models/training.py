"""Train one or all regressors on a split panel and collect scores and predictions."""

from __future__ import annotations

import logging
import time
from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelkit.models.regressors import NAMES, Fitted, load_regressor
from panelkit.models.search import GRIDS, SPACES, SearchResult, grid_search, random_search
from panelkit.operators.metrics import OVERFIT_GAP, regression_metrics, with_overfitting
from panelkit.operators.reshape import complete_cases
from panelkit.runtime import stored
from panelkit.spec import PanelSpec

log = logging.getLogger(__name__)


class PanelRegressor:
    """One regressor with tuning: fit, predict, evaluate, save and load."""

    def __init__(self, kind: str, spec: PanelSpec):
        if kind not in NAMES:
            raise ValueError(f"unknown regressor: {kind}")
        self.kind, self.spec = kind, spec
        self.search: SearchResult | None = None
        self.model: Fitted | None = None

    @property
    def name(self) -> str:
        return NAMES[self.kind]

    def fit(
        self,
        train: DataFrame,
        param_grid: Mapping[str, Sequence] | None = None,
        cv: int = 5,
        parallelism: int = 4,
    ) -> "PanelRegressor":
        """Grid search with ``cv`` folds, then a refit of the best candidate."""
        self.search = grid_search(
            self.kind, train, self.spec, param_grid or GRIDS[self.kind], k=cv,
            parallelism=parallelism,
        )
        return self._keep()

    def _keep(self) -> "PanelRegressor":
        found = self.search
        self.model = found.model
        log.info(
            "%s: train R2 %.4f, validation R2 %.4f with %s",
            self.name, found.train_score, found.cv_score, found.best_params,
        )
        if found.train_score - found.cv_score > OVERFIT_GAP:
            log.warning("%s: potential overfitting", self.name)
        return self

    def fit_random(
        self, train: DataFrame, n_trials: int = 100, cv: int = 5, seed: int = 42,
        space: Mapping | None = None, parallelism: int = 4,
    ) -> "PanelRegressor":
        """Random search over the regressor's space, then a refit."""
        self.search = random_search(
            self.kind, train, self.spec, n_trials, space or SPACES[self.kind], seed, k=cv,
            parallelism=parallelism,
        )
        return self._keep()

    def _fitted(self) -> Fitted:
        if self.model is None:
            raise ValueError(f"{self.name} has neither been fitted nor loaded")
        return self.model

    def _searched(self) -> SearchResult:
        if self.search is None:
            raise ValueError(f"{self.name} has not been searched")
        return self.search

    @property
    def best_params(self) -> dict:
        return self._searched().best_params

    def predict(self, df: DataFrame) -> DataFrame:
        return self._fitted().predict(df)

    def predictions(self, test: DataFrame, incomplete: str = "raise") -> DataFrame:
        """(model, entity, period, y_true, y_pred) of the test rows.

        A row without its target or a feature raises when the result is read; with
        ``incomplete="drop"`` such rows are left out.
        """
        needed = [self.spec.target, *self.spec.features]
        rows = test.select(*self.spec.keys, *needed)
        if incomplete == "drop":
            rows = complete_cases(rows, needed)
        else:
            gap = F.raise_error(F.lit(f"a test row lacks one of {needed}: impute it, or drop incomplete rows"))
            whole = reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in needed])
            rows = rows.where(F.when(whole, True).otherwise(gap.cast("boolean")))
        return self.predict(rows).select(
            F.lit(self.name).alias("model"), *self.spec.keys,
            F.col(self.spec.target).alias("y_true"), "y_pred",
        )

    def evaluate(self, test: DataFrame) -> DataFrame:
        """The metrics row, with the overfitting figures if there was a search."""
        return self.score(self.predictions(test))

    def score(self, predictions: DataFrame) -> DataFrame:
        """As ``evaluate``, for predictions that are already there."""
        scores = regression_metrics(predictions, len(self.spec.features))
        train = cv = F.lit(None).cast("double")
        if self.search is not None:
            train, cv = F.lit(self.search.train_score), F.lit(self.search.cv_score)
        return with_overfitting(
            scores.withColumn("train_score", train).withColumn("cv_score", cv)
        )

    def feature_importance(self, spark: SparkSession) -> DataFrame:
        return self._fitted().importances(spark)

    def coefficients(self, spark: SparkSession) -> DataFrame:
        return self._fitted().coefficients(spark)

    def cv_results(self) -> DataFrame:
        return self._searched().table()

    def save_model(self, spark: SparkSession, path: str) -> None:
        self._fitted().save(spark, path)

    def load_model(self, spark: SparkSession, path: str) -> "PanelRegressor":
        self.model = load_regressor(spark, path)
        return self


@dataclass
class TrainingRun:
    """What training several models gives."""

    metrics: DataFrame
    predictions: DataFrame
    models: dict[str, PanelRegressor]
    failures: dict[str, str]


def train_all(
    train: DataFrame,
    test: DataFrame,
    spec: PanelSpec,
    kinds: Sequence[str] = tuple(NAMES),
    grids: Mapping[str, Mapping] | None = None,
    cv: int = 5,
    parallelism: int = 4,
) -> TrainingRun:
    """Tune, score and collect the regressors; one that fails is reported and skipped."""
    metrics, predictions, models, failures = [], [], {}, {}
    for kind in kinds:
        started = time.monotonic()
        try:
            model = PanelRegressor(kind, spec).fit(
                train, (grids or GRIDS)[kind], cv=cv, parallelism=parallelism
            )
        except Exception as problem:  # noqa: BLE001 - the other models still train
            log.warning("%s failed: %s", kind, problem)
            failures[kind] = str(problem)
            continue
        seconds = time.monotonic() - started
        predicted = stored(model.predictions(test))
        metrics.append(model.score(predicted).withColumn("time", F.lit(seconds)))
        predictions.append(predicted)
        models[kind] = model
    if not models:
        raise RuntimeError(f"no model could be trained: {failures}")

    def union(frames: list[DataFrame]) -> DataFrame:
        return reduce(lambda a, b: a.unionByName(b), frames)

    return TrainingRun(union(metrics), union(predictions), models, failures)
