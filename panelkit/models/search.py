"""Grid and random search with k-fold validation, keeping train scores too."""

from __future__ import annotations

import itertools
import json
import math
import random
from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import partial

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelkit.models import linear, local
from panelkit.models.folds import contiguous_folds, shuffled_folds
from panelkit.models.regressors import Fitted, fit_regressor, metric_of
from panelkit.operators.metrics import r_squared
from panelkit.operators.reshape import complete_cases
from panelkit.runtime import cached, run_jobs
from panelkit.spec import PanelSpec

# The full default grid of each regressor.
GRIDS: dict[str, dict[str, list]] = {
    "random_forest": {
        "n_estimators": [100, 200, 300],
        "max_depth": [10, 15, 20, None],
        "min_samples_split": [2, 5, 10],
        "min_samples_leaf": [1, 2, 4],
        "max_features": ["sqrt", "log2"],
    },
    "xgboost": {
        "n_estimators": [100, 200],
        "max_depth": [3, 5, 7],
        "learning_rate": [0.03, 0.1],
        "subsample": [0.8, 1.0],
        "colsample_bytree": [0.8, 1.0],
        "reg_alpha": [0, 0.1],
        "reg_lambda": [1, 2],
    },
    "gradient_boosting": {
        "n_estimators": [200, 300, 400],
        "learning_rate": [0.01, 0.03, 0.05],
        "max_depth": [3, 4, 5],
        "subsample": [0.8, 0.9, 1.0],
        "min_samples_split": [2, 5],
        "min_samples_leaf": [1, 2],
    },
    "elastic_net": {
        "alpha": [0.001, 0.01, 0.1, 0.5, 1.0],
        "l1_ratio": [0.1, 0.3, 0.5, 0.7, 0.9],
    },
    "svr": {
        "C": [0.1, 1, 10, 100],
        "epsilon": [0.01, 0.1, 0.2],
        "kernel": ["rbf", "linear"],
        "gamma": ["scale", "auto"],
    },
    "knn": {
        "n_neighbors": [3, 5, 7, 10, 15],
        "weights": ["uniform", "distance"],
        "metric": ["euclidean", "manhattan"],
    },
    "mlp": {
        "hidden_layer_sizes": [(50,), (100,), (100, 50), (100, 100)],
        "activation": ["relu", "tanh"],
        "alpha": [0.0001, 0.001, 0.01],
        "learning_rate_init": [0.001, 0.01],
        "max_iter": [500],
    },
}

#: One or two candidates each, for a first look and for tests.
QUICK_GRIDS: dict[str, dict[str, list]] = {
    "random_forest": {"n_estimators": [20], "max_depth": [5, 8], "max_features": ["sqrt"]},
    "xgboost": {"n_estimators": [20], "max_depth": [3], "learning_rate": [0.1, 0.3]},
    "gradient_boosting": {"n_estimators": [20], "max_depth": [3], "learning_rate": [0.2]},
    "elastic_net": {"alpha": [0.001, 0.1], "l1_ratio": [0.5]},
    "svr": {"C": [1], "epsilon": [0.1], "kernel": ["rbf"]},
    "knn": {"n_neighbors": [5, 10], "weights": ["uniform", "distance"], "metric": ["euclidean"]},
    "mlp": {"hidden_layer_sizes": [(50,)], "alpha": [0.0001], "learning_rate_init": [0.01],
            "max_iter": [50]},
}

# Search spaces as (rule, low, high) or a list of choices.
SPACES: dict[str, dict[str, object]] = {
    "xgboost": {
        "n_estimators": ("int", 50, 500),
        "max_depth": ("int", 3, 10),
        "learning_rate": ("log", 0.001, 0.3),
        "subsample": ("real", 0.6, 1.0),
        "colsample_bytree": ("real", 0.6, 1.0),
        "gamma": ("real", 0, 5),
        "min_child_weight": ("int", 1, 10),
        "reg_alpha": ("log", 1e-8, 10.0),
        "reg_lambda": ("log", 1e-8, 10.0),
    },
    "mlp": {
        "hidden_layer_sizes": [(50,), (100,), (100, 50), (100, 100), (150,), (150, 100), (200,)],
        "activation": ["relu", "tanh"],
        "alpha": ("log", 1e-5, 1e-1),
        "learning_rate_init": ("log", 1e-4, 1e-1),
        "batch_size": [32, 64, 128, 256],
    },
    "random_forest": {
        "n_estimators": ("int", 100, 500),
        "max_depth": ("int", 5, 30),
        "min_samples_split": ("int", 2, 20),
        "min_samples_leaf": ("int", 1, 10),
        "max_features": ["sqrt", "log2", None],
        "min_impurity_decrease": ("real", 0.0, 0.1),
    },
    "gradient_boosting": {
        "n_estimators": ("int", 100, 500),
        "max_depth": ("int", 3, 10),
        "learning_rate": ("log", 0.001, 0.3),
        "subsample": ("real", 0.6, 1.0),
        "min_samples_split": ("int", 2, 20),
        "min_samples_leaf": ("int", 1, 10),
        "max_features": ["sqrt", "log2", None],
    },
    "knn": {
        "n_neighbors": ("int", 3, 20),
        "weights": ["uniform", "distance"],
        "p": ("int", 1, 2),
    },
    "elastic_net": {
        "alpha": ("log", 1e-4, 10.0),
        "l1_ratio": ("real", 0.0, 1.0),
        "max_iter": ("int", 1000, 5000),
    },
    "svr": {
        "C": ("log", 0.01, 100.0),
        "epsilon": ("log", 0.001, 1.0),
        "kernel": ["rbf", "linear", "poly"],
        "gamma": ["scale", "auto"],
    },
}


def expand_grid(grid: Mapping[str, Sequence]) -> list[dict]:
    """All combinations of a grid."""
    return [dict(zip(grid, values)) for values in itertools.product(*grid.values())]


def draw(space: Mapping[str, object], n: int, seed: int = 42) -> list[dict]:
    """``n`` seeded random candidates; gamma only for the kernels that use it."""
    rng = random.Random(seed)

    def one(rule):
        if isinstance(rule, list):
            return rng.choice(rule)
        kind, low, high = rule
        if kind == "int":
            return rng.randint(low, high)
        if kind == "log":
            return math.exp(rng.uniform(math.log(low), math.log(high)))
        return rng.uniform(low, high)

    out = []
    for _ in range(n):
        candidate = {name: one(rule) for name, rule in space.items()}
        if candidate.get("kernel") == "linear":
            candidate.pop("gamma", None)
        out.append(candidate)
    return out


@dataclass
class SearchResult:
    """Fold scores of all candidates, the best one, and its refit on all rows."""

    kind: str
    candidates: list[dict]
    scores: list[tuple[int, int, float, float]]  # candidate, fold, train, validation
    best: int
    model: Fitted | None
    frame: DataFrame

    def _mean(self, candidate: int, column: int) -> float:
        return float(np.mean([s[column] for s in self.scores if s[0] == candidate]))

    @property
    def best_params(self) -> dict:
        return self.candidates[self.best]

    @property
    def train_score(self) -> float:
        return self._mean(self.best, 2)

    @property
    def cv_score(self) -> float:
        return self._mean(self.best, 3)

    def fold_table(self) -> DataFrame:
        """(model, candidate, params, fold, train_score, cv_score)."""
        rows = [
            (self.kind, c, json.dumps(self.candidates[c], sort_keys=True), f, t, v)
            for c, f, t, v in self.scores
        ]
        return self.frame.sparkSession.createDataFrame(
            rows,
            "model string, candidate bigint, params string, fold bigint, "
            "train_score double, cv_score double",
        )

    def table(self) -> DataFrame:
        """Mean and std (ddof 0) over the folds per candidate, best first."""
        return (
            self.fold_table()
            .groupBy("model", "candidate", "params")
            .agg(
                F.avg("train_score").alias("train_score"),
                F.avg("cv_score").alias("cv_score"),
                F.stddev_pop("cv_score").alias("cv_std"),
            )
            .orderBy(F.col("cv_score").desc(), "candidate")
        )


def _candidate_scores(
    kind: str, data: DataFrame, spec: PanelSpec, params: dict, alike: list[int], fold: int
) -> list[tuple[int, int, float, float]]:
    """R2 on the training rows and on the held-out rows, from one scoring pass, for all candidates alike."""
    fitted = fit_regressor(kind, data.where(F.col("fold") != fold), spec, params)
    sides = (
        fitted.predict(data)
        .select((F.col("fold") == fold).alias("held"), F.col(spec.target).alias("y_true"), "y_pred")
        .groupBy("held")
        .agg(r_squared().alias("r2"))
        .collect()
    )
    by_side = {r["held"]: r["r2"] for r in sides}
    return [(c, fold, by_side.get(False), by_side.get(True)) for c in alike]


def _knn_scores(
    data: DataFrame, spec: PanelSpec, candidates: list[dict], metric: str, fold: int
) -> list[tuple[int, int, float, float]]:
    """All candidates of one metric share the neighbours of the largest k."""
    mine = [i for i, c in enumerate(candidates) if metric_of(c) == metric]
    most = max(int(candidates[i].get("n_neighbors", 5)) for i in mine)
    fitted = fit_regressor(
        "knn", data.where(F.col("fold") != fold), spec, {"n_neighbors": most, "metric": metric}
    )
    near = fitted.neighbour_table(data)
    averages = []
    for i in mine:
        within = F.col("rank") <= int(candidates[i].get("n_neighbors", 5))
        chosen = F.when(within, F.col("y"))
        gap = F.when(within, F.col("distance"))
        plain = F.avg(chosen)
        if candidates[i].get("weights", "uniform") == "distance":
            exact = F.avg(F.when(gap == 0, chosen))
            weight = F.try_divide(F.lit(1.0), gap)
            plain = F.coalesce(exact, F.try_divide(F.sum(chosen * weight), F.sum(weight)))
        averages.append(plain.alias(f"p{i}"))
    means = near.groupBy(*[F.col(f"q_{c}").alias(c) for c in spec.keys]).agg(*averages)
    truth = data.select(*spec.keys, F.col(spec.target).alias("y_true"), "fold")
    sides = (
        truth.join(means, spec.keys)
        .groupBy((F.col("fold") == fold).alias("held"))
        .agg(*[r_squared("y_true", f"p{i}").alias(f"r{i}") for i in mine])
        .collect()
    )
    by_side = {r["held"]: r for r in sides}
    return [(i, fold, by_side[False][f"r{i}"], by_side[True][f"r{i}"]) for i in mine]


def _linear_search(
    train: DataFrame, complete: DataFrame, spec: PanelSpec, candidates: list[dict], refit: bool
) -> SearchResult:
    """All candidates and folds from one scan of the rows, and the refit as well."""
    columns = [*spec.features, spec.target]
    parts = linear.moments_by(complete, columns, F.col("fold"))
    result = SearchResult("elastic_net", candidates, linear.fold_scores(spec.features, parts, candidates), 0, None, train)
    result.best = max(range(len(candidates)), key=lambda c: (result._mean(c, 3), -c))
    if refit:
        line = linear.fit_paths(spec.features, linear.total(parts.values(), len(columns)), [result.best_params])[0]
        result.model = Fitted(
            "elastic_net", tuple(spec.features), spec.target, tuple(spec.keys), dict(result.best_params),
            scores=line.scores, line=line,
        )
    return result


def cross_validate(
    kind: str,
    train: DataFrame,
    spec: PanelSpec,
    candidates: Sequence[dict],
    k: int = 5,
    parallelism: int = 4,
    refit: bool = True,
) -> SearchResult:
    """Score every candidate on every fold; refit the best on all rows.

    ``train`` may bring a ``fold`` column; without one it gets contiguous folds
    in key order. The elastic net takes one scan for all candidates and folds. Trees and networks are
    fitted inside tasks if the rows fit there (``local``). Other fits are Spark jobs, one for candidates
    that are alike; ``parallelism`` of them are in flight so that the tail of one overlaps with the next.
    """
    if not candidates:
        raise ValueError("no candidates to try")
    candidates = list(candidates)
    rows = train if "fold" in train.columns else contiguous_folds(train, spec, k)
    complete = complete_cases(rows.select(*spec.keys, spec.target, *spec.features, "fold"))
    if kind == "elastic_net":
        return _linear_search(train, complete, spec, candidates, refit)
    with cached(complete) as data:
        folds = sorted(r["fold"] for r in data.select("fold").distinct().collect())
        if kind == "knn":
            metrics = sorted({metric_of(c) for c in candidates})
            tasks = [
                partial(_knn_scores, data, spec, candidates, m, f) for m in metrics for f in folds
            ]
        elif local.fits(data, spec):
            tasks = [partial(local.scores, kind, data, spec, candidates)]
        else:
            same = local.alike(kind, candidates, len(spec.features))
            tasks = [partial(_candidate_scores, kind, data, spec, candidates[i], c, f) for i, c in same.items() for f in folds]
        done = run_jobs(train.sparkSession, tasks, parallelism)
        scores = sorted(row for rows_ in done for row in rows_)
        result = SearchResult(kind, candidates, scores, 0, None, train)
        result.best = max(range(len(candidates)), key=lambda c: (result._mean(c, 3), -c))
        if refit:
            result.model = fit_regressor(kind, data.drop("fold"), spec, result.best_params)
    return result


def grid_search(
    kind: str, train: DataFrame, spec: PanelSpec, grid: Mapping[str, Sequence] | None = None, **options
) -> SearchResult:
    """Try every combination of ``grid`` (default: the regressor's full grid)."""
    return cross_validate(kind, train, spec, expand_grid(grid or GRIDS[kind]), **options)


def random_search(
    kind: str,
    train: DataFrame,
    spec: PanelSpec,
    n_trials: int = 100,
    space: Mapping[str, object] | None = None,
    seed: int = 42,
    **options,
) -> SearchResult:
    """Try ``n_trials`` seeded draws from the regressor's search space.

    The MLP is validated on shuffled folds, the others on contiguous ones.
    """
    if kind == "mlp" and "fold" not in train.columns:
        train = shuffled_folds(train, spec, options.get("k", 5), seed)
    return cross_validate(kind, train, spec, draw(space or SPACES[kind], n_trials, seed), **options)


