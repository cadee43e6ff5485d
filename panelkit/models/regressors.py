"""The seven regressors behind one interface.

``fit_regressor`` returns a ``Fitted`` whose ``predict`` adds ``y_pred`` to any
frame with the features. Tree ensembles are Spark ML pipelines, the elastic net comes
from moments; neighbours and networks are jobs of their own.

Where Spark ML lacks a parameter of the grids:

* ``min_samples_split`` asks for half as many rows in each child;
* L1/L2 penalties of boosted leaves have no counterpart and are ignored;
* a depth of None becomes 30, the deepest tree Spark grows.
"""

from __future__ import annotations

import json
from collections.abc import Mapping, Sequence
from dataclasses import asdict, dataclass, field

import numpy as np
from pyspark.ml import PipelineModel
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import GBTRegressor, RandomForestRegressor
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelkit.models import linear, net
from panelkit.models.knn import NeighbourIndex, neighbour_average
from panelkit.models.scaling import ZScores
from panelkit.operators.reshape import complete_cases
from panelkit.runtime import stored
from panelkit.spec import PanelSpec

SEED = 42
MAX_DEPTH = 30

#: Kind -> display name, in the order models are trained and listed.
NAMES = {
    "random_forest": "Random Forest",
    "xgboost": "XGBoost",
    "gradient_boosting": "Gradient Boosting",
    "elastic_net": "Elastic Net",
    "svr": "SVR",
    "knn": "KNN",
    "mlp": "MLP",
}


def _depth(value) -> int:
    return MAX_DEPTH if value is None else min(int(value), MAX_DEPTH)


def _least_rows(params: Mapping) -> int:
    leaf = int(params.get("min_samples_leaf", 1))
    return max(leaf, int(params.get("min_samples_split", 2)) // 2, 1)


def forest_settings(params: Mapping) -> dict:
    """What the forest's learner is given; candidates that are equal here are the same fit."""
    subset = params.get("max_features", "all")
    return {
        "numTrees": int(params.get("n_estimators", 100)),
        "maxDepth": _depth(params.get("max_depth")),
        "minInstancesPerNode": _least_rows(params),
        "featureSubsetStrategy": "all" if subset is None else str(subset),
        "minInfoGain": float(params.get("min_impurity_decrease", 0.0)),
        "maxBins": int(params.get("max_bins", 32)),
    }


def boosted_settings(params: Mapping) -> dict:
    """The same for both kinds of boosted trees."""
    subset = params.get("colsample_bytree", params.get("max_features"))
    least = int(params["min_child_weight"]) if "min_child_weight" in params else _least_rows(params)
    return {
        "maxIter": int(params.get("n_estimators", 100)),
        "maxDepth": _depth(params.get("max_depth", 3)),
        "stepSize": float(params.get("learning_rate", 0.1)),
        "subsamplingRate": float(params.get("subsample", 1.0)),
        "featureSubsetStrategy": "all" if subset in (None, 1, 1.0) else str(subset),
        "minInfoGain": float(params.get("gamma", 0.0)),
        "minInstancesPerNode": max(least, 1),
        "maxBins": int(params.get("max_bins", 32)),
    }


@dataclass
class Fitted:
    """A fitted regressor of any kind."""

    kind: str
    features: tuple[str, ...]
    target: str
    keys: tuple[str, ...]
    params: dict
    pipeline: PipelineModel | None = None
    neighbours: DataFrame | None = None
    index: NeighbourIndex | None = None
    scores: ZScores | None = None
    line: linear.LinearFit | None = None
    network: net.NetFit | None = None
    details: dict = field(default_factory=dict)

    def predict(self, df: DataFrame) -> DataFrame:
        """Add ``y_pred``. Rows with a missing feature get null."""
        if self.kind == "knn":
            return self._predict_knn(df)
        if self.network is not None:
            return self.network.predict(df)
        if self.line is not None:
            return df.withColumn("y_pred", self.line.column())
        if self.pipeline is None:
            raise ValueError(f"there is no fitted {self.kind} to predict with")
        known = F.lit(True)
        for c in self.features:
            known = known & F.col(c).isNotNull()
        added = ["prediction", "_features"]
        scored = self.pipeline.transform(df)
        return scored.withColumn("y_pred", F.when(known, F.col("prediction"))).drop(*added)

    def neighbour_table(self, df: DataFrame, k: int | None = None) -> DataFrame:
        """The k nearest training rows of every complete row."""
        asked = complete_cases(df.select(*self.keys, *self.features))
        k = int(k or self.params.get("n_neighbors", 5))
        if self.index is None or self.index.most < k:
            self.index = NeighbourIndex.build(self.neighbours, self.keys, self.features, self.target, k)
        return self.index.nearest(self.scores.apply(asked), k, metric_of(self.params))

    def _predict_knn(self, df: DataFrame) -> DataFrame:
        means = self.neighbour_table(df).groupBy(
            *[F.col(f"q_{c}").alias(c) for c in self.keys]
        ).agg(neighbour_average(self.params.get("weights", "uniform")).alias("y_pred"))
        return df.join(means, list(self.keys), "left")

    def importances(self, spark: SparkSession) -> DataFrame:
        """(feature, importance), most important first; trees only."""
        if self.pipeline is None or not hasattr(self.pipeline.stages[-1], "featureImportances"):
            raise ValueError(f"{self.kind} has no feature importances")
        values = self.pipeline.stages[-1].featureImportances.toArray()
        rows = [(f, float(v)) for f, v in zip(self.features, values)]
        return spark.createDataFrame(rows, "feature string, importance double").orderBy(
            F.col("importance").desc(), "feature"
        )

    def coefficients(self, spark: SparkSession) -> DataFrame:
        """(feature, coefficient) on z-scores, largest magnitude first."""
        if self.line is None:
            raise ValueError(f"{self.kind} has no coefficients")
        rows = list(zip(self.features, self.line.coefficients))
        return spark.createDataFrame(rows, "feature string, coefficient double").orderBy(
            F.abs("coefficient").desc(), "feature"
        )

    def save(self, spark: SparkSession, path: str) -> None:
        """Write the model under ``path``, replacing what is there."""
        about = {
            "kind": self.kind, "features": self.features, "target": self.target,
            "keys": self.keys, "params": self.params,
            "scores": asdict(self.scores) if self.scores else None,
        }
        if self.line is not None:
            about["line"] = {"coefficients": self.line.coefficients, "intercept": self.line.intercept}
        if self.network is not None:
            n = self.network
            about["network"] = {
                "scores": asdict(n.scores), "mean": n.target_mean, "std": n.target_std,
                "config": asdict(n.config), "weights": n.weights.tolist(), "history": n.history,
            }
        if self.pipeline is not None:
            self.pipeline.write().overwrite().save(f"{path}/pipeline")
        if self.neighbours is not None:
            self.neighbours.write.mode("overwrite").parquet(f"{path}/neighbours")
        spark.createDataFrame([(json.dumps(about),)], "about string").coalesce(1).write.mode(
            "overwrite"
        ).parquet(f"{path}/about")


def metric_of(params: Mapping) -> str:
    """``metric``, or p = 1 / 2 for manhattan / euclidean."""
    if "metric" in params:
        return params["metric"]
    return "manhattan" if int(params.get("p", 2)) == 1 else "euclidean"


def load_regressor(spark: SparkSession, path: str) -> Fitted:
    """Read a model written by ``Fitted.save``."""
    from panelkit.sources.files import path_exists

    if not path_exists(spark, f"{path}/about"):
        raise FileNotFoundError(f"no model at {path}")
    about = json.loads(spark.read.parquet(f"{path}/about").first()["about"])

    def scores_of(d) -> ZScores:
        return ZScores(tuple(d["features"]), tuple(d["means"]), tuple(d["stds"]))

    fitted = Fitted(
        about["kind"], tuple(about["features"]), about["target"], tuple(about["keys"]),
        about["params"], scores=scores_of(about["scores"]) if about["scores"] else None,
    )
    if about.get("line"):
        fitted.line = linear.LinearFit(fitted.scores, tuple(about["line"]["coefficients"]), about["line"]["intercept"])
    if about.get("network"):
        n = about["network"]
        config = dict(n["config"])
        config["mapping"] = net.FeatureMap(**config["mapping"])
        config["hidden"] = tuple(config["hidden"])
        fitted.network = net.NetFit(
            fitted.features, scores_of(n["scores"]), n["mean"], n["std"],
            net.NetConfig(**config), np.array(n["weights"]), tuple(n["history"]),
        )
    if path_exists(spark, f"{path}/pipeline"):
        fitted.pipeline = PipelineModel.load(f"{path}/pipeline")
    if path_exists(spark, f"{path}/neighbours"):
        fitted.neighbours = spark.read.parquet(f"{path}/neighbours")
    return fitted


def fit_regressor(
    kind: str, train: DataFrame, spec: PanelSpec, params: Mapping | None = None
) -> Fitted:
    """Fit one regressor on the complete rows of ``train``."""
    params = dict(params or {})
    features, target = tuple(spec.features), spec.target
    rows = complete_cases(train.select(*spec.keys, target, *features))
    fitted = Fitted(kind, features, target, tuple(spec.keys), params)

    if kind in ("random_forest", "xgboost", "gradient_boosting"):
        if kind == "random_forest":
            learner = RandomForestRegressor(seed=SEED, **forest_settings(params))
        else:
            learner = GBTRegressor(seed=SEED, **boosted_settings(params))
        fitted.pipeline = _fit_pipeline(rows, learner, list(features), target)
    elif kind == "elastic_net":
        columns = [*features, target]
        seen = linear.moments_by(rows, columns).get(0, linear.Moments.none(len(columns)))
        if not seen.n:
            raise ValueError("no complete rows to fit on")
        fitted.line = linear.fit_paths(features, seen, [params])[0]
        fitted.scores = fitted.line.scores
    elif kind == "knn":
        fitted.scores = ZScores.of(rows, features)
        fitted.neighbours = stored(fitted.scores.apply(rows))
    elif kind == "mlp":
        fitted.network = net.fit_net(rows, features, target, net.mlp_config(params), spec.keys)
    elif kind == "svr":
        config = net.svr_config(params, rows.count(), len(features))
        fitted.network = net.fit_net(rows, features, target, config, spec.keys)
    else:
        raise ValueError(f"unknown regressor: {kind}")
    return fitted


def _fit_pipeline(rows, learner, inputs: Sequence[str], target: str) -> PipelineModel:
    assembler = VectorAssembler(
        inputCols=list(inputs), outputCol="_features", handleInvalid="keep"
    )
    learner.setFeaturesCol("_features").setLabelCol(target).setPredictionCol("prediction")
    return PipelineModel([assembler, learner.fit(assembler.transform(rows))])
