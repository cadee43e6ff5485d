"""Scores of predictions, leaderboards and comparisons.

Predictions are rows (model, entity, period, y_true, y_pred). Score tables hold
one row per model, so global windows over them are small.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from panelkit.functions.dist import f_sf_column
from panelkit.functions.scalars import performance_tier, squared_error
from panelkit.operators.evolution import assign_region
from panelkit.operators.ordered import quantile_columns
from panelkit.spec import PanelSpec

#: A gap between mean train and validation score above this counts as overfitting.
OVERFIT_GAP = 0.1
# Order in which regions are reported.
REGION_ORDER = ("Europe", "Asia", "Americas", "Africa", "Middle East", "Other")


def r_squared(actual: str = "y_true", predicted: str = "y_pred") -> Column:
    """Aggregate: 1 - SSE / SST. Without variance: 1 if exact, else 0."""
    sse = F.sum(squared_error(actual, predicted))
    sst = F.var_pop(actual) * F.count(actual)
    return F.when(sst == 0, F.when(sse == 0, 1.0).otherwise(0.0)).otherwise(
        1 - F.try_divide(sse, sst)
    )


def residuals(predictions: DataFrame) -> DataFrame:
    return predictions.withColumn("error", F.col("y_true") - F.col("y_pred"))


def errors_long(wide: DataFrame, actual: str, models: Sequence[str]) -> DataFrame:
    """One prediction column per model -> rows (model, error)."""
    errors = wide.select(*[(F.col(actual) - F.col(m)).alias(m) for m in models])
    return errors.unpivot([], list(models), "model", "error")


def regression_metrics(
    predictions: DataFrame,
    n_features: int | Mapping[str, int],
    by: Sequence[str] = ("model",),
) -> DataFrame:
    """R2, adjusted R2, F statistic and p, RMSE, MAE, n and p per model.

    One aggregate with map-side partial sums; the p-value is taken on the few
    result rows.
    """
    if isinstance(n_features, Mapping):
        table = F.create_map(*[F.lit(x) for kv in n_features.items() for x in kv])
        p = table[F.col("model")].cast("bigint")
    else:
        p = F.lit(int(n_features)).cast("bigint")
    known = predictions.where(F.col("y_true").isNotNull() & F.col("y_pred").isNotNull())
    scores = known.groupBy(*by).agg(
        r_squared().alias("r2"),
        F.avg(squared_error("y_true", "y_pred")).alias("mse"),
        F.avg(F.abs(F.col("y_true") - F.col("y_pred"))).alias("mae"),
        F.count(F.lit(1)).cast("bigint").alias("n_samples"),
    ).withColumn("n_features", p)
    r2, n, k = F.col("r2"), F.col("n_samples"), F.col("n_features")
    spare = n - k - 1
    f = F.try_divide(F.try_divide(r2, k), F.try_divide(1 - r2, spare))
    usable = (r2 < 1) & (k > 0)
    scores = scores.withColumn(
        "adj_r2", 1 - F.try_divide((1 - r2) * (n - 1), spare)
    ).withColumn("f_stat", F.when(usable, f).otherwise(F.lit(float("inf"))))
    return scores.select(
        *by,
        "r2",
        "adj_r2",
        "f_stat",
        f_sf_column(F.col("f_stat"), k, spare).alias("f_pvalue"),
        F.sqrt("mse").alias("rmse"),
        "mae",
        "n_samples",
        "n_features",
    )


def panel_metrics(predictions: DataFrame, by: Sequence[str] = ("model",)) -> DataFrame:
    """Number of rows, MSE, RMSE, MAE and R2 per model."""
    return predictions.groupBy(*by).agg(
        F.count(F.lit(1)).cast("bigint").alias("n_test"),
        F.avg(squared_error("y_true", "y_pred")).alias("mse"),
        F.sqrt(F.avg(squared_error("y_true", "y_pred"))).alias("rmse"),
        F.avg(F.abs(F.col("y_true") - F.col("y_pred"))).alias("mae"),
        r_squared().alias("r2"),
    )


def actual_vs_predicted(predictions: DataFrame, time: str = "period") -> DataFrame:
    """Mean actual and predicted value per model and period."""
    return predictions.groupBy("model", time).agg(
        F.avg("y_true").alias("actual"), F.avg("y_pred").alias("predicted")
    )


def axis_range(predictions: DataFrame) -> DataFrame:
    """Common range of actual and predicted values per model."""
    return predictions.groupBy("model").agg(
        F.least(F.min("y_true"), F.min("y_pred")).alias("low"),
        F.greatest(F.max("y_true"), F.max("y_pred")).alias("high"),
    )


def error_stats(predictions: DataFrame) -> DataFrame:
    """Mean, std, min, max and median error per model."""
    errors = residuals(predictions).select("model", "error")
    basics = errors.groupBy("model").agg(
        F.avg("error").alias("mean_error"),
        F.stddev_samp("error").alias("std_error"),
        F.min("error").alias("min_error"),
        F.max("error").alias("max_error"),
    )
    medians = quantile_columns(errors, ["model"], "error", {"median_error": 0.5})
    return basics.join(medians, "model", "left")


def best_model(metrics: DataFrame) -> Column:
    """The model with the highest R2 (first name on ties), as a scalar subquery."""
    return metrics.orderBy(F.col("r2").desc(), "model").limit(1).select("model").scalar()


def metrics_by_region(
    predictions: DataFrame,
    spec: PanelSpec,
    lookup: DataFrame | None,
    order: Sequence[str] | None = REGION_ORDER,
) -> DataFrame:
    """R2, MAE and count per region for the best model; empty regions are absent."""
    scores = predictions.groupBy("model").agg(r_squared().alias("r2"))
    best = predictions.where(F.col("model") == best_model(scores))
    regional = assign_region(best, spec, lookup) if lookup is not None else best
    out = regional.groupBy("region").agg(
        r_squared().alias("r2"),
        F.avg(F.abs(F.col("y_true") - F.col("y_pred"))).alias("mae"),
        F.count(F.lit(1)).cast("bigint").alias("n_samples"),
    )
    if order is None:
        return out
    rank = F.array_position(F.array(*[F.lit(r) for r in order]), F.col("region"))
    return out.orderBy(F.when(rank > 0, rank).otherwise(len(order) + 1), "region")


def leaderboard(metrics: DataFrame, metric: str = "r2") -> DataFrame:
    """Rank models: R2 descending, error metrics ascending; ties by name."""
    order = F.col(metric).desc() if metric.endswith("r2") else F.col(metric).asc()
    rank = F.row_number().over(Window.orderBy(order, "model")).cast("bigint")
    mark = F.when(F.col("rank") == 1, "***").when(F.col("rank") == 2, "**").when(
        F.col("rank") == 3, "*"
    ).otherwise("")
    return (
        metrics.withColumn("rank", rank)
        .withColumn("mark", mark)
        .withColumn("tier", performance_tier("r2"))
    )


def leaderboard_summary(metrics: DataFrame) -> DataFrame:
    """Mean and std of R2, mean adjusted R2 and MAE, champion, number of models."""
    first = F.min(F.struct((-F.col("r2")).alias("k"), F.col("model").alias("v")))["v"]
    return metrics.agg(
        F.avg("r2").alias("mean_r2"),
        F.stddev_samp("r2").alias("std_r2"),
        F.avg("adj_r2").alias("mean_adj_r2"),
        F.avg("mae").alias("mean_mae"),
        first.alias("champion"),
        F.count(F.lit(1)).cast("bigint").alias("n_models"),
    )


def best_worst(metrics: DataFrame) -> DataFrame:
    """Best and worst model by R2 (first name on ties), lowest RMSE and MAE."""
    return metrics.agg(
        F.min(F.struct((-F.col("r2")).alias("k"), F.col("model").alias("v")))["v"].alias("best_model"),
        F.max("r2").alias("best_r2"),
        F.min(F.struct(F.col("r2").alias("k"), F.col("model").alias("v")))["v"].alias("worst_model"),
        F.min("r2").alias("worst_r2"),
        F.min("rmse").alias("min_rmse"),
        F.min("mae").alias("min_mae"),
    )


def radar_scores(metrics: DataFrame) -> DataFrame:
    return metrics.select(
        "model", "r2", (1 - F.col("rmse")).alias("rmse_inv"), (1 - F.col("mae")).alias("mae_inv")
    )


def train_vs_test(train: DataFrame, test: DataFrame) -> DataFrame:
    """R2 on both splits and their difference for models found in both."""
    a = train.select("model", F.col("r2").alias("r2_train"))
    b = test.select("model", F.col("r2").alias("r2_test"))
    return (
        a.join(b, "model")
        .withColumn("diff", F.col("r2_train") - F.col("r2_test"))
        .orderBy(F.col("r2_test").desc(), "model")
    )


def with_overfitting(scores: DataFrame, limit: float = OVERFIT_GAP) -> DataFrame:
    """Add gap and flag to a table with ``train_score`` and ``cv_score``."""
    gap = F.col("train_score") - F.col("cv_score")
    return scores.withColumn("overfitting_gap", gap).withColumn("has_overfitting", gap > limit)


def models_vs_benchmark(models: DataFrame, benchmark: DataFrame) -> DataFrame:
    """Union of model scores and a benchmark row, with the best of each metric marked.

    An MAE of zero or less stands for a missing one.
    """
    both = models.select("model", "r2", "rmse", "mae", F.lit(False).alias("is_benchmark")).unionByName(
        benchmark.select("model", "r2", "rmse", "mae", F.lit(True).alias("is_benchmark"))
    )
    both = both.withColumn("mae", F.when(F.col("mae") > 0, F.col("mae")))
    everyone = Window.partitionBy()
    return both.select(
        "*",
        (F.col("r2") == F.max("r2").over(everyone)).alias("best_r2"),
        (F.col("rmse") == F.min("rmse").over(everyone)).alias("best_rmse"),
        F.coalesce(F.col("mae") == F.min("mae").over(everyone), F.lit(False)).alias("best_mae"),
    )


def union_results(results: Mapping[str, DataFrame]) -> DataFrame:
    """Union of result tables tagged with their source; missing columns become null."""
    tagged = [df.withColumn("source", F.lit(name)) for name, df in results.items()]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tagged)


def top_importances(importances: DataFrame, n: int = 10) -> DataFrame:
    """The ``n`` most important features."""
    return importances.orderBy(F.col("importance").desc(), "feature").limit(n)


def by_magnitude(coefficients: DataFrame) -> DataFrame:
    return coefficients.orderBy(F.abs("coefficient").desc(), "feature")
