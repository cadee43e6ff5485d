"""Write panels, scores and reports."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelkit.functions.scalars import significance_label
from panelkit.operators.metrics import OVERFIT_GAP, leaderboard, union_results
from panelkit.operators.temporal import tag_split
from panelkit.spec import PanelSpec


def write_splits(
    df: DataFrame, spec: PanelSpec, train_end: int, path: str, fmt: str = "parquet"
) -> None:
    """Write the panel once, partitioned by ``split``.

    Reading the folder gives the full panel; a filter on ``split`` reads one part.
    """
    writer = tag_split(df, spec, train_end).write.mode("overwrite").partitionBy("split")
    (writer.option("header", True) if fmt == "csv" else writer).format(fmt).save(path)


def save_table(df: DataFrame, path: str, fmt: str = "parquet") -> None:
    """Write any result table."""
    writer = df.write.mode("overwrite")
    (writer.option("header", True) if fmt == "csv" else writer).format(fmt).save(path)


def save_leaderboard(
    metrics: DataFrame, path: str, train_samples: int, test_samples: int, fmt: str = "parquet"
) -> DataFrame:
    """Write the scores, best R2 first, with time stamp and sample counts."""
    board = (
        leaderboard(metrics)
        .withColumn("timestamp", F.date_format(F.current_timestamp(), "yyyy-MM-dd HH:mm:ss"))
        .withColumn("train_samples", F.lit(train_samples).cast("bigint"))
        .withColumn("test_samples", F.lit(test_samples).cast("bigint"))
        .orderBy("rank")
    )
    save_table(board, path, fmt)
    return board


def save_evaluation_summary(
    results: Mapping[str, DataFrame], path: str, fmt: str = "parquet"
) -> DataFrame:
    """Write the union of result tables, each row tagged with its source."""
    summary = union_results(results)
    save_table(summary, path, fmt)
    return summary


def result_report(
    metrics: DataFrame,
    settings: Mapping[str, Mapping[str, object]],
    importances: DataFrame | None = None,
) -> DataFrame:
    """Everything about fitted models as rows (model, section, key, value).

    ``settings`` maps a model to its configuration and best parameters. Scores
    come from ``metrics`` and, if given, importances from (model, feature,
    importance).
    """
    spark: SparkSession = metrics.sparkSession
    rows = [
        (model, "configuration", str(k), str(v))
        for model, values in settings.items()
        for k, v in values.items()
    ]
    report = spark.createDataFrame(rows, "model string, section string, key string, value string")

    sections = {
        "overfitting": ["train_score", "cv_score", "overfitting_gap"],
        "test": ["r2", "adj_r2", "rmse", "mae", "n_samples", "n_features"],
        "significance": ["f_stat", "f_pvalue"],
    }
    for section, columns in sections.items():
        present = [c for c in columns if c in metrics.columns]
        if not present:
            continue
        as_text = metrics.select("model", *[F.col(c).cast("string").alias(c) for c in present])
        report = report.unionByName(
            as_text.unpivot("model", present, "key", "value").select(
                "model", F.lit(section).alias("section"), "key", "value"
            )
        )
    if "overfitting_gap" in metrics.columns:
        status = F.when(F.col("overfitting_gap") > OVERFIT_GAP, "YES").otherwise("NO")
        report = report.unionByName(
            metrics.select(
                "model", F.lit("overfitting").alias("section"), F.lit("status").alias("key"),
                status.alias("value"),
            )
        )
    if "f_pvalue" in metrics.columns:
        report = report.unionByName(
            metrics.select(
                "model", F.lit("significance").alias("section"), F.lit("label").alias("key"),
                significance_label("f_pvalue").alias("value"),
            )
        )
    if importances is not None:
        report = report.unionByName(
            importances.select(
                "model", F.lit("importance").alias("section"), F.col("feature").alias("key"),
                F.col("importance").cast("string").alias("value"),
            )
        )
    return report


def save_panel_report(
    coefficients: DataFrame, statistics: DataFrame, path: str, fmt: str = "parquet"
) -> None:
    """Write the coefficient table and the fit statistics of a panel model."""
    save_table(coefficients, f"{path}/coefficients", fmt)
    save_table(statistics, f"{path}/statistics", fmt)
