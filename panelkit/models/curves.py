"""Learning curves and fold-score comparisons."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import partial

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelkit.models import linear
from panelkit.models.folds import fold_bounds, fold_of, shuffled_positions
from panelkit.models.regressors import fit_regressor
from panelkit.models.search import SearchResult, cross_validate
from panelkit.operators.metrics import r_squared
from panelkit.operators.reshape import complete_cases
from panelkit.runtime import cached, run_jobs
from panelkit.spec import PanelSpec

#: Shares of the training rows at which a curve is taken.
SHARES = (0.2, 0.4, 0.6, 0.8, 1.0)


def learning_curve(
    kinds: Mapping[str, dict],
    train: DataFrame,
    spec: PanelSpec,
    shares: Sequence[float] = SHARES,
    k: int = 3,
    seed: int = 42,
    parallelism: int = 4,
) -> DataFrame:
    """Scores of growing training sets: mean and std (ddof 0) over the folds.

    ``kinds`` maps a regressor to its parameters. Rows are put in a seeded order
    once; the training set of a fold grows along it, so smaller sets are
    contained in larger ones. The elastic net takes one scan for all of them.
    """
    rows = complete_cases(train.select(*spec.keys, spec.target, *spec.features))
    n = rows.count()
    bounds = fold_bounds(n, k)
    placed = shuffled_positions(rows, spec, seed).withColumn("fold", fold_of(F.col("position"), n, k))

    def score(data: DataFrame, kind: str, params: dict, fold: int, share: float) -> tuple:
        start, end = bounds[fold]
        # place of a row among those outside the fold
        place = F.when(F.col("position") < start, F.col("position")).otherwise(
            F.col("position") - (end - start)
        )
        outside = F.col("fold") != fold
        size = max(1, int(share * (n - (end - start))))
        chosen = outside & (place < size)
        fitted = fit_regressor(kind, data.where(chosen), spec, params)
        sides = (
            fitted.predict(data.where(chosen | ~outside))
            .select(outside.alias("train"), F.col(spec.target).alias("y_true"), "y_pred")
            .groupBy("train")
            .agg(r_squared().alias("r2"))
            .collect()
        )
        by_side = {r["train"]: r["r2"] for r in sides}
        return kind, float(share), size, fold, by_side.get(True), by_side.get(False)

    def prefix(fold: int, share: float) -> tuple[int, int]:
        """Size of a training set, and the position before which it lies."""
        start, end = bounds[fold]
        size = max(1, int(share * (n - (end - start))))
        return size, size if size <= start else size + end - start

    def linear_scores(kind: str, params: dict) -> list[tuple]:
        """All sizes and folds from one scan: moments of the stretches between all borders."""
        borders = sorted({b for pair in bounds for b in pair} | {prefix(f, s)[1] for f in range(k) for s in shares})
        stretch = sum(((F.col("position") >= b).cast("int") for b in borders), F.lit(0))
        parts = linear.moments_by(placed, [*spec.features, spec.target], stretch)
        lows = [0, *borders]

        def rows_of(chosen) -> linear.Moments:
            return linear.total((m for i, m in sorted(parts.items()) if chosen(lows[i])), len(spec.features) + 1)

        found = []
        for fold, (start, end) in enumerate(bounds):
            held = rows_of(lambda low: start <= low < end)
            for share in shares:
                size, stop = prefix(fold, share)
                seen = rows_of(lambda low: low < stop and not start <= low < end)
                fit = linear.fit_paths(spec.features, seen, [params])[0]
                found.append((kind, float(share), size, fold, fit.r2(seen), fit.r2(held)))
        return found

    out = [row for kind, params in kinds.items() if kind == "elastic_net" for row in linear_scores(kind, params)]
    others = {kind: params for kind, params in kinds.items() if kind != "elastic_net"}
    if others:
        with cached(placed) as data:
            jobs = [
                partial(score, data, kind, params, fold, share)
                for kind, params in others.items() for fold in range(k) for share in shares
            ]
            out += run_jobs(train.sparkSession, jobs, parallelism)
    table = train.sparkSession.createDataFrame(
        out,
        "model string, share double, train_size bigint, fold bigint, "
        "train_score double, cv_score double",
    )
    return table.groupBy("model", "share").agg(
        F.min("train_size").alias("train_size"),
        F.avg("train_score").alias("train_mean"),
        F.stddev_pop("train_score").alias("train_std"),
        F.avg("cv_score").alias("cv_mean"),
        F.stddev_pop("cv_score").alias("cv_std"),
    )


def fold_scores(results: Sequence[SearchResult]) -> DataFrame:
    """Validation score per model and fold of each best candidate."""
    tables = [r.fold_table().where(F.col("candidate") == r.best) for r in results]
    out = tables[0]
    for t in tables[1:]:
        out = out.unionByName(t)
    return out.select("model", "fold", "train_score", "cv_score")


def cv_comparison(scores: DataFrame) -> DataFrame:
    """Mean and std (ddof 0) of the fold scores per model."""
    return scores.groupBy("model").agg(
        F.avg("cv_score").alias("cv_mean"), F.stddev_pop("cv_score").alias("cv_std")
    )


def cv_scores(
    kinds: Mapping[str, dict], train: DataFrame, spec: PanelSpec, k: int = 5
) -> DataFrame:
    """Fold scores of fixed parameters for several regressors."""
    results = [
        cross_validate(kind, train, spec, [params], k=k, refit=False)
        for kind, params in kinds.items()
    ]
    return fold_scores(results)
