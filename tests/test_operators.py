"""Hand-computed cases of scores, statistics, quality and temporal operators."""

import math

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from panelkit.functions import scalars
from panelkit.operators import evolution, metrics, quality, stats, temporal
from panelkit.spec import PanelSpec

PRED = "model string, entity string, period int, y_true double, y_pred double"


@pytest.fixture(scope="module")
def predictions(spark):
    rng = np.random.default_rng(0)
    rows = []
    for i in range(60):
        y = float(rng.normal())
        rows.append(("good", f"e{i % 6}", 2000 + i % 10, y, y + 0.1 * float(rng.normal())))
        rows.append(("bad", f"e{i % 6}", 2000 + i % 10, y, float(rng.normal())))
    return spark.createDataFrame(rows, PRED), pd.DataFrame(
        rows, columns=["model", "entity", "period", "y_true", "y_pred"]
    )


def test_regression_metrics(predictions):
    df, pdf = predictions
    got = {r["model"]: r for r in metrics.regression_metrics(df, {"good": 2, "bad": 3}).collect()}
    for model, p in (("good", 2), ("bad", 3)):
        g = pdf[pdf["model"] == model]
        e = g["y_true"] - g["y_pred"]
        r2 = 1 - (e**2).sum() / ((g["y_true"] - g["y_true"].mean()) ** 2).sum()
        r = got[model]
        assert r["r2"] == pytest.approx(r2)
        assert r["adj_r2"] == pytest.approx(1 - (1 - r2) * 59 / (60 - p - 1))
        assert r["f_stat"] == pytest.approx((r2 / p) / ((1 - r2) / (60 - p - 1)))
        assert r["rmse"] == pytest.approx(math.sqrt((e**2).mean()))
        assert r["mae"] == pytest.approx(e.abs().mean())
        assert (r["n_samples"], r["n_features"]) == (60, p)
    assert got["good"]["f_pvalue"] < 1e-10 and got["bad"]["f_pvalue"] == 1.0


def test_perfect_predictions(spark):
    df = spark.createDataFrame([("m", "e", i, float(i), float(i)) for i in range(1, 6)], PRED)
    r = metrics.regression_metrics(df, 1).first()
    assert r["r2"] == 1 and r["rmse"] == 0 and r["f_stat"] == math.inf and r["f_pvalue"] == 0
    assert stats.kde(metrics.residuals(df), "error", ["model"]).count() == 0
    flat = stats.histogram(metrics.residuals(df), "error", 4, ["model"]).collect()
    assert sum(x["n"] for x in flat) == 5 and len(flat) == 4


def test_constant_target(spark):
    df = spark.createDataFrame([("m", "e", i, 2.0, 2.0 + i) for i in range(3)], PRED)
    assert metrics.regression_metrics(df, 1).first()["r2"] == 0


def test_ties_are_ranked_by_name(spark):
    rows = [("b", 0.5, 0.5, 1.0, 0.2), ("a", 0.5, 0.5, 2.0, 0.1), ("c", 0.1, 0.1, 3.0, 0.3)]
    board = spark.createDataFrame(rows, "model string, r2 double, adj_r2 double, rmse double, mae double")
    ranked = {r["model"]: r["rank"] for r in metrics.leaderboard(board).collect()}
    assert ranked == {"a": 1, "b": 2, "c": 3}
    by_error = {r["model"]: r["rank"] for r in metrics.leaderboard(board, "rmse").collect()}
    assert by_error == {"b": 1, "a": 2, "c": 3}
    best = metrics.best_worst(board).first()
    assert (best["best_model"], best["worst_model"], best["min_mae"]) == ("a", "c", 0.1)
    assert metrics.leaderboard_summary(board).first()["champion"] == "a"


def test_missing_benchmark_mae(spark):
    schema = "model string, r2 double, rmse double, mae double"
    models = spark.createDataFrame([("a", 0.5, 1.0, 0.2), ("b", 0.6, 0.9, 0.1)], schema)
    bench = spark.createDataFrame([("panel", 0.7, 0.8, 0.0)], schema)
    got = {r["model"]: r for r in metrics.models_vs_benchmark(models, bench).collect()}
    assert got["panel"]["mae"] is None and got["panel"]["best_r2"] and got["panel"]["best_rmse"]
    assert got["b"]["best_mae"] and not got["panel"]["best_mae"]


def test_metrics_by_region_order(spark, predictions):
    df, pdf = predictions
    lookup = spark.createDataFrame(
        [("e0", "Asia"), ("e1", "Europe"), ("e2", "Europe")], "entity string, region string"
    )
    rows = metrics.metrics_by_region(df, PanelSpec(), lookup).collect()
    assert [r["region"] for r in rows] == ["Europe", "Asia", "Other"]
    g = pdf[(pdf["model"] == "good") & pdf["entity"].isin(["e1", "e2"])]
    assert rows[0]["mae"] == pytest.approx((g["y_true"] - g["y_pred"]).abs().mean())
    assert rows[0]["n_samples"] == 20


def test_train_vs_test_and_top(spark):
    a = spark.createDataFrame([("x", 0.9), ("y", 0.8)], "model string, r2 double")
    b = spark.createDataFrame([("x", 0.6), ("z", 0.8)], "model string, r2 double")
    rows = metrics.train_vs_test(a, b).collect()
    assert len(rows) == 1 and rows[0]["diff"] == pytest.approx(0.3)
    imp = spark.createDataFrame([("a", 0.1), ("b", 0.4), ("c", 0.3)], "feature string, importance double")
    assert [r["feature"] for r in metrics.top_importances(imp, 2).collect()] == ["b", "c"]


def test_coverage_threshold_is_inclusive(spark):
    rows = [("in", t, None if t < 3 else 1.0) for t in range(10)]
    rows += [("out", t, None if t < 31 else 1.0) for t in range(100)]
    df = spark.createDataFrame(rows, "entity string, period int, v double")
    spec = PanelSpec(features=("v",))
    kept = quality.coverage_filter(df, spec).select("entity").distinct().collect()
    assert [r["entity"] for r in kept] == ["in"]
    # counting the never-empty period halves the share
    assert quality.coverage_filter(df, spec, count_time=True).select("entity").distinct().count() == 2


def test_constant_column_has_no_correlation(spark):
    df = spark.createDataFrame([(1.0, 2.0, 5.0), (2.0, 4.0, 5.0), (3.0, None, 5.0)], "a double, b double, k double")
    got = {(r["f1"], r["f2"]): r["r"] for r in stats.correlation_matrix(df, ["a", "b", "k"]).collect()}
    assert len(got) == 9
    assert got[("a", "b")] == pytest.approx(1.0) and got[("b", "a")] == got[("a", "b")]
    assert got[("a", "k")] is None and got[("k", "k")] is None
    strong = stats.strong_pairs(stats.correlation_matrix(df, ["a", "b", "k"]), ["a", "b", "k"]).collect()
    assert [(r["f1"], r["f2"]) for r in strong] == [("a", "b")]


def test_box_and_describe(spark):
    values = [1.0, 2.0, 3.0, 4.0, 100.0, None]
    df = spark.createDataFrame([("g", v) for v in values], "g string, v double")
    r = stats.box_summary(df, "v", ["g"]).first()
    assert (r["q1"], r["median"], r["q3"]) == (2, 3, 4)
    assert (r["whisker_low"], r["whisker_high"], r["n_outliers"], r["n"]) == (1, 4, 1, 5)
    assert [x["v"] for x in stats.box_outliers(df, "v").collect()] == [100.0]
    d = stats.describe(df, ["v"]).first()
    assert (d["count"], d["p25"], d["p50"], d["p75"]) == (5, 2, 3, 4)
    assert d["std"] == pytest.approx(pd.Series(values).std())


def test_kde_equals_the_sum_of_all_kernels(spark):
    rng = np.random.default_rng(3)
    shapes = {"wide": rng.normal(size=400), "hot": np.repeat(rng.normal(size=9), 60), "far": np.append(rng.normal(size=300), [1e4, -1e4])}
    rows = [(k, float(v)) for k, values in shapes.items() for v in values] + [("wide", None), ("flat", 1.0), ("flat", 1.0)]
    out = stats.kde(spark.createDataFrame(rows, "kind string, v double"), "v", ["kind"]).toPandas()
    assert set(out.kind) == set(shapes) and len(out) == 300
    for kind, values in shapes.items():
        part = out[out.kind == kind].sort_values("point")
        h = len(values) ** -0.2 * values.std(ddof=1)
        x = np.linspace(values.min(), values.max(), 100)
        want = np.exp(-0.5 * ((x[:, None] - values) / h) ** 2).sum(axis=1) / (len(values) * h * math.sqrt(2 * math.pi))
        np.testing.assert_allclose(part.x, x, rtol=1e-9, atol=1e-9)
        np.testing.assert_allclose(part.density, want, rtol=0, atol=1e-11 / h)


def test_kde_integrates_to_about_one(spark):
    rng = np.random.default_rng(2)
    v = rng.normal(size=400)
    df = spark.createDataFrame([(float(x),) for x in v], "v double")
    out = stats.kde(df, "v").orderBy("point").toPandas()
    assert len(out) == 100
    h = len(v) ** -0.2 * v.std(ddof=1)
    want = np.exp(-0.5 * ((out["x"].to_numpy()[:, None] - v) / h) ** 2).sum(1) / (len(v) * h * math.sqrt(2 * math.pi))
    assert np.allclose(out["density"], want)
    assert 0.95 < np.trapezoid(out["density"], out["x"]) <= 1


@pytest.mark.parametrize(
    "options, cut",
    [({"train_end": 2015}, 2015), ({"test_periods": 3}, 2016), ({}, 2015),
     ({"train_end": 2010, "test_periods": 3}, 2010), ({"test_ratio": 0.33}, 2013)],
)
def test_split_modes(panel, options, cut):
    df, spec, _ = panel
    train, test = temporal.temporal_split(df, spec, **options)
    assert train.agg(F.max("period")).first()[0] == cut
    assert test.agg(F.min("period")).first()[0] == cut + 1
    assert train.count() + test.count() == 400


def test_slices(panel):
    df, spec, _ = panel
    assert temporal.latest_slice(df, spec).select("period").distinct().first()[0] == 2019
    assert temporal.of_entity(df, spec, "C03").count() == 20
    first = temporal.recent_first(temporal.of_entity(df, spec, "C03"), spec, ["period", "nope", "y"])
    assert first.columns == ["period", "y"] and first.first()["period"] == 2019
    assert temporal.entities(df, spec).first()[0] == "C00"


def test_evolution(spark):
    rows = [("a", 1, 1.0), ("b", 1, 3.0), ("a", 2, 5.0), ("b", 2, None), ("a", 3, 2.0)]
    df = spark.createDataFrame(rows, "entity string, period int, v double")
    spec = PanelSpec()
    ev = evolution.period_evolution(df, spec, "v")
    s = evolution.evolution_summary(ev, spec).first()
    assert (s["lowest"], s["lowest_period"]) == (2.0, 1)  # tie of 1 and 3: the earlier
    assert (s["highest"], s["highest_period"], s["total_change"]) == (5.0, 2, 0.0)
    assert s["average_count"] == 1
    lookup = spark.createDataFrame([("a", "A")], "entity string, region string")
    regional = evolution.region_evolution(evolution.assign_region(df, spec, lookup), spec, "v")
    change = {r["region"]: r["change"] for r in evolution.region_change(regional, spec).collect()}
    assert change["A"] == 1.0 and change["Other"] is None
    buckets = evolution.period_buckets(df, spec, "v", 1, 2, tolerance=0.5).orderBy("bucket").collect()
    assert [b["trend"] for b in buckets] == [None, "Declining"]


def test_labels(spark):
    df = spark.createDataFrame([(x,) for x in (-2.0, -1.0, 0.5, 0.6, None)], "v double")
    assert [r[0] for r in df.select(scalars.level_band("v")).collect()] == [
        "low", "moderate", "moderate", "high", None,
    ]
    p = spark.createDataFrame([(x,) for x in (0.0005, 0.005, 0.05, 0.5)], "p double")
    assert [r[0] for r in p.select(scalars.significance_label("p")).collect()] == ["***", "**", "ns", "ns"]
    t = spark.createDataFrame([("1.5",), ("abc",), ("nan",), (None,)], "s string")
    assert [r[0] for r in t.select(scalars.to_number("s")).collect()] == [1.5, None, None, None]
    y = spark.createDataFrame([("2000",), ("2000.5",), ("x",)], "s string")
    assert [r[0] for r in y.select(scalars.to_period("s")).collect()] == [2000, None, None]


def test_iqr_filter(spark):
    df = spark.createDataFrame([(float(v),) for v in (1, 2, 3, 4, 100)] + [(None,)], "v double")
    assert quality.iqr_filter(df, ["v"]).count() == 5
