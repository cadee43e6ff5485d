"""Regressors, search and folds."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from panelkit.models import folds, linear, net
from panelkit.models.curves import cv_comparison, cv_scores, learning_curve
from panelkit.models.knn import knn_predict, nearest_neighbours
from panelkit.models.regressors import NAMES, fit_regressor
from panelkit.models.scaling import ZScores
from panelkit.models.search import GRIDS, QUICK_GRIDS, SPACES, draw, expand_grid, grid_search, random_search
from panelkit.models.training import PanelRegressor, train_all
from panelkit.spec import PanelSpec


def test_grid_sizes():
    sizes = {k: len(expand_grid(g)) for k, g in GRIDS.items()}
    assert sizes == {
        "random_forest": 216, "xgboost": 192, "gradient_boosting": 324, "elastic_net": 25,
        "svr": 48, "knn": 20, "mlp": 48,
    }
    assert set(SPACES) == set(QUICK_GRIDS) == set(NAMES)


def test_draws_are_seeded_and_inside():
    a, b = draw(SPACES["svr"], 40, 1), draw(SPACES["svr"], 40, 1)
    assert a == b and a != draw(SPACES["svr"], 40, 2)
    assert all(0.01 <= c["C"] <= 100 and ("gamma" in c) == (c["kernel"] != "linear") for c in a)


@pytest.mark.parametrize("kind", list(NAMES))
def test_each_regressor(spark, regression, kind, tmp_path):
    train, test, spec, _ = regression
    model = PanelRegressor(kind, spec)
    with pytest.raises(ValueError):
        model.predict(test)
    model.fit(train, QUICK_GRIDS[kind], cv=3)
    row = model.evaluate(test).first()
    floor = 0.9 if kind in ("elastic_net", "mlp") else 0.4
    assert row["r2"] > floor, (kind, row["r2"])
    assert row["rmse"] >= 0 and row["mae"] >= 0
    assert row["n_samples"] == 26 and row["n_features"] == 5
    assert 0 <= row["f_pvalue"] <= 1
    assert row["overfitting_gap"] == pytest.approx(row["train_score"] - row["cv_score"])
    assert row["has_overfitting"] == (row["overfitting_gap"] > 0.1)
    assert model.cv_results().count() == len(expand_grid(QUICK_GRIDS[kind]))

    # a missing feature gives a null prediction, the row stays
    holes = test.withColumn("f0", F.when(F.col("entity") != "e00", F.col("f0")))
    scored = model.predict(holes)
    assert scored.count() == 26
    assert scored.where(F.col("y_pred").isNull()).count() == 2

    path = str(tmp_path / kind)
    model.save_model(spark, path)
    again = PanelRegressor(kind, spec).load_model(spark, path)
    keys = ["entity", "period"]
    a = model.predict(test).select(*keys, "y_pred").toPandas().sort_values(keys)["y_pred"]
    b = again.predict(test).select(*keys, "y_pred").toPandas().sort_values(keys)["y_pred"]
    assert np.allclose(a, b)


def test_missing_model_raises(spark, regression):
    with pytest.raises(FileNotFoundError):
        PanelRegressor("knn", regression[2]).load_model(spark, "/tmp/no-such-model")


def test_importances_and_coefficients(spark, regression):
    train, _, spec, _ = regression
    forest = fit_regressor("random_forest", train, spec, {"n_estimators": 20, "max_depth": 6})
    rows = forest.importances(spark).collect()
    assert {rows[0]["feature"], rows[1]["feature"]} == {"f0", "f1"}
    assert sum(r["importance"] for r in rows) == pytest.approx(1.0)
    net_ = fit_regressor("elastic_net", train, spec, {"alpha": 0.01, "l1_ratio": 0.5})
    assert [r["feature"] for r in net_.coefficients(spark).limit(2).collect()] == ["f0", "f1"]
    with pytest.raises(ValueError):
        net_.importances(spark)


@pytest.mark.parametrize("alpha, ratio", [(0.1, 0.5), (0.01, 0.9), (0.5, 0.1), (0.1, 0.0)])
def test_elastic_net_objective(regression, alpha, ratio):
    """Coordinate descent on the usual objective gives the same coefficients."""
    train, _, spec, _ = regression
    fitted = fit_regressor("elastic_net", train, spec, {"alpha": alpha, "l1_ratio": ratio})
    got = np.array(fitted.line.coefficients)
    pdf = train.toPandas()
    x = pdf[list(spec.features)].to_numpy()
    z = (x - x.mean(0)) / x.std(0)
    y = pdf["y"].to_numpy() - pdf["y"].mean()
    b = np.zeros(5)
    for _ in range(3000):
        for j in range(5):
            rho = z[:, j] @ (y - z @ b + z[:, j] * b[j]) / len(y)
            b[j] = np.sign(rho) * max(abs(rho) - alpha * ratio, 0) / (1 + alpha * (1 - ratio))
    assert np.allclose(got, b, atol=1e-5)


def brute_neighbours(q, p, dims, k, metric):
    out = {}
    pk = p.sort_values(["entity", "period"])
    for r in q.itertuples():
        gap = np.abs(pk[dims].to_numpy() - np.array([getattr(r, d) for d in dims]))
        d = gap.sum(1) if metric == "manhattan" else np.sqrt((gap**2).sum(1))
        order = np.argsort(np.round(d, 9), kind="stable")[:k]
        out[(r.entity, r.period)] = list(
            zip(pk["entity"].iloc[order], pk["period"].iloc[order], np.round(d[order], 9))
        )
    return out


@pytest.mark.parametrize("metric", ["euclidean", "manhattan"])
@pytest.mark.parametrize("shard", [None, 12])
def test_neighbours_are_exact(spark, monkeypatch, metric, shard):
    from panelkit.models import knn

    monkeypatch.setattr(knn, "LEAF", 20)
    monkeypatch.setattr(knn, "QUERY_CHUNK", 30)
    rng = np.random.default_rng(5)
    n = 600
    pdf = pd.DataFrame({
        "entity": [f"e{i % 40:02d}" for i in range(n)], "period": [i // 40 for i in range(n)],
        "a": rng.normal(size=n).round(1), "b": rng.normal(size=n).round(1), "y": rng.normal(size=n),
    })
    pdf.loc[pdf.index % 3 == 0, ["a", "b"]] = [0.5, -0.5]  # a third of the points coincide
    df = spark.createDataFrame(pdf)
    points, queries = df.where("period < 12"), df.where("period >= 10")
    got = nearest_neighbours(queries, points, ["entity", "period"], ["a", "b"], "y", 7, metric, shard)
    found = {}
    for r in got.orderBy("q_entity", "q_period", "rank").collect():
        found.setdefault((r["q_entity"], r["q_period"]), []).append(
            (r["p_entity"], r["p_period"], r["distance"])
        )
    want = brute_neighbours(
        pdf[pdf["period"] >= 10], pdf[pdf["period"] < 12], ["a", "b"], 7, metric
    )
    assert found == want


@pytest.mark.parametrize("weights", ["uniform", "distance"])
def test_knn_predict(regression, weights):
    train, test, spec, pdf = regression
    got = knn_predict(train, test, spec, 4, weights).toPandas().set_index(["entity", "period"])["y_pred"]
    dims = list(spec.features)
    tr = pdf[pdf["period"] < 2008].sort_values(["entity", "period"])
    mean, std = tr[dims].mean(), tr[dims].std(ddof=0)
    z, y = ((tr[dims] - mean) / std).to_numpy(), tr["y"].to_numpy()
    for r in pdf[pdf["period"] >= 2008].itertuples():
        q = ((pd.Series({d: getattr(r, d) for d in dims}) - mean) / std).to_numpy()
        d = np.sqrt(((z - q) ** 2).sum(1))
        near = np.argsort(d, kind="stable")[:4]
        w = np.ones(4) if weights == "uniform" else 1 / d[near]
        assert got[(r.entity, r.period)] == pytest.approx((w * y[near]).sum() / w.sum(), rel=1e-6)


def test_contiguous_folds(regression):
    train, _, spec, pdf = regression
    out = folds.contiguous_folds(train, spec, 5).toPandas().sort_values(["entity", "period"])
    n = len(out)
    sizes = [n // 5 + (i < n % 5) for i in range(5)]
    assert out["fold"].tolist() == [f for f, s in enumerate(sizes) for _ in range(s)]
    assert folds.fold_bounds(7, 3) == [(0, 3), (3, 5), (5, 7)]


def test_folds_refuse_null_keys(spark):
    df = spark.createDataFrame([("a", 1), ("a", 2), (None, 3)], "entity string, period int")
    with pytest.raises(Exception, match="not null"):
        folds.ordered_folds(df, ["entity", "period"], 2).collect()


def test_other_folds(regression):
    train, _, spec, _ = regression
    mixed = folds.shuffled_folds(train, spec, 4, seed=1).toPandas()
    assert sorted(mixed.groupby("fold").size()) == [26, 26, 26, 26]
    again = folds.shuffled_folds(train, spec, 4, seed=1).toPandas()
    key = ["entity", "period"]
    assert mixed.sort_values(key)["fold"].tolist() == again.sort_values(key)["fold"].tolist()
    by_entity = folds.entity_folds(train, spec, 3).groupBy("entity").agg(F.countDistinct("fold").alias("n"))
    assert by_entity.agg(F.max("n")).first()[0] == 1
    by_time = folds.time_folds(train, spec, 4).groupBy("period").agg(F.countDistinct("fold").alias("n"))
    assert by_time.agg(F.max("n")).first()[0] == 1


def test_zscores(regression):
    train, _, spec, _ = regression
    z = ZScores.of(train, spec.features).apply(train).toPandas()[list(spec.features)]
    assert np.allclose(z.mean(), 0) and np.allclose(z.std(ddof=0), 1)


def test_network_gradient():
    rng = np.random.default_rng(0)
    x, y = rng.normal(size=(20, 3)), rng.normal(size=20)
    config = net.NetConfig(hidden=(4, 3), activation="tanh", l2=0.1, mapping=net.FeatureMap(dims=3))

    def loss(w):
        fit = 0.5 * np.mean((net.forward(w, x, config)[-1][:, 0] - y) ** 2)
        return fit + 0.05 * sum((layer**2).sum() for layer, _ in net._unpack(w, config.sizes))

    w = net.initial_weights(config)
    numeric = np.array([
        (loss(w + h) - loss(w - h)) / 2e-6 for h in np.eye(len(w)) * 1e-6
    ])
    assert np.allclose(net.gradient(w, x, y, config), numeric, atol=1e-6)


def test_feature_maps_match_their_kernels():
    rng = np.random.default_rng(0)
    z = rng.normal(size=(6, 3))
    poly = net.FeatureMap("poly", 3)(z)
    assert np.allclose(poly @ poly.T, (z @ z.T / 3) ** 3)
    rbf = net.FeatureMap("rbf", 3, components=20_000)(z)
    sq = ((z[:, None] - z[None]) ** 2).sum(-1)
    assert np.allclose(rbf @ rbf.T, np.exp(-sq / 3), atol=0.05)


def test_grid_and_random_search(regression):
    train, _, spec, _ = regression
    found = grid_search("elastic_net", train, spec, {"alpha": [0.001, 5.0], "l1_ratio": [0.5]}, k=3)
    assert found.best_params["alpha"] == 0.001
    assert found.fold_table().count() == 6
    assert found.train_score >= found.cv_score > 0.9
    drawn = random_search("knn", train, spec, n_trials=3, k=3)
    assert len(drawn.candidates) == 3 and drawn.model is not None


def clustered(spark, n=4000, d=10):
    rng = np.random.default_rng(9)
    x = rng.normal(size=(40, d))[rng.integers(0, 40, n)] * 8 + rng.normal(size=(n, d)) * 0.3
    pdf = pd.DataFrame(x, columns=[f"f{i}" for i in range(d)])
    pdf.insert(0, "entity", np.arange(n) % 50)
    pdf.insert(1, "period", np.arange(n) // 50)
    pdf["y"] = rng.normal(size=n)
    return pdf, spark.createDataFrame(pdf)


def test_ten_features_meet_few_shards(spark):
    """The distance found in the home shard spares queries most other shards."""
    from panelkit.models.knn import NeighbourIndex

    pdf, df = clustered(spark)
    dims = [f"f{i}" for i in range(10)]
    index = NeighbourIndex.build(df, ["entity", "period"], dims, "y", 5, shard=400)
    assert len(index.counts) >= 10 and index.counts.sum() == 4000 and index.counts.max() <= 400
    queries = df.where("period % 4 = 0")
    q = index._named(queries)
    homes = index._routed(q, 5, "euclidean")
    assert homes.count() == q.count()
    first = index._met(homes, 5, "euclidean")
    reach = first.groupBy("q_entity", "q_period").agg(F.max("distance").alias("_reach"))
    assert index._routed(q.join(reach, ["q_entity", "q_period"]), 5, "euclidean").count() < 4 * q.count()
    want = brute_neighbours(queries.toPandas(), pdf, dims, 5, "euclidean")
    got = {}
    for r in index.nearest(queries, 5).orderBy("q_entity", "q_period", "rank").collect():
        got.setdefault((r.q_entity, r.q_period), []).append((r.p_entity, r.p_period, r.distance))
    assert got == want


def test_an_index_serves_many_queries(spark):
    from panelkit.models.knn import NeighbourIndex

    _, df = clustered(spark, 500, 3)
    index = NeighbourIndex.build(df, ["entity", "period"], ["f0", "f1", "f2"], "y", 6)
    plain = lambda rows: sorted(map(tuple, rows.collect()))
    one = plain(index.nearest(df, 4))
    sent = index.sent
    assert plain(index.nearest(df, 4)) == one and index.sent is sent
    assert plain(index.nearest(df.repartition(7), 4)) == one
    assert len(plain(index.nearest(df.where("entity < 3"), 6, "manhattan"))) == 6 * 30
    with pytest.raises(ValueError):
        index.nearest(df, 7)


def test_moments_merge_and_score():
    rng = np.random.default_rng(1)
    x = rng.normal(size=(90, 3)) * [1, 50, 1e-3] + [0, 1e6, 5]
    y = x @ [1.0, 0.02, 300.0] + rng.normal(size=90)
    data = np.column_stack([x, y])

    def of(rows):
        return linear.Moments(len(rows), rows.mean(axis=0), np.cov(rows.T, bias=True)) if len(rows) else linear.Moments.none(4)

    parts = {f: of(data[f::3]) for f in range(3)}
    whole = linear.total([*parts.values(), of(data[:0])], 4)
    assert whole.n == 90 and np.allclose(whole.cov, of(data).cov, rtol=1e-9) and np.allclose(whole.mean, data.mean(axis=0))
    candidates = [{"alpha": a, "l1_ratio": s} for a in (0.5, 0.01, 0.0) for s in (0.2, 1.0)]
    for candidate, fold, train, held in linear.fold_scores(("a", "b", "c"), parts, candidates):
        rest = np.concatenate([data[f::3] for f in range(3) if f != fold])
        fit = linear.fit_paths(("a", "b", "c"), of(rest), [candidates[candidate]])[0]
        z = (rest[:, :3] - rest[:, :3].mean(axis=0)) / rest[:, :3].std(axis=0)
        b, alpha, share = np.zeros(3), candidates[candidate]["alpha"], candidates[candidate]["l1_ratio"]
        for _ in range(2000):
            for j in range(3):
                rho = z[:, j] @ (rest[:, 3] - rest[:, 3].mean() - z @ b + z[:, j] * b[j]) / len(z)
                b[j] = np.sign(rho) * max(abs(rho) - alpha * share, 0) / (1 + alpha * (1 - share))
        assert np.allclose(fit.coefficients, b, atol=1e-7)
        for rows, got in ((rest, train), (data[fold::3], held)):
            p = rest[:, 3].mean() + (rows[:, :3] - rest[:, :3].mean(axis=0)) / rest[:, :3].std(axis=0) @ b
            assert got == pytest.approx(1 - ((rows[:, 3] - p) ** 2).sum() / (rows[:, 3].var() * len(rows)), abs=1e-9)


def test_linear_search_scans_once(regression, monkeypatch):
    train, _, spec, _ = regression
    calls = []
    plain = linear.moments_by
    monkeypatch.setattr(linear, "moments_by", lambda *a: calls.append(1) or plain(*a))
    found = random_search("elastic_net", train, spec, n_trials=100, k=5)
    assert len(found.scores) == 500 and calls == [1] and found.model is not None


def test_linear_odd_columns(spark):
    """A constant feature keeps the coefficient 0, a missing one gives no prediction."""
    spec = PanelSpec(target="y", features=("a", "b"))
    rows = [("e", t, float(t), 7.0, 2.0 * t + 1) for t in range(20)] + [("e", 99, None, 7.0, 1.0)]
    df = spark.createDataFrame(rows, "entity string, period int, a double, b double, y double")
    fitted = fit_regressor("elastic_net", df, spec, {"alpha": 1e-9, "l1_ratio": 0.5})
    assert fitted.line.coefficients[1] == 0
    got = {r.period: r.y_pred for r in fitted.predict(df).collect()}
    assert got[99] is None and got[3] == pytest.approx(7.0)
    with pytest.raises(ValueError):
        fit_regressor("elastic_net", df.limit(0), spec, {})


def test_curves(regression):
    train, _, spec, _ = regression
    curve = learning_curve({"elastic_net": {"alpha": 0.01}}, train, spec, k=3).toPandas()
    assert sorted(curve["train_size"]) == [13, 27, 41, 55, 69]
    assert curve.sort_values("share")["cv_mean"].iloc[-1] > 0.9
    scores = cv_scores({"elastic_net": {"alpha": 0.01}}, train, spec, k=3)
    local = scores.toPandas()["cv_score"]
    row = cv_comparison(scores).first()
    assert row["cv_mean"] == pytest.approx(local.mean())
    assert row["cv_std"] == pytest.approx(local.std(ddof=0))


def test_train_all_reports_failures(regression):
    train, test, spec, _ = regression
    grids = {**QUICK_GRIDS, "svr": {"kernel": ["nonsense"]}}
    run = train_all(train, test, spec, ("elastic_net", "svr"), grids, cv=2)
    assert list(run.models) == ["elastic_net"] and "svr" in run.failures
    assert run.predictions.count() == 26
    assert run.metrics.first()["time"] > 0


def test_trained_models_search_the_full_grids(spark, regression, monkeypatch):
    """Every regressor is searched with its full grid on five folds, over all rows it is given."""
    from panelkit.models import training
    from panelkit.plans import catalog

    train, test, spec, _ = regression
    searched = {}

    def spy(kind, rows, spec, grid, k, **options):
        searched[kind] = (grid, k, rows.count())
        found = grid_search("elastic_net", rows, spec, {"alpha": [0.1]}, k=2)
        found.kind = kind
        return found

    monkeypatch.setattr(training, "grid_search", spy)
    monkeypatch.setattr(catalog, "_split_customers", lambda *_: (train, test))
    monkeypatch.setattr(catalog, "CY", spec)
    assert catalog.QUERIES["trained_models"](spark, "").count() == 7
    assert searched == {kind: (GRIDS[kind], 5, train.count()) for kind in NAMES}


@pytest.mark.parametrize("kind, params", [
    ("gradient_boosting", {"n_estimators": 5, "max_depth": 3, "learning_rate": 0.2, "min_samples_leaf": 20}),
    ("mlp", {"hidden_layer_sizes": (8,), "max_iter": 25}),
    ("svr", {"C": 10, "kernel": "rbf", "rounds": 3}),
])
def test_fits_inside_tasks_score_as_sparks_jobs(spark, monkeypatch, kind, params):
    """Without random rows both ways give the same scores; neither fits a candidate twice."""
    from panelkit.models import local, search

    rng, n = np.random.default_rng(8), 900
    pdf = pd.DataFrame({"entity": [f"e{i // 9}" for i in range(n)], "period": [i % 9 for i in range(n)],
                        "a": rng.normal(size=n), "b": rng.normal(size=n).round(1), "c": rng.integers(0, 5, n)})
    pdf["y"] = 5 + np.sin(pdf["a"]) + pdf["b"] * pdf["c"] + rng.normal(scale=0.3, size=n)
    train, spec = spark.createDataFrame(pdf), PanelSpec(target="y", features=("a", "b", "c"))
    fits = []
    plain = search.fit_regressor
    monkeypatch.setattr(search, "fit_regressor", lambda *a: fits.append(1) or plain(*a))
    # gamma and the penalty of boosted leaves have no effect here
    candidates = [{**params, "gamma": "scale", "reg_alpha": 0} if kind == "svr" else {**params, "reg_alpha": a} for a in (0, 1)]
    inside = search.cross_validate(kind, train, spec, candidates, k=2, refit=False).scores
    assert not fits
    monkeypatch.setattr(local, "MOST_BYTES", 0)
    jobs = search.cross_validate(kind, train, spec, candidates, k=2, refit=False).scores
    assert len(fits) == 2 and [r[:2] for r in inside] == [r[:2] for r in jobs] == [(0, 0), (0, 1), (1, 0), (1, 1)]
    assert np.allclose(np.array(inside, dtype=float), np.array(jobs, dtype=float), atol=1e-8)


def test_full_grids_hold_fewer_fits():
    from panelkit.models import local

    def counted(features):
        kinds = ("random_forest", "xgboost", "gradient_boosting", "svr", "mlp")
        return {k: len(local.alike(k, expand_grid(GRIDS[k]), features)) for k in kinds}

    assert counted(4) == {"random_forest": 48, "xgboost": 24, "gradient_boosting": 162, "svr": 24, "mlp": 48}
    assert counted(5) == {"random_forest": 48, "xgboost": 48, "gradient_boosting": 162, "svr": 24, "mlp": 48}
    same = local.alike("svr", expand_grid(GRIDS["svr"]), 4)
    assert sorted(i for mine in same.values() for i in mine) == list(range(48))


def test_trees_grown_together_are_those_grown_alone(monkeypatch):
    from panelkit.models import trees

    rng = np.random.default_rng(0)
    x = np.column_stack([rng.normal(size=400), rng.integers(0, 4, 400), np.zeros(400)])
    y, train = x[:, 0] * x[:, 1] + rng.normal(size=400) + 50, np.arange(400) % 4 > 0
    cells = trees.Cells.build(x, y, train, 32)
    shared = {"least": 2, "gain": 0.0, "subset": 2}
    members = [(0, 3, 2), (1, 8, 2), (2, 3, 9), (3, 8, 9)]
    together = sorted(trees.forest_scores(cells, shared, members, (1, 0)))
    assert together == [trees.forest_scores(cells, shared, [m], (1, 0))[0] for m in members]
    assert together[3][1] > together[1][1] > 0
    monkeypatch.setattr(trees, "NODES", 3)
    assert together == sorted(trees.forest_scores(cells, shared, members, (1, 0)))
    shared = {"rate": 0.8, "depth": 3, "gain": 0.0, "subset": 3}
    members = [(0, 4, 0.1, 1), (1, 9, 0.1, 1), (2, 9, 0.3, 1), (3, 9, 0.3, 5)]
    together = sorted(trees.boosted_scores(cells, shared, members, (1, 0)))
    alone = [trees.boosted_scores(cells, shared, [m], (1, 0))[0] for m in members]
    assert np.allclose(np.array(together), np.array(alone)) and together[2][1] > together[0][1]

    # cells stand for their rows: the scores are those of the rows
    tree = trees.grow(cells, *(lambda n, t: (n, t[None]))(*cells.weighted(np.ones(300))), [3], 1, 0.0, 3, rng)[0][0]
    row = np.empty(400)
    row[train] = tree[cells.of]
    error = ((y[train] - cells.mean - row[train]) ** 2).sum()
    assert cells.scores(tree)[0] == pytest.approx(1 - error / (y[train].var() * 300))


@pytest.mark.parametrize("n, decimals", [(20, 3), (500, 9), (5000, 1), (5000, 2)])
def test_borders_of_bins(n, decimals):
    """Quantile borders by the walk over the sorted values that Spark does."""
    from panelkit.models import trees

    values = np.random.default_rng(n).normal(size=n).round(decimals)
    known, counts = np.unique(values, return_counts=True)
    wanted, stride, upto = [], n / min(32, n), counts[0]
    target = stride
    for i in range(1, len(known)):
        before, upto = upto, upto + counts[i]
        if abs(before - target) < abs(upto - target):
            wanted.append((known[i - 1] + known[i]) / 2)
            target += stride
    if len(known) <= min(32, n):
        wanted = (known[1:] + known[:-1]) / 2
    assert np.allclose(trees.thresholds(values, 32), wanted) and len(wanted) <= 31


def test_neighbours_among_many_points_take_few_comparisons(spark, monkeypatch):
    """Imputed panels put many points on a few values: a query still meets few of them."""
    from panelkit.models import knn

    rng = np.random.default_rng(3)
    x = rng.normal(size=(40_300, 4))
    x[:, 0] = np.minimum(rng.geometric(0.6, len(x)), 8) * 1.5
    x[:, 1] = rng.choice([-0.6, 0.6, 1.8], len(x), p=[0.6, 0.2, 0.2])
    x[rng.random(len(x)) < 0.6, 2] = 0.1
    x[rng.random(len(x)) < 0.6, 3] = 0.2
    points, queries = x[:40_000], x[40_000:]
    compared = []
    plain = knn.distances

    def counted(a, b, metric):
        compared.append(len(a) * len(b))
        return plain(a, b, metric)

    monkeypatch.setattr(knn, "distances", counted)
    row, at, value = knn.Leaves(points, 5).nearest(queries, 5, "euclidean")
    assert sum(compared) <= 12 * knn.LEAF * len(queries)
    every = np.round(plain(queries, points, "euclidean"), knn.DECIMALS)
    want = np.argsort(every, axis=1, kind="stable")[:, :5]
    assert np.array_equal(at.astype(int).reshape(-1, 5), want)
    assert np.array_equal(value.reshape(-1, 5), np.take_along_axis(every, want, axis=1))


def test_training_steps_map_no_rows(monkeypatch):
    """The width of the feature map is known without drawing its frequencies anew in every step."""
    from dataclasses import replace

    from panelkit.models import net

    maps = [net.FeatureMap(kind, dims) for kind in ("identity", "rbf", "poly") for dims in (1, 2, 4, 7)]
    assert [m.width for m in maps] == [m(np.zeros((1, m.dims))).shape[1] for m in maps]
    rng = np.random.default_rng(0)
    config = net.svr_config({"kernel": "rbf"}, 500, 4)
    x, y = config.mapping(rng.normal(size=(500, 4))), rng.normal(size=500)
    flat = net.initial_weights(config)

    def mapped(self, z):
        raise AssertionError("a step mapped rows")

    monkeypatch.setattr(net.FeatureMap, "__call__", mapped)
    assert net.local_steps(flat, x, y, replace(config, local_epochs=1), 5).shape == flat.shape
