"""Two-way fixed effects and diagnostics against dense numpy least squares."""

import math
import time

import numpy as np
import pandas as pd
import pytest

from panelkit.econ.diagnostics import (
    ar1_table, breusch_pagan_statistics, diagnostics, diagnostics_table, hausman, random_effects,
)
from panelkit.econ.dynamic import DynamicPanel, persistence
from panelkit.econ.within import PeriodSystem, fit_two_way, tridiagonal_solve
from panelkit.functions import dist
from panelkit.spec import PanelSpec

SPEC = PanelSpec(target="y", features=("x1", "x2"), period_bounds=(0, 100))


def make(noise, drop=()):
    rng = np.random.default_rng(3)
    rows = []
    for i in range(9):
        for t in range(6):
            x1, x2 = rng.normal() + 0.3 * i, 100 * rng.normal() + t
            y = 2.0 * x1 - 0.01 * x2 + i + 0.5 * t * t + noise * rng.normal()
            if (i, t) not in drop:
                rows.append((f"e{i}", t, float(y), float(x1), float(x2)))
    return pd.DataFrame(rows, columns=["entity", "period", "y", "x1", "x2"])


DROPS = [(), ((0, 0), (3, 2), (3, 3), (7, 5))]


def to_spark(spark, pdf):
    rows = [tuple(r) for r in pdf.itertuples(index=False)]
    return spark.createDataFrame(rows, "entity string, period int, y double, x1 double, x2 double")


def dense(pdf, k=2):
    """Slopes, clustered covariance and residuals with explicit dummies."""
    e = pd.get_dummies(pdf["entity"]).to_numpy(float)
    t = pd.get_dummies(pdf["period"]).to_numpy(float)[:, 1:]
    d = np.hstack([e, t])
    x, y = pdf[["x1", "x2"]].to_numpy(), pdf["y"].to_numpy()
    m = np.eye(len(y)) - d @ np.linalg.pinv(d)
    xr, yr = m @ x, m @ y
    bread = np.linalg.inv(xr.T @ xr)
    b = bread @ xr.T @ yr
    r = yr - xr @ b
    meat = np.zeros((k, k))
    for name in pdf["entity"].unique():
        s = (xr * r[:, None])[pdf["entity"] == name].sum(axis=0)
        meat += np.outer(s, s)
    n, df = len(y), len(y) - k - d.shape[1]
    return b, n / df * bread @ meat @ bread, r, bread * (r @ r) / df, df


@pytest.mark.parametrize("drop", DROPS, ids=["balanced", "unbalanced"])
def test_slopes_and_clustered_errors(spark, drop):
    pdf = make(0.5, drop)
    fit = fit_two_way(to_spark(spark, pdf), SPEC)
    b, cov, resid, plain, df = dense(pdf)
    assert np.allclose(fit.beta, b, rtol=1e-6)
    assert np.allclose(fit.cov, cov, rtol=1e-5)
    assert np.allclose(fit.cov_unadjusted, plain, rtol=1e-5)
    assert fit.df_resid == df
    got = fit.residuals().toPandas().sort_values(["entity", "period"])["e"].to_numpy()
    assert np.allclose(got, resid, atol=1e-6)
    table = {r["term"]: r for r in fit.coefficients().collect()}
    assert table["x1"]["std_error"] == pytest.approx(math.sqrt(cov[0, 0]), rel=1e-5)
    assert 0 <= table["x1"]["p_value"] <= 1


def chained(places, seed=8):
    """A row for each (entity, period), y from both effects and two regressors."""
    rng = np.random.default_rng(seed)
    rows = []
    for e, t in places:
        x1, x2 = rng.normal() + 0.01 * t, 10 * rng.normal()
        rows.append((f"e{e}", int(t), 2.0 * x1 - 0.3 * x2 + math.sin(e) + 0.1 * t + 0.2 * rng.normal(), x1, x2))
    return pd.DataFrame(rows, columns=["entity", "period", "y", "x1", "x2"])


def absorbed(pdf):
    """Slopes with both effects as dummies, by least squares of small norm."""
    e, t = (pd.get_dummies(pdf[c]).to_numpy(float) for c in ("entity", "period"))
    a = np.hstack([pdf[["x1", "x2"]].to_numpy(), e, t])
    return np.linalg.lstsq(a, pdf["y"].to_numpy(), rcond=1e-12)[0][:2]


def test_chain_of_entities(spark):
    """Entities that overlap with the next one only: sweeping means out in turn would take a hundred thousand rounds."""
    pdf = chained([(i, i + d) for i in range(600) for d in (0, 1, 2)])
    start = time.perf_counter()
    fit = fit_two_way(to_spark(spark, pdf), SPEC)
    assert time.perf_counter() - start < 30
    assert np.allclose(fit.beta, absorbed(pdf), atol=1e-8)
    assert fit.n_periods == 602


@pytest.mark.parametrize("places", [
    [(i, t) for i, (a, b) in enumerate(zip(np.random.default_rng(1).permutation(60), np.random.default_rng(2).permutation(60))) for t in {a, b, (a + 7) % 60}],
    [(i, t) for i in range(12) for t in (range(0, 5) if i < 6 else range(20, 26))],
    [(i, t) for i in range(40) for t in np.random.default_rng(i).choice(300, 12, replace=False)],
], ids=["shuffled", "two parts", "random"])
def test_sparse_panels(spark, places):
    pdf = chained(places)
    fit = fit_two_way(to_spark(spark, pdf), SPEC)
    assert np.allclose(fit.beta, absorbed(pdf), atol=1e-8)


def test_steps_are_few(spark, monkeypatch):
    """A panel of many periods takes tens of products, not one for each period."""
    calls = []
    plain = PeriodSystem.times
    monkeypatch.setattr(PeriodSystem, "times", lambda self, v: calls.append(len(v)) or plain(self, v))
    places = [(i, t) for i in range(400) for t in np.random.default_rng(i).choice(1500, 15, replace=False)]
    pdf = chained(places)
    fit = fit_two_way(to_spark(spark, pdf), SPEC)
    assert np.allclose(fit.beta, absorbed(pdf), atol=1e-8)
    assert 0 < len(calls) < 80 and calls[0] > 1400


@pytest.mark.parametrize("size", [1, 2, 3, 17, 64, 1000])
def test_tridiagonal_systems(size):
    rng = np.random.default_rng(size)
    beside = -rng.uniform(0, 1, max(size - 1, 0)) * (rng.uniform(size=max(size - 1, 0)) > 0.1)
    diagonal = 0.01 + np.append(-beside, 0) + np.append(0, -beside)
    right = rng.normal(size=(size, 3))
    full = np.diag(diagonal) + np.diag(beside, 1) + np.diag(beside, -1)
    assert np.allclose(tridiagonal_solve(diagonal, beside, right), np.linalg.solve(full, right), rtol=1e-8)


@pytest.mark.parametrize("drop", DROPS, ids=["balanced", "unbalanced"])
def test_exact_recovery_without_noise(spark, drop):
    fit = fit_two_way(to_spark(spark, make(0.0, drop)), SPEC)
    assert np.allclose(fit.beta, [2.0, -0.01], atol=1e-9)
    assert fit.rss == pytest.approx(0.0, abs=1e-8)


def test_r_squared(spark):
    pdf = make(0.5, DROPS[1])
    fit = fit_two_way(to_spark(spark, pdf), SPEC)
    b = dense(pdf)[0]
    cols = ["y", "x1", "x2"]
    means = pdf.groupby("entity")[cols].mean()
    dev = pdf[cols] - pdf.groupby("entity")[cols].transform("mean")

    def share(f):
        left = f["y"] - f[["x1", "x2"]] @ b
        return 1 - (left**2).sum() / (f["y"] ** 2).sum()

    assert fit.r2_within == pytest.approx(share(dev))
    assert fit.r2_between == pytest.approx(share(means))
    assert fit.r2_overall == pytest.approx(share(pdf[cols]))


def test_random_effects_and_hausman(spark):
    pdf = make(0.5, DROPS[1])
    fit = fit_two_way(to_spark(spark, pdf), SPEC)
    re = random_effects(fit)
    cols = ["y", "x1", "x2"]
    g = pdf.groupby("entity")[cols]
    n_i = pdf.groupby("entity").size()
    dev = pdf[cols] - g.transform("mean")
    means = g.mean()

    def ssr(f):
        b = np.linalg.lstsq(f[["x1", "x2"]], f["y"], rcond=None)[0]
        return ((f["y"] - f[["x1", "x2"]] @ b) ** 2).sum()

    n, k, groups = len(pdf), 2, len(n_i)
    s_e = ssr(dev) / (n - k - groups + 1)
    s_u = max(0, ssr(means) / (groups - k) - s_e / (groups / (1 / n_i).sum()))
    theta = 1 - np.sqrt(s_e / (n_i * s_u + s_e))
    quasi = pdf[cols] - g.transform("mean").mul(pdf["entity"].map(theta), axis=0)
    b = np.linalg.lstsq(quasi[["x1", "x2"]], quasi["y"], rcond=None)[0]
    assert re.sigma2_e == pytest.approx(s_e)
    assert re.sigma2_u == pytest.approx(s_u)
    assert np.allclose(re.beta, b)
    result = hausman(fit, re)
    d = fit.beta - re.beta
    assert result["statistic"] == pytest.approx(d @ np.linalg.inv(fit.cov_unadjusted - re.cov) @ d)
    assert result["df"] == 2


def test_ar1_against_pandas(spark):
    pdf = make(0.5, DROPS[1])
    fit = fit_two_way(to_spark(spark, pdf), SPEC)
    e = fit.residuals().toPandas().sort_values(["entity", "period"])
    e["l"] = e.groupby("entity")["e"].shift(1)
    e = e.dropna()
    rho = (e["e"] * e["l"]).sum() / (e["l"] ** 2).sum()
    se = math.sqrt(((e["e"] - rho * e["l"]) ** 2).sum() / (len(e) - 1) / (e["l"] ** 2).sum())
    row = ar1_table(fit.residuals(), SPEC).first()
    assert (row["rho"], row["std_error"], row["n"]) == pytest.approx((rho, se, len(e)))


def test_breusch_pagan_against_numpy(spark):
    pdf = make(0.5)
    fit = fit_two_way(to_spark(spark, pdf), SPEC)
    rows = fit.sample.join(fit.residuals(), ["entity", "period"])
    out = breusch_pagan_statistics(rows, ["x1", "x2"])
    local = rows.toPandas()
    e2 = local["e"] ** 2
    x = np.column_stack([np.ones(len(local)), local["x1"], local["x2"]])
    fitted = x @ np.linalg.lstsq(x, e2, rcond=None)[0]
    r2 = 1 - ((e2 - fitted) ** 2).sum() / ((e2 - e2.mean()) ** 2).sum()
    assert out["lm_stat"] == pytest.approx(len(local) * r2)
    assert out["f_stat"] == pytest.approx((r2 / 2) / ((1 - r2) / (len(local) - 3)))


def test_dynamic_panel(spark, panel):
    df, spec, pdf = panel
    model = DynamicPanel(df, spec).load().split(train_end=2015)
    model.fit(lags=1, use_train_only=True)
    assert model.fit_.n_periods == 15 and model.fit_.n_obs == 300
    scores = model.evaluate_on_test().first()
    assert scores["n_test"] == 80  # the first test year keeps its lag
    assert scores["rmse"] == pytest.approx(math.sqrt(scores["mse"]))
    with_effects = model.evaluate_on_test("entity").first()
    assert with_effects["r2"] > scores["r2"]
    p = model.persistence().first()
    assert 0 < p["rho"] < 1 and p["half_life"] == pytest.approx(-math.log(2) / math.log(p["rho"]))
    assert p["interpretation"] in ("STRONG", "MODERATE", "WEAK")
    tests = model.diagnostics()
    assert set(tests) == {"hausman", "autocorrelation", "heteroscedasticity"}
    for t in tests.values():
        assert 0 <= t["p_value"] <= 1
    assert -1 <= tests["autocorrelation"]["rho"] <= 1
    assert model.diagnostics_table().count() == 3
    assert model.summary().first()["n_entities"] == 20
    inside = DynamicPanel(df, spec, lag_within_split=True).split(train_end=2015).fit(use_train_only=True)
    assert inside.evaluate_on_test().first()["n_test"] == 60


def test_unfitted_raises(panel):
    df, spec, _ = panel
    with pytest.raises(RuntimeError):
        DynamicPanel(df, spec).persistence()


def test_persistence_labels(spark):
    rows = [("a", 0.9, 0.01), ("b", 0.5, 0.2), ("c", 0.1, 0.01), ("d", -0.2, 0.01), ("e", 1.2, 0.0)]
    table = spark.createDataFrame(rows, "term string, coefficient double, p_value double")
    got = {t: persistence(table, t).first() for t in "abcde"}
    assert [got[t]["interpretation"] for t in "abcde"] == [
        "STRONG", "MODERATE", "WEAK", "NONE", "EXPLOSIVE",
    ]
    assert got["d"]["half_life"] is None and got["e"]["half_life"] is None
    assert [got[t]["significant"] for t in "ab"] == [True, False]


def test_one_failing_test_spares_the_others(spark):
    pdf = make(0.5)
    pdf = pdf[pdf["entity"].isin(["e0", "e1"])]  # too few entities for random effects
    fit = fit_two_way(to_spark(spark, pdf), SPEC)
    out = diagnostics(fit)
    assert "error" in out["hausman"] and "p_value" in out["autocorrelation"]
    errors = {r["test"]: r["error"] for r in diagnostics_table(fit).collect()}
    assert errors["hausman"] and errors["heteroscedasticity"] is None


@pytest.mark.parametrize(
    "got, want",
    [
        # closed forms
        (dist.f_sf(3.0, 2, 10), 1.6**-5),
        (dist.t_two_sided(1.0, 1), 0.5),
        (dist.t_two_sided(-2.0, 2), 1 - 2 / math.sqrt(6)),
        (dist.chi2_sf(10.0, 2), math.exp(-5)),
        (dist.chi2_sf(0.5, 4), math.exp(-0.25) * 1.25),
        (dist.chi2_sf(3.841459, 1), math.erfc(math.sqrt(3.841459 / 2))),
        (dist.f_sf(float("inf"), 3, 9), 0.0),
    ],
)
def test_tail_probabilities(got, want):
    assert got == pytest.approx(want, abs=1e-12)


def test_tail_probabilities_by_integration():
    x = np.linspace(2.5, 400, 2_000_001)
    d1, d2 = 4, 7
    logc = math.lgamma((d1 + d2) / 2) - math.lgamma(d1 / 2) - math.lgamma(d2 / 2)
    pdf = np.exp(logc + d1 / 2 * math.log(d1 / d2) + (d1 / 2 - 1) * np.log(x)
                 - (d1 + d2) / 2 * np.log1p(d1 / d2 * x))
    assert dist.f_sf(2.5, d1, d2) == pytest.approx(np.trapezoid(pdf, x), abs=1e-4)
