"""Ordered building blocks against pandas, with tiny chunks to force the split path."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from panelkit.operators import impute, temporal
from panelkit.operators.ordered import exact_quantiles, quantile_columns, rows_at, running_total
from panelkit.spec import PanelSpec

FREE = PanelSpec(features=("v",))
BOUNDED = PanelSpec(features=("v",), period_bounds=(1900, 2100))


@pytest.fixture(scope="module")
def gappy(spark):
    rng = np.random.default_rng(1)
    rows = []
    for e in range(12):
        for p in sorted(rng.choice(np.arange(1900, 2000), size=rng.integers(1, 70), replace=False)):
            value = None if rng.random() < 0.4 else float(np.round(rng.normal(), 3))
            rows.append((f"e{e}", int(p), value))
    # one hot entity with a third of the rows
    for p in range(1900, 2050):
        rows.append(("hot", p, None if p % 3 == 0 else float(p % 17)))
    df = spark.createDataFrame(rows, "entity string, period int, v double").repartition(8)
    return df, pd.DataFrame(rows, columns=["entity", "period", "v"])


def rows_of(df, *cols):
    return sorted(
        [tuple(None if x is None else x for x in r) for r in df.select(*cols).collect()],
        key=lambda t: t[:2],
    )


def test_running_total(spark):
    n = 5000
    df = spark.range(n).withColumn("g", F.col("id") % 7).repartition(8)
    out = running_total(df, ["g", "id"], F.lit(1), "pos").toPandas().sort_values(["g", "id"])
    assert out["pos"].tolist() == list(range(n))


@pytest.mark.parametrize("probs", [[0.5], [0.0, 0.25, 0.5, 0.75, 1.0]])
def test_exact_quantiles(gappy, probs):
    df, pdf = gappy
    got = {(r["entity"], r["prob"]): r["quantile"] for r in exact_quantiles(df, ["entity"], "v", probs).collect()}
    want = pdf.dropna().groupby("entity")["v"].quantile(probs)
    assert len(got) == len(want)
    for key, value in want.items():
        assert got[key] == pytest.approx(value)


def test_quantiles_of_everything(gappy):
    df, pdf = gappy
    row = quantile_columns(df, [], "v", {"m": 0.5, "hi": 0.9}).first()
    assert row["m"] == pytest.approx(pdf["v"].median())
    assert row["hi"] == pytest.approx(pdf["v"].quantile(0.9))


@pytest.mark.parametrize("lags", [1, 3])
@pytest.mark.parametrize("spec", [FREE, BOUNDED], ids=["chunked", "bounded"])
def test_lag(gappy, lags, spec):
    df, pdf = gappy
    got = rows_of(temporal.add_lag(df, spec, "v", lags, chunk=8), "entity", "period", f"v_lag{lags}")
    p = pdf.sort_values(["entity", "period"]).reset_index(drop=True)
    p["lag"] = p.groupby("entity")["v"].shift(lags)
    want = [(e, t, None if pd.isna(x) else x) for e, t, x in p[["entity", "period", "lag"]].itertuples(index=False)]
    assert got == want


def test_gap_aware_lag(gappy):
    df, pdf = gappy
    got = rows_of(temporal.add_lag(df, FREE, "v", 1, gap_aware=True, chunk=8), "entity", "period", "v_lag1")
    known = {(e, t): x for e, t, x in pdf.itertuples(index=False)}
    for e, t, x in got:
        before = known.get((e, t - 1))
        assert x == (None if before is None or pd.isna(before) else before)


@pytest.mark.parametrize("spec", [FREE, BOUNDED], ids=["chunked", "bounded"])
def test_forward_fill(gappy, spec):
    df, pdf = gappy
    got = rows_of(impute.forward_fill(df, spec, chunk=8), "entity", "period", "v")
    p = pdf.sort_values(["entity", "period"]).reset_index(drop=True)
    p["f"] = p.groupby("entity")["v"].ffill()
    want = [(e, t, None if pd.isna(x) else x) for e, t, x in p[["entity", "period", "f"]].itertuples(index=False)]
    assert got == want


def brute_imputed(pdf):
    overall = pdf["v"].median()
    out = []
    for e, t, x in pdf.sort_values(["entity", "period"]).itertuples(index=False):
        stage = 0
        if pd.isna(x):
            mine = pdf[(pdf["entity"] == e) & pdf["v"].notna()]
            for stage, r in enumerate((1, 2, 4), start=1):
                near = mine[(mine["period"] - t).abs() <= r]["v"]
                if len(near) >= 2:
                    x = near.median()
                    break
            else:
                stage, x = 4, overall
        out.append((e, t, x, stage))
    return out


@pytest.mark.parametrize("spec", [FREE, BOUNDED], ids=["chunked", "bounded"])
def test_window_median(gappy, spec):
    df, pdf = gappy
    staged = impute.impute_window_median(df, spec, stages=True, chunk=8)
    got = rows_of(staged, "entity", "period", "v", "v_stage")
    want = brute_imputed(pdf)
    assert [(e, t, s) for e, t, _, s in got] == [(e, t, s) for e, t, _, s in want]
    assert np.allclose([r[2] for r in got], [r[2] for r in want])
    report = {r["stage"]: r["cells"] for r in impute.impute_report(staged, ["v"]).collect()}
    assert sum(report.values()) == len(pdf)


GAPS = [(y, None if y in (3, 4, 9) else float(y * y)) for y in range(1, 11)]


def test_modes_differ_on_gap_panel(spark):
    rows = [("a", y, v) for y, v in GAPS]
    df = spark.createDataFrame(rows, "entity string, period int, v double")
    spec = PanelSpec(features=("v",), period_bounds=(0, 100))
    observed = {r["period"]: r["v"] for r in impute.impute_window_median(df, spec).collect()}
    assert (observed[9], observed[3], observed[4]) == (82.0, 4.0, 25.0)
    serial = {r["period"]: r["v"] for r in impute.impute_sequential(df, spec).collect()}
    assert (serial[9], serial[3], serial[4]) == (82.0, 4.0, 14.5)


def test_sequential_against_a_plain_loop(gappy):
    df, pdf = gappy
    p = pdf.sort_values(["entity", "period"]).reset_index(drop=True)
    overall = p["v"].median()
    for i in np.flatnonzero(p["v"].isna()):
        for r in (1, 2, 4):
            near = p[(p["entity"] == p["entity"][i]) & ((p["period"] - p["period"][i]).abs() <= r)]
            if near["v"].count() >= 2:
                p.loc[i, "v"] = near["v"].median()
                break
        else:
            p.loc[i, "v"] = overall
    got = rows_of(impute.impute_sequential(df, BOUNDED), "entity", "period", "v")
    assert np.allclose([r[2] for r in got], p["v"]) and len(got) == len(p)


def test_rows_at(spark):
    df = spark.range(1000).select((F.col("id") % 10).alias("g"), "id").repartition(8)
    n, rows = rows_at(df, ["g", "id"], lambda n: [0, n // 2, n - 1])
    assert n == 1000
    assert [tuple(r) for r in rows] == [(0, 0), (5, 5), (9, 999)]


def test_sequential_needs_bounds(spark):
    df = spark.createDataFrame([("a", 1, 1.0)], "entity string, period int, v double")
    with pytest.raises(ValueError):
        impute.impute_sequential(df, PanelSpec(features=("v",)))


@pytest.mark.parametrize("spec", [FREE, BOUNDED], ids=["chunked", "bounded"])
def test_latest_delta(gappy, spec):
    df, pdf = gappy
    full = df.withColumn("v", F.coalesce("v", F.lit(0.0)))
    got = {r["entity"]: r for r in temporal.latest_delta(full, spec, "v", chunk=8).collect()}
    for e, g in pdf.fillna({"v": 0.0}).sort_values("period").groupby("entity"):
        last = g["v"].iloc[-1]
        prev = g["v"].iloc[-2] if len(g) > 1 else last
        assert got[e]["delta"] == pytest.approx(last - prev)
