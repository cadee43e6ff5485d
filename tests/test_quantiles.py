"""Radix selection against numpy."""

import numpy as np
import pytest
from hypothesis import given
from hypothesis import strategies as st

from panelkit.operators import quantiles

PROBS = [0.0, 0.1, 0.25, 0.5, 0.75, 0.9, 1.0]


def by_numpy(values):
    return {p: float(np.quantile(np.array(values, float), p)) for p in PROBS}


@given(st.lists(st.floats(allow_nan=False), min_size=1))
def test_keys_keep_the_order(values):
    x = np.array(values)
    keys = quantiles.ordered_keys(x)
    assert (quantiles.doubles(keys) == x).all()
    assert (x[np.argsort(keys, kind="stable")] == np.sort(x)).all()
    assert quantiles.ordered_keys(np.array([0.0, -0.0, np.nan])).tolist() == [1 << 63, 1 << 63, max(quantiles.ordered_keys(np.array([np.inf, np.nan])).tolist())]


@pytest.fixture(scope="module")
def wide(spark):
    rng = np.random.default_rng(6)
    n = 5000
    columns = {
        "plain": rng.normal(size=n).tolist(),
        "tied": rng.integers(-3, 3, n).astype(float).tolist(),
        "wild": (rng.normal(size=n) * 10.0 ** rng.integers(-300, 300, n)).tolist(),
        "gaps": [None if k % 3 else float(k) for k in range(n)],
        "one": [7.5] * n,
        "close": (1 + rng.integers(0, 50, n) * 2.0**-52).tolist(),
        "none": [None] * n,
        "a.b": [float(k % 10) for k in range(n)],
    }
    rows = list(zip(*columns.values()))
    schema = ", ".join(f"`{c}` double" for c in columns)
    return spark.createDataFrame(rows, schema).repartition(7), columns


@pytest.mark.parametrize("fetched", [0, 50, 100_000], ids=["all bits", "some scans", "fetched"])
def test_quantiles(wide, monkeypatch, fetched):
    df, columns = wide
    monkeypatch.setattr(quantiles, "FETCHED", fetched)
    got = quantiles.column_quantiles(df, list(columns), PROBS)
    assert set(got) == set(columns) - {"none"}
    for c in got:
        want = by_numpy([v for v in columns[c] if v is not None])
        for p in PROBS:
            assert got[c][p] == pytest.approx(want[p], rel=1e-14, abs=0), (c, p)


def test_few_rows(spark):
    df = spark.createDataFrame([(1, 2.0), (None, -1.0), (3, None)], "a int, b double")
    assert quantiles.column_quantiles(df, ["a", "b"], [0.5]) == {"a": {0.5: 2.0}, "b": {0.5: 0.5}}
    assert quantiles.column_quantiles(df.limit(0), ["a"], [0.5]) == {}
    assert quantiles.column_quantiles(df.where("a = 3"), ["a", "b"], [0.25]) == {"a": {0.25: 3.0}}


def test_scans_are_few_and_move_no_rows(wide, monkeypatch):
    df, columns = wide
    calls = []
    plain = quantiles._counted

    def counted(rows, active, depth, whole):
        out = plain(rows, active, depth, whole)
        calls.append((depth, whole, sum(len(k) for k, _ in out.values())))
        return out

    monkeypatch.setattr(quantiles, "_counted", counted)
    quantiles.column_quantiles(df, list(columns), [0.5])
    assert [c[:2] for c in calls] == [(0, False), (16, True)]
    calls.clear()
    monkeypatch.setattr(quantiles, "FETCHED", 0)
    quantiles.column_quantiles(df, ["plain"], [0.5])
    assert [c[0] for c in calls] == [0, 16, 32, 48] and all(n < 5000 for *_, n in calls)
