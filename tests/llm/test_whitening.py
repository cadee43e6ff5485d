"""Whitening against numpy and exact integers, on the small tables and on odd rows."""

from fractions import Fraction

import duckdb
import numpy as np
import pytest

from panelkit.llm import whitening
from panelkit.llm.queries import QUERIES

FOLDER = "/root/testdata/sf0.01"
SCHEMA = "vec_id long, embedding array<float>, label int, x string, `a.b` long, i long"


def orthonormal(rng, d):
    q = np.linalg.qr(rng.normal(size=(d, d)))[0].astype(np.longdouble)
    for _ in range(4):
        q = q @ (1.5 * np.eye(d, dtype=np.longdouble) - 0.5 * (q.T @ q))
    return q


def by_hand(vectors):
    """n, S, covariance of the distinct rounded vectors by numpy."""
    x = np.unique(np.floor(64 * np.array(vectors, float)).astype(np.int64) + 1_000_000, axis=0)
    s = x.sum(axis=0)
    c = (x - s // len(x)) - (s % len(x)) / len(x)
    return len(x), s, c.T @ c / len(x)


def held(rows, vectors):
    """The rows of the query hold for ``vectors`` (id -> entries)."""
    n, s, cov = by_hand(list(vectors.values()))
    value, vector = np.linalg.eigh(cov)
    value, vector = value[::-1], vector[:, ::-1]
    most = min(16, int((value > value[0] * 1e-12).sum()))
    assert len(rows) == most * len(vectors)
    by_component = {}
    for r in rows:
        x = [int(np.floor(64 * float(c))) + 1_000_000 for c in vectors[r.vec_id]]
        assert (r.n, r.deviation) == (n, sum((n * v - int(t)) ** 2 for v, t in zip(x, s)))
        assert abs(r.explained - value[r.component - 1] / np.trace(cov)) < 1e-12
        assert 0 <= r.identity_error < 1e-9
        z = float(np.dot([float(Fraction(n * v - int(t), n)) for v, t in zip(x, s)], vector[:, r.component - 1])) / np.sqrt(value[r.component - 1])
        by_component.setdefault(r.component, []).append((r.whitened, z))
    assert sorted(by_component) == list(range(1, most + 1))
    for pairs in by_component.values():
        got, want = np.array(pairs).T
        assert min(np.abs(got - want).max(), np.abs(got + want).max()) < 1e-8


def test_query_on_whole_table(spark):
    rows = QUERIES["op11_whitening"](spark, FOLDER).collect()
    table = duckdb.sql(f"select vec_id, embedding from '{FOLDER}/embeddings.parquet'").fetchall()
    held(rows, dict(table))


@pytest.mark.parametrize("values", [
    np.concatenate([3 + np.arange(20) * 1e-9, 1 + np.arange(20) * 1e-11, np.linspace(0, 0.5, 24)]),
    np.repeat([3.0, 2.0, 1.0], 10),
    np.concatenate([np.linspace(1, 2, 10), np.zeros(30)]),
])
def test_clusters_of_eigenvalues(values):
    q = orthonormal(np.random.default_rng(3), len(values))
    a = (q * values.astype(np.longdouble)) @ q.T
    got, x = whitening.eigen((a + a.T) / 2)
    x = x.astype(np.longdouble)
    assert np.abs(got - np.sort(values)[::-1]).max() < 1e-15
    assert np.abs(x.T @ x - np.eye(len(values))).max() < 4e-15
    assert np.abs(a @ x - x * got).max() < 4e-15
    single, _ = np.linalg.eigh(a.astype(np.float32))
    assert np.abs(np.sort(single)[::-1] - got).max() > 1e-9  # the first guess was far off


def test_refinement_tells_close_vectors_apart():
    values = np.concatenate([1 + np.arange(10) * 1e-9, [5.0, 7.0]])
    q = orthonormal(np.random.default_rng(5), len(values))
    a = (q * values.astype(np.longdouble)) @ q.T
    _, x = whitening.eigen((a + a.T) / 2)
    same = np.abs(q[:, np.argsort(-values)].T @ x.astype(np.longdouble))
    assert np.abs(same - np.eye(len(values))).max() < 1e-8


@pytest.mark.parametrize("bound", [100, 2**30, 2**45])
def test_products_and_sums_are_exact(bound):
    c = np.random.default_rng(1).integers(-bound, bound, (5000, 4))
    whole = c.astype(object)
    assert (whitening.products(c) == whole.T @ whole).all()
    assert (whitening.whole_sums(c) == whole.sum(axis=0)).all()
    assert whitening.squares(c) == (whole * whole).sum(axis=1).tolist()


def test_odd_rows(spark):
    rng = np.random.default_rng(2)
    good = {k: [float(v) for v in rng.normal(size=3).astype(np.float32)] for k in range(20)}
    good[20] = good[3]
    rows = [(k, v, None, "s", k, None) for k, v in good.items()]
    odd = [(90, None, 1, None, 1, 1), (91, [1.0, None, 2.0], 1, "s", None, 1), (92, [float("nan"), 1.0, 1.0], 1, "s", 1, 1), (93, [1.0, float("inf"), 1.0], 1, "s", 1, 1)]
    held(whitening.components(spark.createDataFrame(rows + odd, SCHEMA), "vec_id", "embedding").collect(), good)
    again = whitening.components(spark.createDataFrame(rows * 2 + [(None, good[1], 1, None, 1, 1)] + odd, SCHEMA), "vec_id", "embedding")
    ids = [r.vec_id for r in again.where("component = 1").collect()]
    assert len(ids) == 43 and ids.count(None) == 1 and ids.count(20) == 2


@pytest.mark.parametrize("rows", [[], [(1, None)], [(1, [])], [(1, [1.0, 2.0])], [(1, [1.0, 2.0]), (2, [1.0, 2.0])]])
def test_nothing_to_whiten(spark, rows):
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    assert whitening.components(df, "vec_id", "embedding").count() == 0
    assert len(whitening.components(df, "vec_id", "embedding").columns) == 7


def test_two_vectors_have_one_component(spark):
    df = spark.createDataFrame([(1, [0.0, 0.0]), (2, [1.0, 1.0])], "vec_id long, embedding array<float>")
    rows = {r.vec_id: r for r in whitening.components(df, "vec_id", "embedding").collect()}
    assert sorted(rows) == [1, 2] and rows[1].explained == pytest.approx(1)
    assert sorted(round(r.whitened, 9) for r in rows.values()) == [-1, 1]


def test_huge_entries_and_lengths(spark):
    far = spark.createDataFrame([(1, [1e9, 0.0]), (2, [-1e9, 1.0]), (3, [5e8, 2.0])], "vec_id long, embedding array<double>")
    held(_ints(whitening, far), {1: [1e9, 0.0], 2: [-1e9, 1.0], 3: [5e8, 2.0]})
    with pytest.raises(ValueError):
        whitening.fit(spark.createDataFrame([(1, [1.0]), (2, [1.0, 2.0])], "vec_id long, embedding array<float>"), "embedding")


def _ints(module, df):
    """Rows with the deviation as whole decimals, where longs do not hold it."""
    from types import SimpleNamespace

    found = module.fit(df, "embedding")
    return [
        SimpleNamespace(vec_id=r.vec_id, component=k + 1, n=found.n, deviation=int(r.deviation), whitened=z, explained=found.explained[k], identity_error=found.identity_error)
        for r in module.whiten(df, "vec_id", "embedding", found).collect() for k, z in enumerate(r.whitened)
    ]


def test_reruns_agree(spark):
    df = spark.read.parquet(f"{FOLDER}/embeddings.parquet")
    a, b = whitening.fit(df, "embedding"), whitening.fit(df.repartition(5), "embedding")
    assert a.sums == b.sums and (a.vectors == b.vectors).all() and (a.values == b.values).all()
