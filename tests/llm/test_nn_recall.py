"""Recall of the vector search where links are sparse: brute force over all pairs, and the audit's own figure."""

import logging
import re

import numpy as np
import pytest

from panelkit.llm import nn_descent


def with_pairs(n, d, pairs, shared, near, seed):
    """Vectors with cosine about ``shared`` to each other, some of them near copies of others."""
    rng = np.random.default_rng(seed)
    middle = rng.normal(size=d)
    middle /= np.linalg.norm(middle)
    x = rng.normal(size=(n, d)) / np.sqrt(d)
    x = np.sqrt(shared) * middle + np.sqrt(1 - shared) * x
    noise = rng.normal(size=(pairs, d)) / np.sqrt(d)
    length = np.linalg.norm(x[:pairs], axis=1, keepdims=True)
    x[n - pairs :] = near * x[:pairs] + np.sqrt(1 - near**2) * noise * length
    return x.astype(np.float32)


def true_links(x):
    y = x.astype(float) / np.linalg.norm(x.astype(float), axis=1, keepdims=True)
    out = np.zeros(len(y), int)
    for at in range(0, len(y), 2000):
        out[at : at + 2000] = (y[at : at + 2000] @ y.T >= 0.93).sum(axis=1) - 1
    return out


@pytest.mark.parametrize("n, shared, near", [(20_000, 0.7, 0.9335), (30_000, 0.0, 0.935)], ids=["common direction", "none"])
def test_sparse_pairs_are_found_and_the_audit_says_so(spark, caplog, n, shared, near):
    x = with_pairs(n, 96, 1000, shared, near, 12)
    df = spark.createDataFrame([(i, v.tolist(), 1) for i, v in enumerate(x)], "vec_id long, embedding array<float>, label int").repartition(8)
    want = true_links(x)
    assert 500 < want.sum() < 4000
    with caplog.at_level(logging.INFO, logger=nn_descent.log.name):
        got = {r.vec_id: r.n_links for r in nn_descent.near_duplicates(df).collect()}
    found = np.array([got[i] for i in range(n)])
    assert (found <= want).all()
    share = (found[want > 0] / want[want > 0]).mean()
    told = re.findall(r"mean recall ([0-9.]+), standard error ([0-9.]+)", caplog.text)
    assert share >= 0.97, (share, told)
    assert abs(float(told[-1][0]) - share) <= 0.02 + 2 * float(told[-1][1])
