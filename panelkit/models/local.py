"""Scores of many candidates and folds, fitted inside tasks where the rows fit into one.

The complete rows are sent once to all tasks, at most ``MOST_BYTES`` of them; a task then fits one family of
candidates on one fold without a job per step. More rows than that are fitted by Spark's jobs.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, replace
from functools import partial

import numpy as np
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelkit.models import net, trees
from panelkit.models.regressors import SEED, boosted_settings, forest_settings
from panelkit.runtime import cached
from panelkit.spec import PanelSpec

#: Bytes of rows that every Python worker may hold beside its own.
MOST_BYTES = 128_000_000

Score = tuple[int, int, float | None, float | None]


@dataclass
class Rows:
    """Complete rows as ``net.laid_out`` places them, with their partition."""

    x: np.ndarray
    y: np.ndarray
    fold: np.ndarray
    part: np.ndarray
    held: dict[int, np.ndarray]


def fits(data: DataFrame, spec: PanelSpec) -> bool:
    """Whether the rows may be sent to every task."""
    return data.count() * 8 * (len(spec.features) + 3) <= MOST_BYTES


def gathered(data: DataFrame, spec: PanelSpec, seeds: Sequence[int] = ()) -> Rows:
    """The rows, with the held-out ones of each seed."""
    wanted = [F.col(c).cast("double").alias(f"x{i}") for i, c in enumerate(spec.features)]
    wanted += [F.col(spec.target).cast("double").alias("y"), "fold"]
    wanted += [net.held_out(s, spec.keys).alias(f"h{s}") for s in seeds]
    placed = net.laid_out(data.select(*spec.keys, *wanted), spec.keys)
    with cached(placed.drop(*spec.keys).withColumn("part", F.spark_partition_id())) as kept:
        table = kept.toArrow()

    def column(name: str) -> np.ndarray:
        return table[name].to_numpy()

    x = np.column_stack([column(f"x{i}") for i in range(len(spec.features))])
    return Rows(x, column("y"), column("fold"), column("part"), {s: column(f"h{s}") for s in seeds})


def effective(kind: str, params: dict, rows: int, features: int) -> dict | net.NetConfig:
    """What a fit is made from; candidates that are equal here are the same fit."""
    if kind == "mlp":
        return net.mlp_config(params)
    if kind == "svr":
        return net.svr_config(params, rows, features)
    settings = forest_settings(params) if kind == "random_forest" else boosted_settings(params)
    return {**settings, "featureSubsetStrategy": trees.subset_size(settings["featureSubsetStrategy"], features)}


def alike(kind: str, candidates: Sequence[dict], features: int) -> dict[int, list[int]]:
    """The first candidate of every distinct fit, with all candidates that are the same."""
    first: dict[str, int] = {}
    out: dict[int, list[int]] = {}
    for i, params in enumerate(candidates):
        out.setdefault(first.setdefault(repr(effective(kind, params, 1, features)), i), []).append(i)
    return out


def scores(kind: str, data: DataFrame, spec: PanelSpec, candidates: Sequence[dict]) -> list[Score]:
    """(candidate, fold, train R2, held-out R2) of every candidate on every fold, from one job."""
    features = len(spec.features)
    same = alike(kind, candidates, features)
    seeds = {effective(kind, candidates[i], 1, features).seed for i in same} if kind in ("mlp", "svr") else ()
    rows = gathered(data, spec, sorted(seeds))
    tasks: list[tuple] = []
    for fold in map(int, np.unique(rows.fold)):
        n = int((rows.fold != fold).sum())
        if not n:
            raise ValueError("no complete rows to fit on")
        made = {i: effective(kind, candidates[i], n, features) for i in same}
        if kind in ("mlp", "svr"):
            tasks += [(len(net.initial_weights(_wide(c, features))), fold, c, [i]) for i, c in made.items()]
        else:
            tasks += [(cost, fold, family, members) for cost, family, members in _families(kind, made)]
    if not tasks:
        return []
    tasks.sort(key=lambda t: -t[0])  # the longest first, so that none is waited for at the end
    context = data.sparkSession.sparkContext
    sent = context.broadcast(rows)
    try:
        found = context.parallelize(tasks, len(tasks)).flatMap(partial(_fit, kind, sent)).collect()
    finally:
        sent.unpersist()
    return [(c, fold, a, b) for i, fold, a, b in found for c in same[i]]


def _wide(config: net.NetConfig, features: int) -> net.NetConfig:
    return replace(config, mapping=replace(config.mapping, dims=features))


def _families(kind: str, made: dict[int, dict]) -> list[tuple[int, dict, list[tuple]]]:
    """(cost, what is shared, members) of the fits that grow together, see ``trees``."""
    groups: dict[tuple, list[tuple]] = {}
    for i, s in made.items():
        own = {"gain": s["minInfoGain"], "subset": s["featureSubsetStrategy"], "bins": s["maxBins"]}
        if kind == "random_forest":
            own["least"], member = s["minInstancesPerNode"], (i, s["numTrees"], s["maxDepth"])
        else:
            own |= {"rate": s["subsamplingRate"], "depth": s["maxDepth"]}
            member = (i, s["maxIter"], s["stepSize"], s["minInstancesPerNode"])
        groups.setdefault(tuple(own.items()), []).append(member)
    return [(dict(own).get("depth", -dict(own).get("least", 0)), dict(own), members) for own, members in groups.items()]


def _fit(kind: str, sent: Broadcast, task: tuple) -> list[Score]:
    _, fold, shared, members = task
    rows: Rows = sent.value
    train = rows.fold != fold
    if kind in ("mlp", "svr"):
        fitted = net.fit_rows(rows.x[train], rows.y[train], rows.held[shared.seed][train], rows.part[train], shared)
        predicted = fitted.predict_rows(rows.x)
        return [(members[0], fold, _r2(rows.y[train], predicted[train]), _r2(rows.y[~train], predicted[~train]))]
    cells = trees.Cells.build(rows.x, rows.y, train, shared["bins"])
    grown = trees.forest_scores if kind == "random_forest" else trees.boosted_scores
    return [(c, fold, a, b) for c, a, b in grown(cells, shared, members, (SEED, fold))]


def _r2(actual: np.ndarray, predicted: np.ndarray) -> float | None:
    if not len(actual):
        return None
    error, spread = float(((actual - predicted) ** 2).sum()), float(((actual - actual.mean()) ** 2).sum())
    return 1 - error / spread if spread else float(error == 0)
