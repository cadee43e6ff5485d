"""The elastic net from moments: one scan for any number of penalties and folds.

A set of rows counts with its number of rows, its means and its covariances. These merge,
so that the training rows of a fold are the sum of the other folds' moments. Coordinate
descent then works on covariances of the features' size, and scores on
held-out rows follow from their moments as well; no row is read again.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelkit.models.scaling import ZScores

#: Largest move of a coefficient, against the target's deviation, at which descent ends.
SETTLED = 1e-12


@dataclass(frozen=True)
class Moments:
    """Rows, means and population covariances of features and, last, target."""

    n: int
    mean: np.ndarray
    cov: np.ndarray

    def __add__(self, other: "Moments") -> "Moments":
        n = self.n + other.n
        if not self.n or not other.n:
            return self if self.n else other
        gap = other.mean - self.mean
        cov = (self.n * self.cov + other.n * other.cov) / n + np.outer(gap, gap) * (self.n * other.n / n**2)
        return Moments(n, self.mean + gap * (other.n / n), cov)

    @classmethod
    def none(cls, columns: int) -> "Moments":
        return cls(0, np.zeros(columns), np.zeros((columns, columns)))


def total(parts: Iterable[Moments], columns: int) -> Moments:
    out = Moments.none(columns)
    for part in parts:
        out = out + part
    return out


def moments_by(df: DataFrame, columns: Sequence[str], group: Column | None = None) -> dict[int, Moments]:
    """Moments of ``columns`` per value of an integer ``group``, by one scan with partial sums in every task.

    The rows must be complete. Groups are few: a fold each, or a stretch of an order.
    """
    k = len(columns)
    value = [F.col(c).cast("double") for c in columns]
    wanted = [F.count(F.lit(1)).alias("n"), *[F.avg(v).alias(f"m_{i}") for i, v in enumerate(value)]]
    wanted += [F.covar_pop(value[i], value[j]).alias(f"c_{i}_{j}") for i in range(k) for j in range(i, k)]
    rows = df.groupBy((F.lit(0) if group is None else group).alias("part")).agg(*wanted).collect()
    out = {}
    for r in rows:
        cov = np.zeros((k, k))
        for i in range(k):
            for j in range(i, k):
                cov[i, j] = cov[j, i] = r[f"c_{i}_{j}"]
        out[r["part"]] = Moments(r["n"], np.array([r[f"m_{i}"] for i in range(k)]), cov)
    return out


@dataclass(frozen=True)
class LinearFit:
    """Coefficients on z-scores, and the intercept: the target's mean."""

    scores: ZScores
    coefficients: tuple[float, ...]
    intercept: float

    def column(self) -> Column:
        """The prediction; null where a feature is."""
        terms = [F.lit(b) * self.scores.column(c) for c, b in zip(self.scores.features, self.coefficients)]
        return sum(terms, F.lit(self.intercept))

    def r2(self, rows: Moments) -> float | None:
        """R2 on rows known by their moments; null without variance."""
        if not rows.n or rows.cov[-1, -1] <= 0:
            return None
        slope = np.array(self.coefficients) / np.array(self.scores.stds)
        weight = np.append(-slope, 1.0)
        off = rows.mean[-1] - self.intercept - slope @ (rows.mean[:-1] - np.array(self.scores.means))
        return float(1 - (weight @ rows.cov @ weight + off * off) / rows.cov[-1, -1])


def _descend(gram: np.ndarray, target: np.ndarray, l1: float, l2: float, start: np.ndarray, rounds: int, settled: float) -> np.ndarray:
    """Cyclic coordinate descent with covariance updates from ``start``."""
    b = start.copy()
    slope = target - gram @ b
    for _ in range(rounds):
        most = 0.0
        for j in range(len(b)):
            own = gram[j, j]
            if own <= 0:
                continue
            pull = slope[j] + own * b[j]
            new = np.sign(pull) * max(abs(pull) - l1, 0.0) / (own + l2)
            move = new - b[j]
            if move:
                slope -= gram[:, j] * move
                b[j] = new
                most = max(most, abs(move))
        if most <= settled:
            break
    return b


def fit_paths(features: Sequence[str], rows: Moments, candidates: Sequence[Mapping]) -> list[LinearFit]:
    """The elastic net a * l * |b| + a * (1 - l) / 2 * b ** 2 on z-scores for every candidate.

    Candidates of one mixing share are a path: each starts from the next larger penalty's
    coefficients. Without an absolute part the normal equations are solved. ``max_iter`` bounds the rounds.
    """
    p = len(features)
    std = np.sqrt(np.maximum(np.diag(rows.cov), 0))
    scale = np.where(std[:p] > 0, std[:p], 1.0)
    scores = ZScores(tuple(features), tuple(map(float, rows.mean[:p])), tuple(map(float, scale)))
    gram = rows.cov[:p, :p] / np.outer(scale, scale)
    target = rows.cov[:p, p] / scale
    found: dict[int, np.ndarray] = {}
    warm: dict[float, np.ndarray] = {}
    alpha = [float(c.get("alpha", 1.0)) for c in candidates]
    for i in sorted(range(len(candidates)), key=lambda i: -alpha[i]):
        share = float(candidates[i].get("l1_ratio", 0.5))
        l1, l2 = alpha[i] * share, alpha[i] * (1 - share)
        if l1:
            rounds = int(candidates[i].get("max_iter", 10_000))
            found[i] = _descend(gram, target, l1, l2, warm.get(share, np.zeros(p)), rounds, SETTLED * max(std[p], 1e-300))
        else:
            found[i] = np.linalg.lstsq(gram + l2 * np.eye(p), target, rcond=1e-13)[0]
        warm[share] = found[i]
    return [LinearFit(scores, tuple(map(float, found[i])), float(rows.mean[p])) for i in range(len(candidates))]


def fold_scores(
    features: Sequence[str], parts: Mapping[int, Moments], candidates: Sequence[Mapping]
) -> list[tuple[int, int, float | None, float | None]]:
    """(candidate, fold, train R2, held-out R2) of every candidate on every fold, from the folds' moments."""
    out = []
    for fold, held in sorted(parts.items()):
        rest = total((m for f, m in sorted(parts.items()) if f != fold), len(features) + 1)
        for i, fit in enumerate(fit_paths(features, rest, candidates)):
            out.append((i, fold, fit.r2(rest), fit.r2(held)))
    return out
