"""Forests and boosted trees of many candidates, grown inside one task for their scores.

The rules are those of Spark's learners: 32 bins a feature between quantiles, variance as
impurity, Poisson weights for the trees of a forest, rows kept at random and residuals doubled for boosting.
Rows that fall into the same bins of all features always move together, so counts and sums per
such cell stand for them; the random weights are still drawn row by row.

Candidates share what is the same for them. A tree cut at a depth is the tree grown to that depth,
the first trees of a forest are a smaller forest, and the first rounds of boosting a shorter one.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np

#: Cells times models that grow together.
TOGETHER = 1_000_000
#: Nodes whose splits are compared at a time.
NODES = 20_000
#: Gains below this share of a node's sum of squares are rounding.
NOISE = 1e-12


def subset_size(strategy: str, features: int) -> int:
    """Features that a node may split on, as Spark counts them."""
    if strategy == "all":
        return features
    if strategy == "sqrt":
        return math.ceil(math.sqrt(features))
    if strategy == "log2":
        return max(1, math.ceil(math.log2(features)))
    if strategy == "onethird":
        return math.ceil(features / 3)
    size = float(strategy)
    return min(int(size), features) if size > 1 or strategy == "1" else math.ceil(size * features)


def thresholds(values: np.ndarray, bins: int) -> np.ndarray:
    """Borders between at most ``bins`` bins of like size, midway between two values."""
    known, counts = np.unique(values, return_counts=True)
    middle = (known[:-1] + known[1:]) / 2
    if len(middle) <= min(bins, len(values)) - 1:
        return middle
    stride = len(values) / min(bins, len(values))
    upto, found, target, at = np.cumsum(counts), [], stride, 1
    while at < len(known):
        at = max(at, int(np.searchsorted(upto, target)))
        if at < len(known) and abs(upto[at - 1] - target) >= abs(upto[at] - target):
            at += 1
        if at < len(known):
            found.append(middle[at - 1])
        target += stride
        at += 1
    return np.array(found)


@dataclass
class Cells:
    """Rows by the bins of their features; borders come from the training rows only."""

    bins: np.ndarray  # features x cells
    sizes: list[int]
    of: np.ndarray  # cell of every training row
    y: np.ndarray  # their targets, less ``mean``
    mean: float
    sides: list[tuple[np.ndarray, np.ndarray, float, float] | None]

    @classmethod
    def build(cls, x: np.ndarray, y: np.ndarray, train: np.ndarray, bins: int) -> "Cells":
        code, coded, sizes = np.zeros(len(x), dtype="int64"), [], []
        for j in range(x.shape[1]):
            edges = thresholds(x[train, j], bins)
            coded.append(np.searchsorted(edges, x[:, j]).astype("int16"))
            sizes.append(len(edges) + 1)
            code = np.unique(code * sizes[-1] + coded[-1], return_inverse=True)[1]
        _, first, cell = np.unique(code, return_index=True, return_inverse=True)
        mean = float(y[train].mean())
        sides = []
        for mask in (train, ~train):
            own, value = cell[mask], y[mask] - mean
            n = np.bincount(own, minlength=len(first)).astype("float64")
            center = np.bincount(own, value, len(first)) / np.maximum(n, 1)
            inside = float(((value - center[own]) ** 2).sum())
            spread = float(((value - value.mean()) ** 2).sum()) if len(value) else 0.0
            sides.append((n, center, inside, spread) if len(value) else None)
        return cls(np.stack([c[first] for c in coded]), sizes, cell[train], y[train] - mean, mean, sides)

    def weighted(self, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rows and sum of their targets per cell, with a weight for each row."""
        cells = self.bins.shape[1]
        return np.bincount(self.of, weights, cells), np.bincount(self.of, weights * self.y, cells)

    def scores(self, predicted: np.ndarray) -> tuple[float | None, float | None]:
        """R2 of a prediction per cell on the training and on the held-out rows."""
        out = []
        for side in self.sides:
            if side is None:
                out.append(None)
                continue
            n, center, inside, spread = side
            error = inside + float(n @ (center - predicted) ** 2)
            out.append(1 - error / spread if spread else float(error == 0))
        return out[0], out[1]


def grow(
    cells: Cells, counts: np.ndarray, sums: np.ndarray, depths: Sequence[int], least: int,
    gain: float, subset: int, rng: np.random.Generator,
) -> list[np.ndarray]:
    """One tree for every row of ``sums`` (models x cells): its prediction per cell at each of the depths."""
    models, width = sums.shape
    features = len(cells.sizes)
    value, out = np.zeros(models * width), []
    at, node = np.arange(models * width), np.repeat(np.arange(models), width)
    cell, w, s, k = np.tile(np.arange(width), models), np.tile(counts, models), sums.ravel(), models
    for level in range(depths[-1] + 1):
        n, total = np.bincount(node, w, k), np.bincount(node, s, k)
        value[at] = (total / np.maximum(n, 1))[node]
        if level in depths:
            out.append(value.reshape(models, width).copy())
        if not k or level == depths[-1]:
            break
        best, feature, cut = np.full(k, -np.inf), np.zeros(k, dtype="int64"), np.zeros(k, dtype="int64")
        open_ = rng.random((k, features)).argsort(axis=1) < subset if subset < features else None
        for low in range(0, k, NODES):
            block = slice(low, low + NODES)
            mine = (node >= low) & (node < low + NODES) if k > NODES else slice(None)
            best[block], feature[block], cut[block] = _splits(
                cells, node[mine] - low, cell[mine], w[mine], s[mine], n[block], total[block], least,
                open_ if open_ is None else open_[block],
            )
        won = best - total * total / np.maximum(n, 1)
        grows = (won > NOISE * np.abs(best)) & (won / np.maximum(n, 1) >= gain)
        keep = grows[node]
        at, cell, w, s, node = at[keep], cell[keep], w[keep], s[keep], node[keep]
        child = 2 * (np.cumsum(grows) - 1)
        node = child[node] + (cells.bins[feature[node], cell] > cut[node])
        k = 2 * int(grows.sum())
    out += [value.reshape(models, width)] * (len(depths) - len(out))
    return out


def _splits(
    cells: Cells, node: np.ndarray, cell: np.ndarray, w: np.ndarray, s: np.ndarray, n: np.ndarray,
    total: np.ndarray, least: int, open_: np.ndarray | None,
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Best split of every node: sum of squares it explains, feature, last bin to the left."""
    k = len(n)
    best, feature, cut = np.full(k, -np.inf), np.zeros(k, dtype="int64"), np.zeros(k, dtype="int64")
    for j, size in enumerate(cells.sizes):
        if size < 2:
            continue
        key = node * size + cells.bins[j][cell]
        left_n = np.bincount(key, w, k * size).reshape(k, size).cumsum(axis=1)[:, :-1]
        left = np.bincount(key, s, k * size).reshape(k, size).cumsum(axis=1)[:, :-1]
        right_n, right = n[:, None] - left_n, total[:, None] - left
        score = left * left / np.maximum(left_n, 1) + right * right / np.maximum(right_n, 1)
        score[(left_n < least) | (right_n < least)] = -np.inf
        if open_ is not None:
            score[~open_[:, j]] = -np.inf
        most = score.argmax(axis=1)
        found = score[np.arange(k), most]
        better = found > best
        best[better], feature[better], cut[better] = found[better], j, most[better]
    return best, feature, cut


def forest_scores(cells: Cells, settings: dict, members: Sequence[tuple[int, int, int]], seed: Sequence[int]) -> list:
    """(candidate, train R2, held-out R2) of the members (candidate, trees, depth) of one family."""
    depths = sorted({depth for _, _, depth in members})
    sums = [np.zeros(cells.bins.shape[1]) for _ in depths]
    out = []
    for tree in range(1, max(trees for _, trees, _ in members) + 1):
        rng = np.random.default_rng([*seed, tree])
        counts, totals = cells.weighted(rng.poisson(1.0, len(cells.y)).astype("float64"))
        grown = grow(cells, counts, totals[None], depths, settings["least"], settings["gain"], settings["subset"], rng)
        for i, value in enumerate(grown):
            sums[i] += value[0]
        out += [(c, *cells.scores(sums[depths.index(d)] / tree)) for c, trees, d in members if trees == tree]
    return out


def boosted_scores(cells: Cells, settings: dict, members: Sequence[tuple[int, int, float, int]], seed: Sequence[int]) -> list:
    """The same for members (candidate, rounds, step, least rows of a child) that share all else."""
    kinds = sorted({(step, least) for _, _, step, least in members})
    # models with the same least rows grow together as far as their cells allow
    width, lots = cells.bins.shape[1], []
    for least in sorted({k[1] for k in kinds}):
        same, many = [k for k in kinds if k[1] == least], max(1, TOGETHER // width)
        lots += [same[i : i + many] for i in range(0, len(same), many)]
    out = []
    for lot in lots:
        mine = [m for m in members if (m[2], m[3]) in lot]
        step = np.array([k[0] for k in lot])[:, None]
        total = np.zeros((len(lot), width))
        for number in range(1, max(m[1] for m in mine) + 1):
            rng = np.random.default_rng([*seed, number])
            if settings["rate"] < 1 or number == 1:
                counts, sums = cells.weighted((rng.random(len(cells.y)) < settings["rate"]).astype("float64"))
            # the first tree is fitted to the targets, the others to the doubled residuals
            labels = np.repeat(sums[None], len(lot), axis=0) if number == 1 else 2 * (sums - counts * total)
            tree = grow(
                cells, counts, labels, [settings["depth"]], lot[0][1], settings["gain"], settings["subset"], rng
            )[0]
            total = tree if number == 1 else total + step * tree
            for c, rounds, rate, least in mine:
                if rounds == number:
                    out.append((c, *cells.scores(total[lot.index((rate, least))])))
    return out
