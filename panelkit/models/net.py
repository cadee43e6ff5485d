"""Data-parallel gradient training of small networks (MLP and kernel SVR).

Every round is one Spark job. Each task starts from the shared weights, takes
Adam steps on the batches of its own partition, and the weights are averaged by
row count (local SGD, Zinkevich et al. 2010). Rows never leave their partition;
only sums as long as the weight vector do. The same job scores the incoming
weights on held-out rows for early stopping.

The kernel SVR is linear in an explicit feature map: random Fourier features
for ``rbf`` (Rahimi & Recht 2007), monomials for ``poly``.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass, field, replace
from itertools import combinations_with_replacement
from math import comb, factorial

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.storagelevel import StorageLevel

from panelkit.models.scaling import ZScores

#: Share of the rows that is held out for early stopping.
HOLDOUT = 0.1
#: Rows of a batch where the rows are at hand; Spark's Arrow batches hold as many.
BATCH = 10_000
#: What follows the weights in a round's sums: rows, held-out rows, their squared error.
TAIL = 3


@dataclass(frozen=True)
class FeatureMap:
    """Maps z-scores to the inputs of the network."""

    kind: str = "identity"
    dims: int = 0
    components: int = 128
    seed: int = 42
    degree: int = 3

    def __call__(self, z: np.ndarray) -> np.ndarray:
        if self.kind == "identity":
            return z
        gamma = 1.0 / self.dims  # z-scores have unit variance
        if self.kind == "rbf":
            rng = np.random.default_rng(self.seed)
            freq = rng.normal(0.0, np.sqrt(2 * gamma), (self.dims, self.components))
            phase = rng.uniform(0.0, 2 * np.pi, self.components)
            return np.sqrt(2.0 / self.components) * np.cos(z @ freq + phase)
        terms = list(combinations_with_replacement(range(self.dims), self.degree))
        out = np.empty((len(z), len(terms)))
        for j, term in enumerate(terms):
            ways = factorial(self.degree)
            for i in set(term):
                ways //= factorial(term.count(i))
            out[:, j] = np.sqrt(ways) * gamma ** (self.degree / 2) * z[:, term].prod(axis=1)
        return out

    @property
    def width(self) -> int:
        """Inputs of the network, without mapping a row: every training step asks for it."""
        if self.kind == "poly":
            return comb(self.dims + self.degree - 1, self.degree)
        return self.components if self.kind == "rbf" else self.dims


@dataclass(frozen=True)
class NetConfig:
    """Shape, loss and training schedule."""

    hidden: tuple[int, ...] = (50,)
    activation: str = "relu"
    l2: float = 1e-4
    learning_rate: float = 1e-2
    batch_size: int = 200
    rounds: int = 20
    local_epochs: int = 5
    patience: int = 4
    epsilon: float | None = None  # insensitive zone; None: squared loss
    seed: int = 42
    mapping: FeatureMap = field(default_factory=FeatureMap)

    @property
    def sizes(self) -> list[int]:
        return [self.mapping.width, *self.hidden, 1]


def _unpack(flat: np.ndarray, sizes: Sequence[int]) -> list[tuple[np.ndarray, np.ndarray]]:
    layers, at = [], 0
    for a, b in zip(sizes, sizes[1:]):
        w = flat[at : at + a * b].reshape(a, b)
        layers.append((w, flat[at + a * b : at + a * b + b]))
        at += a * b + b
    return layers


def initial_weights(config: NetConfig) -> np.ndarray:
    rng = np.random.default_rng(config.seed)
    parts = []
    for a, b in zip(config.sizes, config.sizes[1:]):
        bound = np.sqrt(6.0 / (a + b))
        parts += [rng.uniform(-bound, bound, a * b), np.zeros(b)]
    return np.concatenate(parts)


def forward(flat: np.ndarray, x: np.ndarray, config: NetConfig) -> list[np.ndarray]:
    """Activations of every layer; the last one holds the predictions."""
    layers = _unpack(flat, config.sizes)
    out = [x]
    for i, (w, b) in enumerate(layers):
        x = x @ w + b
        if i < len(layers) - 1:
            x = np.maximum(x, 0.0) if config.activation == "relu" else np.tanh(x)
        out.append(x)
    return out


def gradient(flat: np.ndarray, x: np.ndarray, y: np.ndarray, config: NetConfig) -> np.ndarray:
    """Gradient of the mean loss plus the L2 penalty on one batch."""
    layers = _unpack(flat, config.sizes)
    acts = forward(flat, x, config)
    error = acts[-1][:, 0] - y
    if config.epsilon is None:
        slope = error
    else:
        slope = np.sign(error) * (np.abs(error) > config.epsilon)
    delta = slope[:, None] / len(y)
    grads: list[np.ndarray] = []
    for i in range(len(layers) - 1, -1, -1):
        w, _ = layers[i]
        grads[:0] = [(acts[i].T @ delta + config.l2 * w).ravel(), delta.sum(axis=0)]
        if i:
            a = acts[i]
            delta = (delta @ w.T) * ((a > 0) if config.activation == "relu" else 1.0 - a * a)
    return np.concatenate(grads)


def local_steps(
    flat: np.ndarray, x: np.ndarray, y: np.ndarray, config: NetConfig, seed: int
) -> np.ndarray:
    """Adam on the rows of one task, starting from the shared weights."""
    rng = np.random.default_rng(seed)
    w, m, v = flat.copy(), np.zeros_like(flat), np.zeros_like(flat)
    step = 0
    for _ in range(config.local_epochs):
        order = rng.permutation(len(y))
        for start in range(0, len(y), config.batch_size):
            pick = order[start : start + config.batch_size]
            g = gradient(w, x[pick], y[pick], config)
            step += 1
            m = 0.9 * m + 0.1 * g
            v = 0.999 * v + 0.001 * g * g
            w -= config.learning_rate * (m / (1 - 0.9**step)) / (
                np.sqrt(v / (1 - 0.999**step)) + 1e-8
            )
    return w


@dataclass(frozen=True)
class NetFit:
    """Trained weights with the scaling they expect."""

    features: tuple[str, ...]
    scores: ZScores
    target_mean: float
    target_std: float
    config: NetConfig
    weights: np.ndarray
    history: tuple[float, ...]

    def predict_rows(self, x: np.ndarray) -> np.ndarray:
        """Predictions of rows at hand."""
        out = np.empty(len(x))
        for start in range(0, len(x), BATCH):
            part = slice(start, start + BATCH)
            z = (x[part] - self.scores.means) / self.scores.stds
            out[part] = forward(self.weights, self.config.mapping(z), self.config)[-1][:, 0]
        return out * self.target_std + self.target_mean

    def predict(self, df: DataFrame) -> DataFrame:
        """Add ``y_pred``; rows with a missing feature get null."""
        weights, config = self.weights, self.config
        mean, std = self.target_mean, self.target_std

        @F.pandas_udf("double")
        def score(z: pd.Series) -> pd.Series:
            known = z.map(lambda v: v is not None and all(c == c and c is not None for c in v))
            out = np.full(len(z), np.nan)
            if known.any():
                x = config.mapping(np.array(z[known].tolist(), dtype="float64"))
                out[known.to_numpy()] = forward(weights, x, config)[-1][:, 0] * std + mean
            return pd.Series(out)

        present = F.lit(True)
        for c in self.features:
            present = present & F.col(c).isNotNull()
        z = F.array(*[self.scores.column(c) for c in self.features])
        return df.withColumn("y_pred", F.nanvl(score(F.when(present, z)), F.lit(None)))


def held_out(seed: int, order: Sequence[str]) -> Column:
    """Rows that only decide when training stops."""
    return F.pmod(F.xxhash64(F.lit(seed), *order), F.lit(1000)) < int(1000 * HOLDOUT)


def laid_out(df: DataFrame, order: Sequence[str], partitions: int | None = None) -> DataFrame:
    """Rows in the partition and at the place that their key gives them."""
    spread = [F.xxhash64(*order)] if partitions is None else [partitions, F.xxhash64(*order)]
    return df.repartition(*spread).sortWithinPartitions(*order)


def fit_net(
    train: DataFrame,
    features: Sequence[str],
    target: str,
    config: NetConfig,
    order: Sequence[str],
    partitions: int | None = None,
) -> NetFit:
    """Train on the complete rows of ``train``.

    ``order`` is a key of the rows. It fixes which partition a row trains in and
    its place there, so a task that runs again takes the same steps.
    """
    features = tuple(features)
    rows = train.select(*order, target, *features).na.drop()
    scores = ZScores.of(rows, features)
    mean, std = rows.agg(F.avg(target), F.stddev_pop(target)).first()
    if mean is None:
        raise ValueError("no complete rows to train on")
    std = std or 1.0
    config = replace(config, mapping=replace(config.mapping, dims=len(features)))
    data = rows.select(
        *order,
        ((F.col(target) - mean) / std).alias("_y"),
        F.array(*[scores.column(c) for c in features]).alias("_z"),
        held_out(config.seed, order).alias("_held"),
    )
    data = laid_out(data, order, partitions).drop(*order).persist(StorageLevel.MEMORY_AND_DISK)
    size = len(initial_weights(config))

    def one_round(flat: np.ndarray, number: int):
        def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            sums = np.zeros(size + TAIL)
            task = TaskContext.get().partitionId()
            for i, batch in enumerate(batches):
                z = np.array(batch["_z"].tolist(), dtype="float64")
                y, held = batch["_y"].to_numpy(), batch["_held"].to_numpy()
                sums += batch_sums(flat, z, y, held, config, (number, task, i))
            yield pd.DataFrame({"i": np.arange(size + TAIL), "v": sums})

        cells = (
            data.mapInPandas(run, "i int, v double").groupBy("i").agg(F.sum("v").alias("v"))
        ).toPandas()
        out = np.zeros(size + TAIL)
        out[cells["i"]] = cells["v"]
        return out

    best, history = rounds_of(config, one_round)
    data.unpersist()
    return NetFit(features, scores, float(mean), float(std), config, best, history)


def fit_rows(x: np.ndarray, y: np.ndarray, held: np.ndarray, part: np.ndarray, config: NetConfig) -> NetFit:
    """As ``fit_net`` on rows at hand, laid out by ``laid_out``; ``part`` is their partition, in order."""
    means, std = x.mean(axis=0), x.std(axis=0)
    scores = ZScores(tuple(map(str, range(x.shape[1]))), tuple(means), tuple(np.where(std > 0, std, 1.0)))
    mean, scale = float(y.mean()), float(y.std()) or 1.0
    config = replace(config, mapping=replace(config.mapping, dims=x.shape[1]))
    size = len(initial_weights(config))
    tasks, starts = np.unique(part, return_index=True)
    batches = [
        (int(task), i, slice(at, min(at + BATCH, end)))
        for task, start, end in zip(tasks, starts, [*starts[1:], len(y)])
        for i, at in enumerate(range(start, end, BATCH))
    ]

    def one_round(flat: np.ndarray, number: int):
        sums = np.zeros(size + TAIL)
        for task, i, rows in batches:
            z = (x[rows] - means) / scores.stds
            sums += batch_sums(flat, z, (y[rows] - mean) / scale, held[rows], config, (number, task, i))
        return sums

    best, history = rounds_of(config, one_round)
    return NetFit(scores.features, scores, mean, scale, config, best, history)


def batch_sums(
    flat: np.ndarray, z: np.ndarray, y: np.ndarray, held: np.ndarray, config: NetConfig, place: tuple[int, ...]
) -> np.ndarray:
    """What one batch adds to a round: weights times rows, rows, held-out rows, their squared error."""
    sums = np.zeros(len(flat) + TAIL)
    x = config.mapping(z)
    if held.any():
        miss = forward(flat, x[held], config)[-1][:, 0] - y[held]
        sums[len(flat) + 1 :] += [held.sum(), miss @ miss]
    if (~held).any():
        seed = hash((config.seed, *place)) % 2**32
        n = int((~held).sum())
        sums[: len(flat)] += n * local_steps(flat, x[~held], y[~held], config, seed)
        sums[len(flat)] += n
    return sums


def rounds_of(
    config: NetConfig, one_round: Callable[[np.ndarray, int], np.ndarray]
) -> tuple[np.ndarray, tuple[float, ...]]:
    """The best weights by the held-out loss, and that loss of every round."""
    size = len(initial_weights(config))
    flat = initial_weights(config)
    best, best_loss, stale, history = flat, np.inf, 0, []
    for number in range(config.rounds + 1):
        sums = one_round(flat, number)
        held = sums[size + 1]
        loss = sums[size + 2] / held if held else -float(number)
        history.append(float(loss))
        if loss < best_loss - 1e-4 * abs(best_loss if np.isfinite(best_loss) else 0.0):
            best, best_loss, stale = flat, loss, 0
        else:
            stale += 1
            if stale >= config.patience:
                break
        if not sums[size]:
            break
        flat = sums[:size] / sums[size]
    return best, tuple(history)


def mlp_config(params: dict) -> NetConfig:
    """Settings from the usual names of an MLP regressor."""
    return NetConfig(
        hidden=tuple(params.get("hidden_layer_sizes", (100,))),
        activation=params.get("activation", "relu"),
        l2=float(params.get("alpha", 1e-4)),
        learning_rate=float(params.get("learning_rate_init", 1e-3)),
        batch_size=int(params.get("batch_size", 200)),
        rounds=max(1, int(params.get("max_iter", 100)) // 5),
        local_epochs=5,
        seed=int(params.get("random_state", 42)),
    )


def svr_config(params: dict, n_rows: int, n_features: int) -> NetConfig:
    """Settings from the usual names of an epsilon-SVR.

    The penalty 1 / (C n) turns the summed loss into a mean. With z-scores the
    gamma rules ``scale`` and ``auto`` are the same.
    """
    kernel = params.get("kernel", "rbf")
    kind = {"rbf": "rbf", "linear": "identity", "poly": "poly"}[kernel]
    return NetConfig(
        hidden=(),
        l2=1.0 / (float(params.get("C", 1.0)) * max(n_rows, 1)),
        learning_rate=float(params.get("learning_rate_init", 2e-2)),
        batch_size=int(params.get("batch_size", 128)),
        rounds=int(params.get("rounds", 20)),
        epsilon=float(params.get("epsilon", 0.1)),
        seed=int(params.get("random_state", 42)),
        mapping=FeatureMap(kind=kind, dims=n_features, components=int(params.get("components", 128))),
    )
