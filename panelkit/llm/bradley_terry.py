"""Quality scores learnt from pairs by the model of Bradley and Terry.

A pair says that one document (label 1) is better than another (label 0). The
odds are the logistic function of the difference of two scores, each a weighted
sum of features of a text; the weights minimise the logistic loss on the
differences of the features. Scores are then cut at a quantile.

Every labelled row trains. The rows are dealt into blocks at random, pairs are drawn
inside the blocks, and each step of Newton's method is one scan that sums over them.
Sums are of decimals, so their order does not matter and reruns agree.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from panelkit.llm.common import in_arrow, text_chunks, width, word_hashes
from panelkit.operators.quantiles import column_quantiles
from panelkit.runtime import cached, stored

#: Pairs for each row of the commoner label.
RIVALS = 24
#: Rows of the commoner label in a block, on average, and least of the rarer one.
BLOCK, LEAST = 4_096, 256
#: The score at the cut; scores at or above it count as good.
CUT = 0.3

#: Features, in order. Shares are of bytes or of words.
FEATURES = (
    "log_words", "word_length", "upper", "digit", "mark", "odd", "pipe", "bang", "high", "line_words",
    "variety", "same_next", "top_word", "entropy", "same_line", "capital_words", "stops", "long_words",
)


def _mask(chars: str) -> np.ndarray:
    out = np.zeros(256, bool)
    out[list(chars.encode())] = True
    return out


_UPPER = _mask("ABCDEFGHIJKLMNOPQRSTUVWXYZ")
_DIGIT = _mask("0123456789")
_MARK = _mask(",;:'\"()-")
_ODD = _mask("#$%&*+/<=>@[\\]^_`{}~")
_PIPE, _BANG, _STOP = _mask("|"), _mask("!?"), _mask(".")
_HIGH = np.arange(256) >= 0xC0


def features(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """A row of features for each text of a chunk; an empty text has zeros."""
    n = len(offsets) - 1
    hashes, starts = word_hashes(data)
    at = np.searchsorted(starts, offsets)
    size = np.maximum(np.diff(offsets) - 1, 1)
    out = np.zeros((n, len(FEATURES)))

    def share(mask: np.ndarray) -> np.ndarray:
        return np.add.reduceat(mask[data], offsets[:-1], dtype=np.int64) / size

    words = np.diff(at)
    lines_at = np.flatnonzero(data == 10)
    out[:, 0] = np.log1p(words)
    out[:, 1] = np.minimum(size / np.maximum(words, 1), 30) / 10
    for k, mask in enumerate((_UPPER, _DIGIT, _MARK, _ODD, _PIPE, _BANG, _HIGH)):
        out[:, 2 + k] = share(mask)
    breaks = np.searchsorted(lines_at, offsets[1:] - 1) - np.searchsorted(lines_at, offsets[:-1])
    out[:, 9] = np.log1p(words / (breaks + 1))
    out[:, 16] = share(_STOP)
    capital = _UPPER[data[starts]] if len(starts) else np.zeros(0, bool)
    length = np.diff(starts, append=len(data))
    for k in range(n):
        w = hashes[at[k] : at[k + 1]]
        if not len(w):
            out[k] = 0
            continue
        count = np.sort(w)
        count = np.diff(np.flatnonzero(np.concatenate([[True], count[1:] != count[:-1], [True]])))
        p = count / len(w)
        out[k, 10] = len(count) / len(w)
        out[k, 11] = (w[1:] == w[:-1]).sum() / len(w)
        out[k, 12] = p.max()
        out[k, 13] = -(p * np.log(p)).sum() / np.log(len(w) + 1)
        text = data[offsets[k] : offsets[k + 1] - 1].tobytes()
        lines = [x for x in text.split(b"\n") if x.strip()]
        out[k, 14] = 1 - len(set(lines)) / max(len(lines), 1)
        out[k, 15] = capital[at[k] : at[k + 1]].mean()
        out[k, 17] = (length[at[k] : at[k + 1]] > 21).mean()
    return out


@dataclass(frozen=True)
class Ranker:
    """Weights on standardised features, and the map from raw scores to 0..1."""

    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    threshold: float
    slope: float

    def raw(self, x: np.ndarray) -> np.ndarray:
        return expand((x - self.mean) / self.scale) @ self.weights

    def score(self, x: np.ndarray) -> np.ndarray:
        """Raw scores on a logistic scale on which the threshold is at ``CUT``."""
        z = self.slope * (self.raw(x) - self.threshold) + np.log(CUT / (1 - CUT))
        return 1 / (1 + np.exp(-np.clip(z, -35, 35)))


def expand(z: np.ndarray) -> np.ndarray:
    """Bounded features and their squares, so that too little and too much can both be bad."""
    z = np.clip(z, -4, 4)
    return np.hstack([z, z * z])


def _with_features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for start, end, data, offsets in text_chunks(batch.column(1)):
            x = features(data, offsets)
            lists = pa.ListArray.from_arrays(pa.array(np.arange(len(x) + 1) * x.shape[1], pa.int32()), pa.array(x.ravel()))
            yield pa.RecordBatch.from_arrays([batch.column(0).slice(start, end - start), lists], ["doc", "x"])


def featured(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(doc, x): id and features of every row of ``docs``."""
    flat = docs.select(F.col(f"`{id_col}`").alias("doc"), F.col(f"`{text_col}`").alias("text"))
    return flat.transform(in_arrow, _with_features, T.StructType([flat.schema["doc"], T.StructField("x", T.ArrayType(T.DoubleType()))]))


def _matrix(lists: pa.ListArray) -> np.ndarray:
    return lists.flatten().to_numpy(zero_copy_only=False).reshape(len(lists), len(FEATURES))


def training_rows(found: DataFrame, labels: DataFrame, id_col: str, label_col: str) -> DataFrame:
    """(label, x, deal, hash) of every row of ``found`` that may train: its label, its features and two hashes.

    Only rows whose crc32(id as text) mod 5 is not 0 are taken. Ids with null or
    contradicting labels do not train. Rows equal in id and features are told apart by number.
    """
    may = F.crc32(F.col("doc").cast("string").cast("binary")) % 5 != 0
    known = (
        labels.where(f"`{id_col}` is not null and `{label_col}` in (0, 1)").groupBy(F.col(f"`{id_col}`").alias("key"))
        .agg(F.min(f"`{label_col}`").alias("label"), F.max(f"`{label_col}`").alias("other")).where("label = other")
        .select("key", F.col("label").cast("int"))
    )
    rows = found.where(may).join(known.hint("merge"), F.col("doc") == F.col("key"))  # both grow with the input
    counted = rows.groupBy("doc", "label", "x").agg(F.count(F.lit(1)).alias("n"))
    copies = counted.select("doc", "label", "x", F.explode(F.sequence(F.lit(1), F.col("n"))).alias("copy"))
    return copies.select("label", "x", F.xxhash64("doc", "copy").alias("deal"), F.xxhash64("x").alias("hash"))


def _moments(rows: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Mean and standard deviation of every feature over all rows."""
    def sums(of: Callable[[int], Column]) -> np.ndarray:
        row = rows.agg(F.count(F.lit(1)), *[F.sum(of(i).cast("decimal(38,18)")).cast("double") for i in range(len(FEATURES))]).first()
        return np.array(row[1:], float) / row[0] if row[0] else np.zeros(len(FEATURES))

    mean = sums(lambda i: F.col("x")[i])
    scale = np.sqrt(sums(lambda i: (F.col("x")[i] - F.lit(float(mean[i]))) ** 2))
    return mean, np.where(scale > 1e-9, scale, 1.0)


def _dealt(rows: DataFrame, n: dict[int, int]) -> DataFrame:
    """Rows with ``block``, the rows of a block together: one for each row of the commoner label, and
    for the rarer label as many as it takes to have ``LEAST`` of them everywhere."""
    common = int(n[1] >= n[0])
    blocks = -(-n[common] // BLOCK)
    copies = min(blocks, -(-blocks * LEAST // n[1 - common]))
    times = F.when(F.col("label") == common, 1).otherwise(copies)
    at = F.explode(F.sequence(F.lit(0), times - 1))
    spread = rows.withColumn("_at", at).withColumn("block", F.pmod(F.col("deal") + F.col("_at"), F.lit(blocks)).cast("int"))
    return (
        spread.repartition(min(blocks, width(rows)), "block").sortWithinPartitions("block", "hash", "label")
        .select("block", "label", "x")
    )


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(block, labels, features) of the blocks, whose rows come one after the other."""
    number, parts = None, []

    def whole() -> tuple[int, np.ndarray, np.ndarray]:
        return number, np.concatenate([p[0] for p in parts]), np.concatenate([p[1] for p in parts])

    for batch in batches:
        block, label, x = batch.column(0).to_numpy(), batch.column(1).to_numpy(), _matrix(batch.column(2))
        cuts = [0, *(np.flatnonzero(np.diff(block)) + 1), len(block)]
        for a, b in zip(cuts, cuts[1:]):
            if a == b:
                continue
            if parts and block[a] != number:
                yield whole()
                parts = []
            number = int(block[a])
            parts.append((label[a:b], x[a:b]))
    if parts:
        yield whole()


def _pairs(block: int, label: np.ndarray, z: np.ndarray, seed: int) -> np.ndarray:
    """Differences of features of the pairs of a block: each row of the commoner label has about ``RIVALS`` of them."""
    good, bad = np.flatnonzero(label == 1), np.flatnonzero(label == 0)
    if not len(good) or not len(bad):
        return z[:0]
    rng = np.random.default_rng(seed + block)
    first = np.repeat(good, int(np.ceil(RIVALS * max(1, len(bad) / len(good)))))
    return z[first] - z[bad[rng.integers(0, len(bad), len(first))]]


def _newton(dealt: DataFrame, mean: np.ndarray, scale: np.ndarray, seed: int, ridge: float, rounds: int) -> np.ndarray:
    """Weights that minimise the logistic loss of all pairs."""
    size = 2 * len(FEATURES)
    weights = np.zeros(size)

    def sums(weights: np.ndarray) -> tuple[float, np.ndarray, np.ndarray]:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for block, label, x in _blocks(batches):
                gap = _pairs(block, label, expand((x - mean) / scale), seed)
                p = 1 / (1 + np.exp(np.clip(gap @ weights, -35, 35)))
                curve = (gap * (p * (1 - p))[:, None]).T @ gap
                values = np.concatenate([[len(gap)], gap.T @ p, curve.ravel()])
                yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(values), dtype=np.int32)), pa.array(values)], ["i", "v"])

        cells = dealt.transform(in_arrow, run, "i int, v double").groupBy("i").agg(F.sum(F.col("v").cast("decimal(38,12)")).cast("double").alias("v"))
        cells = cells.toPandas()
        out = np.zeros(1 + size + size * size)
        out[cells["i"]] = cells["v"]
        return out[0], out[1 : 1 + size], out[1 + size :].reshape(size, size)

    for _ in range(rounds):
        n, slope, curve = sums(weights)
        step = np.linalg.solve(curve / n + ridge * np.eye(size), slope / n - ridge * weights)
        weights = weights + step
        if np.abs(step).max() < 1e-8:
            break
    return weights


def fit(rows: DataFrame, seed: int = 5, ridge: float = 1e-3, rounds: int = 50) -> Ranker:
    """Newton's method on the logistic loss of random pairs, over all of ``rows`` (see ``training_rows``).

    The threshold is the quantile of all scores at the share of label 0, in the middle of the gap in
    which it lies. Without both labels every document scores above the cut.
    """
    mean, scale = _moments(rows)
    n = {0: 0, 1: 0} | {r["label"]: r["count"] for r in rows.groupBy("label").count().collect()}
    if not n[0] or not n[1]:
        return Ranker(mean, scale, np.zeros(2 * len(FEATURES)), -1.0, 1.0)
    with cached(_dealt(rows, n)) as dealt:
        weights = _newton(dealt, mean, scale, seed, ridge, rounds)
    ranker = Ranker(mean, scale, weights, 0.0, 1.0)

    def raws(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw, good = ranker.raw(_matrix(batch.column(1))), batch.column(0).to_numpy() == 1
            yield pa.RecordBatch.from_arrays([pa.array(raw), pa.array(raw, mask=~good), pa.array(raw, mask=good)], ["raw", "good", "bad"])

    total = n[0] + n[1]
    k = min(max(n[0], 1), total - 1)
    at = (k - 0.5) / (total - 1)
    found = column_quantiles(rows.select("label", "x").transform(in_arrow, raws, "raw double, good double, bad double"), ["raw", "good", "bad"], [at, 0.5])
    spread = max(found["good"][0.5] - found["bad"][0.5], 1e-6)
    return Ranker(mean, scale, weights, found["raw"][at], 6 / spread)


def trained(found: DataFrame, labels: DataFrame, id_col: str, label_col: str) -> Ranker:
    """A ranker fitted on all labelled rows of ``found`` (see ``featured``) that are not held out."""
    return fit(stored(training_rows(found, labels, id_col, label_col)))


def scores(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, label_col: str) -> DataFrame:
    """(id_col, held_out, score double, predicted int) for every row of ``docs``.

    Only the text enters a score. Null and empty texts score as texts without
    words; null ids are not held out and have no label; repeated documents stay
    repeated. Without labels of both kinds every document passes.
    """
    found = stored(featured(docs, id_col, text_col))
    ranker = trained(found, labels, id_col, label_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            score = pa.array(ranker.score(_matrix(batch.column(1))))
            yield pa.RecordBatch.from_arrays([batch.column(0), score], ["doc", "score"])

    scored = found.transform(in_arrow, run, T.StructType([found.schema["doc"], T.StructField("score", T.DoubleType())]))
    held = F.coalesce(F.crc32(F.col("doc").cast("string").cast("binary")) % 5 == 0, F.lit(False))
    return scored.select(F.col("doc").alias(id_col), held.alias("held_out"), "score", (F.col("score") >= CUT).cast("int").alias("predicted"))


def keep_good(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, label_col: str) -> DataFrame:
    """The rows of ``docs`` whose score is at least ``CUT``, with all their columns; no text is shuffled."""
    ranker = trained(featured(docs, id_col, text_col), labels, id_col, label_col)
    place = docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = [ranker.score(features(data, offsets)) >= CUT for _, _, data, offsets in text_chunks(batch.column(place))]
            if keep:
                yield batch.filter(pa.array(np.concatenate(keep)))

    return docs.transform(in_arrow, run, docs.schema)
