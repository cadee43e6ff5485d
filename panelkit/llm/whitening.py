"""Whitening of embeddings, with eigenvectors refined beyond the precision they were found in.

Entries are rounded to integers first, so that the covariance is gathered from all
partitions without rounding: sums of products of integers, whatever the order of
the tasks. Its eigenvectors are found in single precision and then corrected by the
iteration of Ogita and Aishima, a few matrix products a round, in double and then in
extended precision. Eigenvalues closer than the error bound form clusters; the
vectors of a cluster are told apart by an eigenproblem of the cluster's size, shifted
to its middle. The driver holds matrices of the dimension's square and nothing else.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from decimal import Decimal
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from panelkit.llm.common import col, in_arrow, settled

#: An entry c counts as floor(SCALE * c) + OFFSET.
SCALE, OFFSET = 64, 1_000_000
#: Components that are kept at most.
COMPONENTS = 16
#: Rows multiplied at once, and bits of the parts in which integers are multiplied: their sums stay below 2**53.
BLOCK, BITS = 4096, 20

_EXACT = pa.decimal128(38, 0)


def rounded(vector: Column) -> Column:
    """A vector's integers; an entry too large for them raises."""
    return F.transform(vector, lambda c: F.floor(c.cast("double") * SCALE) + F.lit(OFFSET).cast("long"))


def usable(vector: Column) -> Column:
    """True where a vector is there and all its entries are finite numbers."""
    return F.forall(vector, lambda c: F.coalesce(F.abs(c.cast("double")) < float("inf"), F.lit(False)))


def matrix(column: pa.Array) -> np.ndarray:
    """Lists of one length as a matrix."""
    values = column.flatten().to_numpy(zero_copy_only=False)
    return values.reshape(len(column), -1) if len(column) else values.reshape(0, 0)


def whole_sums(c: np.ndarray) -> np.ndarray:
    """Column sums of integers, exact, as Python integers."""
    if len(c) and float(np.abs(c).max()) * len(c) < 2**62:
        return c.sum(axis=0).astype(object)
    return c.astype(object).sum(axis=0) if len(c) else np.zeros(c.shape[1], object)


def products(c: np.ndarray) -> np.ndarray:
    """``c.T @ c`` of an integer matrix, exact, as Python integers."""
    total = np.zeros((c.shape[1], c.shape[1]), object)
    half = 1 << (BITS - 1)
    for at in range(0, len(c), BLOCK):
        rest, parts = c[at : at + BLOCK], []
        while not parts or rest.any():
            low = ((rest + half) & ((1 << BITS) - 1)) - half
            parts.append(low.astype(float))
            rest = (rest - low) >> BITS
        for p, x in enumerate(parts):
            for q, y in enumerate(parts):
                total += (x.T @ y).astype(np.int64).astype(object) << (BITS * (p + q))
    return total


def squares(d: np.ndarray) -> list[int]:
    """Sum of squares of each row of an integer matrix, exact."""
    if not d.size or float(np.abs(d).max()) ** 2 * d.shape[1] < 2**62:
        return (d * d).sum(axis=1).tolist()
    d = d.astype(object)
    return (d * d).sum(axis=1).tolist()


def refined(a: np.ndarray, x: np.ndarray, rounds: int = 100) -> np.ndarray:
    """Approximate eigenvectors ``x`` of the symmetric ``a``, corrected to the precision of ``a``.

    Rounds go on until three did not lower the bound on the error; the vectors of the lowest
    bound are returned. Eigenvalues that steps within the bound connect are a cluster: its
    vectors are only made orthogonal by the correction, and are then turned by the eigenvectors
    of the block of ``a`` that they span, in which the shift leaves nothing but the differences
    of their eigenvalues.
    """
    best, least, idle, size = x, np.inf, 0, np.sqrt((a * a).sum())
    for _ in range(rounds):
        r = np.eye(len(a), dtype=a.dtype) - x.T @ x
        s = x.T @ (a @ x)
        value = np.diag(s) / (1 - np.diag(r))
        off = s - np.diag(value)
        bound = 2 * (np.sqrt((off * off).sum()) + size * np.sqrt((r * r).sum()))
        idle = 0 if bound < least / 2 else idle + 1
        if bound < least:
            best, least = x, bound
        if idle == 3:
            break
        gap = value[None, :] - value[:, None]
        order = np.argsort(value)
        part = np.empty(len(a), int)
        part[order] = np.cumsum(np.diff(value[order], prepend=-np.inf) > bound)
        near = part[None, :] == part[:, None]
        e = np.where(near, r / 2, (s + value * r) / np.where(near, 1, gap))
        x = x + x @ (np.triu(e) + np.tril(r - e.T, -1))  # e + e.T is r, but for rounding that small gaps magnify
        for cluster in np.split(order, np.flatnonzero(np.diff(part[order])) + 1):
            if len(cluster) > 1:
                block = x[:, cluster]
                t = block.T @ (a @ block) - value[cluster].mean() * (block.T @ block)
                if spread := np.abs(t).max():
                    x[:, cluster] = block @ np.linalg.eigh(((t + t.T) / (2 * spread)).astype(float))[1].astype(a.dtype)
    return best


def eigen(a: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Falling eigenvalues and unit eigenvectors of a symmetric matrix in extended precision, rounded to doubles.

    A vector's largest entry is positive.
    """
    scale = np.abs(a).max() if a.size else 0
    if not scale:
        return np.zeros(len(a)), np.eye(len(a))
    a = a / scale
    x = np.linalg.eigh(a.astype(np.float32))[1].astype(float)
    x = refined(a, refined(a.astype(float), x).astype(a.dtype))
    x = x / np.sqrt((x * x).sum(axis=0))
    value = (x * (a @ x)).sum(axis=0)
    order = np.argsort(-value, kind="stable")
    x = x[:, order]
    x = x * np.where(x[np.abs(x).argmax(axis=0), np.arange(len(a))] < 0, -1, 1)
    return (value[order] * scale).astype(float), x.astype(float)


@dataclass(frozen=True)
class Whitening:
    """What a fit list gives: its size, sums, components and their eigenvalues."""

    n: int
    sums: tuple[int, ...]
    vectors: np.ndarray
    values: np.ndarray
    trace: float
    identity_error: float

    @property
    def explained(self) -> list[float]:
        """Share of the variance of each component."""
        return [float(v / self.trace) for v in self.values]

    def split_mean(self) -> tuple[np.ndarray, np.ndarray]:
        """The mean's whole part and what is left of the sums: mean = whole + rest / n."""
        pairs = [divmod(s, self.n) for s in self.sums]
        return np.array([p[0] for p in pairs], np.int64), np.array([p[1] for p in pairs], np.int64)

    def project(self, x: np.ndarray) -> np.ndarray:
        """Whitened coordinates of rows of integers."""
        whole, rest = self.split_mean()
        return ((x - whole) - rest / self.n) @ (self.vectors / np.sqrt(self.values))


def _entries(total: np.ndarray, kind) -> pa.RecordBatch:
    i, j = np.triu_indices(total.shape[0], 0, total.shape[1])
    kept = [total[p, q] for p, q in zip(i, j)]
    kept = pa.array([Decimal(int(v)) for v in kept], _EXACT) if kind == _EXACT else pa.array(kept, kind)
    return pa.RecordBatch.from_arrays([pa.array(i, pa.int32()), pa.array(j, pa.int32()), kept], ["i", "j", "s"])


def _gathered(fit_list: DataFrame, part, kind: str) -> dict[tuple[int, int], int | float]:
    """Sums over all partitions of the upper triangle of a matrix that ``part`` makes of the rows of a batch."""
    arrow = _EXACT if kind.startswith("decimal") else pa.float64()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            if batch.num_rows:
                new = part(matrix(batch.column(0)))
                total = new if total is None else total + new
        if total is not None:
            yield _entries(total, arrow)

    found = fit_list.transform(in_arrow, run, T._parse_datatype_string(f"i int, j int, s {kind}"))
    whole = int if arrow == _EXACT else float
    return {(r.i, r.j): whole(r.s) for r in found.groupBy("i", "j").agg(F.sum("s").alias("s")).collect()}


def fit(vectors: DataFrame, vec_col: str, most: int = COMPONENTS) -> Whitening:
    """The whitening of the distinct rounded vectors of ``vectors``.

    Null vectors and vectors with null or non-finite entries are left out, repeated
    ones count once; they are found by one shuffle that first combines equal rows in each
    task. Vectors of several lengths raise. Components without variance,
    as the rounding of the covariance leaves it, are left out: one distinct vector has none.
    """
    x = rounded(col(vec_col))
    rows = settled(vectors.where(usable(col(vec_col))).select(x.alias("x")).distinct())
    n, least, dims = rows.agg(F.count("*"), F.min(F.size("x")), F.max(F.size("x"))).first()
    if not n or not dims:
        return Whitening(n, (), np.zeros((0, 0)), np.zeros(0), 0.0, 0.0)
    if least != dims:
        raise ValueError(f"vectors of {least} and of {dims} entries")
    sums = _gathered(rows, lambda c: whole_sums(c)[None, :], "decimal(38,0)")
    found = Whitening(n, tuple(sums[0, j] for j in range(dims)), np.zeros((dims, 0)), np.zeros(0), 0.0, 0.0)
    whole, rest = found.split_mean()
    centred = _gathered(rows, lambda c: products(c - whole), "decimal(38,0)")
    cov = np.zeros((dims, dims), np.longdouble)
    for (i, j), s in centred.items():  # what the mean's whole part leaves, below 1 in each dimension, comes off exactly
        exact = Fraction(n * s - int(rest[i]) * int(rest[j]), n * n)
        high = float(exact)
        cov[i, j] = cov[j, i] = np.longdouble(high) + np.longdouble(float(exact - Fraction(high)))
    values, vecs = eigen(cov)
    some = values > max(values[0], 0) * dims * np.finfo(float).eps
    some[most:] = False
    found = Whitening(n, found.sums, vecs[:, some], values[some], float(np.trace(cov)), 0.0)
    if not some.any():
        return found

    def spread(c: np.ndarray) -> np.ndarray:
        z = found.project(c)
        return np.vstack([z.sum(axis=0), z.T @ z])

    k = int(some.sum())
    sent = _gathered(rows, lambda c: _square(spread(c)), "double")
    mean = np.array([sent[0, 1 + j] for j in range(k)]) / n
    error = max(
        abs(sent[1 + i, 1 + j] / n - mean[i] * mean[j] - (i == j)) for i in range(k) for j in range(i, k)
    )
    return Whitening(n, found.sums, found.vectors, found.values, found.trace, float(error))


def _square(rows: np.ndarray) -> np.ndarray:
    """Sums above products, as a matrix whose first row and column are the sums."""
    return np.hstack([np.concatenate([[0.0], rows[0]])[:, None], rows])


def whiten(vectors: DataFrame, id_col: str, vec_col: str, found: Whitening) -> DataFrame:
    """(id_col, deviation decimal, whitened array of doubles) for every usable vector of ``vectors``.

    deviation is the sum of (n * x - sum) ** 2 over the dimensions, exact. Nothing is shuffled.
    Null ids and repeated rows stay; unusable vectors and empty tables give no rows.
    """
    whole, rest = found.split_mean() if found.n else (None, None)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            x = matrix(batch.column(1))
            d = (x - whole) if x.shape[1] else x
            if x.shape[1]:
                wide = d.astype(object) if float(np.abs(d).max() + 1) * found.n >= 2**62 else d
                d = wide * found.n - rest
            z = found.project(x) if found.values.size else np.zeros((len(x), 0))
            lists = pa.ListArray.from_arrays(pa.array(np.arange(len(z) + 1) * z.shape[1], pa.int32()), pa.array(z.ravel()))
            deviation = pa.array([Decimal(v) for v in squares(d)], _EXACT)
            yield pa.RecordBatch.from_arrays([batch.column(0), deviation, lists], ["id", "deviation", "whitened"])

    flat = vectors.where(usable(col(vec_col))).select(col(id_col).alias("id"), rounded(col(vec_col)).alias("x"))
    schema = T.StructType([
        flat.schema["id"], T.StructField("deviation", T.DecimalType(38, 0)), T.StructField("whitened", T.ArrayType(T.DoubleType())),
    ])
    return flat.transform(in_arrow, run, schema).withColumnRenamed("id", id_col)


def components(vectors: DataFrame, id_col: str, vec_col: str, most: int = COMPONENTS) -> DataFrame:
    """(id_col, component, n, deviation long, whitened, explained, identity_error): a row for each vector and component.

    The fit takes all of ``vectors``. A deviation beyond a long raises; ``whiten`` has it as a decimal.
    """
    found = fit(vectors, vec_col, most)
    share = F.array(*[F.lit(v) for v in found.explained]).cast("array<double>")
    rows = whiten(vectors, id_col, vec_col, found)
    return rows.select(col(id_col), "deviation", F.posexplode("whitened").alias("k", "whitened")).select(
        col(id_col), (F.col("k") + 1).cast("int").alias("component"), F.lit(found.n).cast("long").alias("n"),
        F.col("deviation").cast("long").alias("deviation"), "whitened",
        F.get(share, F.col("k")).alias("explained"), F.lit(found.identity_error).alias("identity_error"),
    )
