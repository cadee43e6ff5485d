"""Two-way fixed effects: y_it = alpha_i + lambda_t + b'x_it + e_it.

The data stay distributed. Entities are demeaned, sums come back as one row per
period, and the slopes follow from a system of the regressors' size
(Frisch-Waugh-Lovell). The period effects solve a system with a row for each
period, which is never formed: conjugate gradients ask for its products with
vectors, one aggregate over the entities a step, so that panels with hundreds of
thousands of periods are estimated like those with ten.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelkit.econ.algebra import inverse, moment_columns, moment_matrix
from panelkit.functions.dist import t_two_sided
from panelkit.functions.scalars import significance_label
from panelkit.operators.reshape import complete_cases
from panelkit.runtime import broadcast_if_small, durable, lookup_side, stored
from panelkit.spec import PanelSpec


@dataclass
class PanelFit:
    """A fitted model: small estimates on the driver, rows in DataFrames."""

    spec: PanelSpec
    terms: list[str]
    beta: np.ndarray
    cov: np.ndarray
    cov_unadjusted: np.ndarray
    df_resid: int
    n_obs: int
    n_entities: int
    n_periods: int
    rss: float
    r2_within: float
    r2_between: float
    r2_overall: float
    sample: DataFrame
    means: DataFrame
    rows: DataFrame  # keys, z_<k>, e1
    row_effects: DataFrame  # entity -> mean of e1
    between_moments: np.ndarray = field(repr=False)
    within_moments: np.ndarray = field(repr=False)

    @property
    def params(self) -> dict[str, float]:
        return dict(zip(self.terms, self.beta.tolist()))

    def coefficients(self) -> DataFrame:
        """(term, coefficient, std_error, t_stat, p_value, significance)."""
        rows = []
        for i, term in enumerate(self.terms):
            se = float(np.sqrt(self.cov[i, i]))
            t = float(self.beta[i]) / se if se > 0 else float("nan")
            p = t_two_sided(t, self.df_resid)
            rows.append((term, float(self.beta[i]), se, None if np.isnan(t) else t, p))
        out = self.sample.sparkSession.createDataFrame(
            rows,
            "term string, coefficient double, std_error double, t_stat double, p_value double",
        )
        return out.withColumn("significance", significance_label("p_value"))

    def statistics(self) -> DataFrame:
        """One row with sample sizes and the three R2."""
        row = (
            "Dynamic Panel (FE)", self.r2_within, self.r2_between, self.r2_overall,
            self.n_obs, self.n_entities, self.n_periods,
        )
        return self.sample.sparkSession.createDataFrame(
            [row],
            "model string, r2_within double, r2_between double, r2_overall double, "
            "n_obs bigint, n_entities bigint, n_periods bigint",
        )

    def residuals(self) -> DataFrame:
        """Keys and residual ``e`` after both effects."""
        entity = self.spec.entity
        return self.rows.join(broadcast_if_small(self.row_effects), entity).select(
            *self.spec.keys, (F.col("e1") - F.col("_e1_mean")).alias("e")
        )

    def linear_part(self) -> Column:
        return sum(
            (F.col(t) * F.lit(float(b)) for t, b in zip(self.terms, self.beta)), F.lit(0.0)
        )

    def predict(self, df: DataFrame, effects: str = "none") -> DataFrame:
        """Add ``y_pred``: the slopes only, or with the entity effects added.

        The effect of an entity is the mean of what the slopes leave of its
        target, so it includes its average time effect. An entity without one
        gets the mean over all entities.
        """
        if effects == "none":
            return df.withColumn("y_pred", self.linear_part())
        if effects != "entity":
            raise ValueError(f"unknown effects: {effects}")
        target = F.col(f"_m_{self.spec.target}")
        mean_part = sum(
            (F.col(f"_m_{t}") * F.lit(float(b)) for t, b in zip(self.terms, self.beta)), F.lit(0.0)
        )
        alpha = lookup_side(
            self.means.select(self.spec.entity, (target - mean_part).alias("_alpha"))
        )
        average = alpha.agg(F.avg("_alpha")).scalar()
        return (
            df.join(alpha, self.spec.entity, "left")
            .withColumn("y_pred", self.linear_part() + F.coalesce("_alpha", average))
            .drop("_alpha")
        )


def entity_means(df: DataFrame, entity: str, columns: Sequence[str]) -> DataFrame:
    """(entity, _n, _m_<column>...): partial sums are combined before the shuffle."""
    return df.groupBy(entity).agg(
        F.count(F.lit(1)).alias("_n"), *[F.avg(c).alias(f"_m_{c}") for c in columns]
    )


class PeriodSystem:
    """The normal equations of the period effects, A v = counts * v - sum over entities of d mean(v over d).

    d marks the periods an entity has. A is never formed: ``times`` sends a vector over
    the periods to all tasks and gets one back. Entities with the same periods are counted first,
    so that a regular panel has few rows to go through. Only vectors over the periods reach the driver.
    """

    def __init__(self, sample: DataFrame, spec: PanelSpec, periods: Sequence, counts: np.ndarray):
        self.spark, self.counts = sample.sparkSession, counts
        place = self.spark.sparkContext.broadcast(np.asarray(periods))
        patterns = (
            sample.groupBy(spec.entity)
            .agg(F.sort_array(F.collect_set(spec.time)).alias("present"))
            .groupBy("present")
            .agg(F.count(F.lit(1)).alias("n"))
        )

        def numbered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                lists = batch.column(0)
                found = np.searchsorted(place.value, lists.flatten().to_numpy(zero_copy_only=False))
                at = pa.ListArray.from_arrays(_offsets(lists), pa.array(found, pa.int32()))
                yield pa.RecordBatch.from_arrays([at, batch.column(1)], ["at", "n"])

        self.patterns = stored(patterns.mapInArrow(numbered, "at array<int>, n long"))

    def _sums(self, kernel: Callable, width: int) -> np.ndarray:
        """Sums over all entities, by period, of what ``kernel`` gives for each period of each pattern."""
        size = len(self.counts)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total = np.zeros((size, width))
            for batch in batches:
                offsets = _offsets(batch.column(0)).to_numpy()
                at = batch.column(0).flatten().to_numpy()
                values = kernel(at, offsets, batch.column(1).to_numpy().astype(float))
                for j in range(width):
                    total[:, j] += np.bincount(at, values[:, j], size)
            found = np.flatnonzero(total.any(axis=1))
            yield pa.RecordBatch.from_arrays(
                [pa.array(found, pa.int32()), *[pa.array(total[found, j]) for j in range(width)]],
                ["t", *[f"v_{j}" for j in range(width)]],
            )

        names = [f"v_{j}" for j in range(width)]
        cells = self.patterns.mapInArrow(run, "t int, " + ", ".join(f"{c} double" for c in names))
        rows = cells.groupBy("t").agg(*[F.sum(c).alias(c) for c in names]).toPandas()
        out = np.zeros((size, width))
        out[rows["t"]] = rows[names].to_numpy()
        return out

    def times(self, v: np.ndarray) -> np.ndarray:
        sent = self.spark.sparkContext.broadcast(v)

        def kernel(at: np.ndarray, offsets: np.ndarray, n: np.ndarray) -> np.ndarray:
            length = np.diff(offsets)
            mean = np.add.reduceat(sent.value[at], offsets[:-1]) * (n / length)[:, None]
            return np.repeat(mean, length, axis=0)

        out = self.counts[:, None] * v - self._sums(kernel, v.shape[1])
        sent.destroy()
        return out

    def solve(self, right: np.ndarray, tolerance: float = 1e-12) -> np.ndarray:
        """A solution for each column, by conjugate gradients.

        The preconditioner adds two inverses: that of the counts, for effects that change from
        one period to the next, and that of a chain of periods, for effects that drift. An entity
        strengthens all links of the chain between its first and last period, so much that a straight line
        has the same energy in the chain as in A. Panels of short overlapping stretches thus
        need few steps as well. Steps end when the preconditioned residual of every column has fallen by
        ``tolerance``; twice as many steps as periods raise, as exact arithmetic needs one for each at most.
        """

        def links(at: np.ndarray, offsets: np.ndarray, n: np.ndarray) -> np.ndarray:
            first, last = offsets[:-1], offsets[1:] - 1
            length = last - first + 1
            mean = np.add.reduceat(at, first) / length
            spread = np.add.reduceat((at - np.repeat(mean, length)) ** 2, first)
            strength = n * spread / np.maximum(at[last] - at[first], 1)
            out = np.zeros((len(at), 1))
            out[first, 0] += strength
            out[last, 0] -= strength
            return out

        strength = np.maximum(np.cumsum(self._sums(links, 1)[:, 0])[:-1], 0)
        chain = np.append(strength, 0) + np.append(0, strength) + 1e-8 * self.counts

        def conditioned(v: np.ndarray) -> np.ndarray:
            return v / self.counts[:, None] + tridiagonal_solve(chain, -strength, v)

        right = right - right.mean(axis=0)
        goal = (right * conditioned(right)).sum(axis=0) * tolerance**2
        x = right / self.counts[:, None]  # all there is to it if the panel is balanced
        r = right - self.times(x)
        r = r - r.mean(axis=0)
        z = conditioned(r)
        p, size = z, (r * z).sum(axis=0)
        for _ in range(2 * len(right) + 10):
            if (size <= goal).all():
                return x
            q = self.times(p)
            bend = (p * q).sum(axis=0)
            step = np.where((size > goal) & (bend > 0), size / np.where(bend > 0, bend, 1), 0)
            x = x + step * p
            r = r - step * q
            r = r - r.mean(axis=0)
            z = conditioned(r)
            new = (r * z).sum(axis=0)
            p = z + np.where(size > 0, new / np.where(size > 0, size, 1), 0) * p
            size = new
        raise RuntimeError("the period effects did not settle")


def _offsets(lists: pa.ListArray) -> pa.Array:
    """Where each list of a column starts in its flattened values, and the end."""
    offsets = lists.offsets.to_numpy()
    return pa.array(offsets - offsets[0], pa.int32())


def tridiagonal_solve(diagonal: np.ndarray, beside: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Solve a symmetric tridiagonal system for several columns, by cyclic reduction.

    Every round eliminates the entries at a distance and doubles it, on whole vectors.
    """
    size = len(diagonal)
    main, values = diagonal.astype(float), right.astype(float)
    low, high = np.append(0.0, beside), np.append(beside, 0.0)
    gap = 1

    def moved(v: np.ndarray, by: int) -> np.ndarray:
        """v[i + by], and 0 beyond the ends."""
        out = np.zeros_like(v)
        if by > 0:
            out[: size - by] = v[by:]
        else:
            out[-by:] = v[:by]
        return out

    while gap < size:
        before, after = moved(main, -gap), moved(main, gap)
        up = -low / np.where(before == 0, 1, before)
        down = -high / np.where(after == 0, 1, after)
        main = main + up * moved(high, -gap) + down * moved(low, gap)
        values = values + up[:, None] * moved(values, -gap) + down[:, None] * moved(values, gap)
        low, high = up * moved(low, -gap), down * moved(high, gap)
        gap *= 2
    return values / main[:, None]


def _deviations(sample: DataFrame, means: DataFrame, entity: str, columns: Sequence[str]) -> DataFrame:
    joined = sample.join(broadcast_if_small(means), entity)
    return joined.select(
        *sample.columns, *[(F.col(c) - F.col(f"_m_{c}")).alias(f"_d_{c}") for c in columns]
    )


def fit_two_way(
    df: DataFrame,
    spec: PanelSpec,
    regressors: Sequence[str] | None = None,
    clustered: bool = True,
    debias: bool = True,
) -> PanelFit:
    """Estimate slopes with entity and time effects, for any number of periods.

    The driver holds vectors over the periods. The covariance is clustered by entity, or the classical one. With
    ``debias`` both are scaled by n / (n - k - N - T + 1).
    """
    terms = list(regressors or spec.features)
    y, entity, time = spec.target, spec.entity, spec.time
    columns = [y, *terms]
    sample = stored(
        complete_cases(df.select(*spec.keys, *[F.col(c).cast("double").alias(c) for c in columns]))
    )
    means = stored(entity_means(sample, entity, columns))
    deviations = _deviations(sample, means, entity, columns)
    d_names = [f"_d_{c}" for c in columns]
    k = len(columns)

    per_period = durable(
        deviations.groupBy(time)
        .agg(
            F.count(F.lit(1)).alias("n"),
            *[F.sum(d).alias(f"s_{i}") for i, d in enumerate(d_names)],
            *moment_columns(d_names),
        )
    )
    sums_of = [f"m_{i}_{j}" for i in range(k) for j in range(i, k)]
    within = moment_matrix(per_period.agg(*[F.sum(m).alias(m) for m in sums_of]).first().asDict(), k)
    m_names = [f"_m_{c}" for c in columns]
    between = means.agg(
        F.count(F.lit(1)).alias("n"),
        F.sum("_n").alias("rows"),
        F.struct(*moment_columns(m_names)).alias("plain"),
        F.struct(*moment_columns(m_names, F.col("_n"))).alias("weighted"),
    ).first()
    n_entities, n_obs = between["n"], between["rows"]
    if not n_obs:
        raise ValueError("no complete rows to estimate on")
    between_moments = moment_matrix(between["plain"].asDict(), k)
    rows = per_period.select(time, "n", *[f"s_{i}" for i in range(k)]).toPandas().sort_values(time)
    n_periods = len(rows)
    by_period = rows[[f"s_{i}" for i in range(k)]].to_numpy(float)
    periods, counts = rows[time].to_numpy(), rows["n"].to_numpy(float)
    gamma = PeriodSystem(sample, spec, periods, counts).solve(by_period)  # effect of each period per column
    partial = within - by_period.T @ gamma
    m_inv = inverse(partial[1:, 1:])
    beta = m_inv @ partial[1:, 0]
    effects = pd.DataFrame({time: periods, "_lambda": gamma[:, 0] - gamma[:, 1:] @ beta})
    for j in range(len(terms)):
        effects[f"_g_{j}"] = gamma[:, 1 + j]
    effects = sample.sparkSession.createDataFrame(effects).withColumn(time, F.col(time).cast(dict(sample.dtypes)[time]))
    base = deviations.join(broadcast_if_small(effects), time)
    z = [F.col(f"_d_{t}") - F.col(f"_g_{j}") for j, t in enumerate(terms)]
    fitted = sum((F.col(f"_d_{t}") * F.lit(float(b)) for t, b in zip(terms, beta)), F.lit(0.0))
    e1 = F.col(f"_d_{y}") - fitted - F.col("_lambda")

    scored = base.select(
        *spec.keys, *[c.alias(f"z_{j}") for j, c in enumerate(z)], e1.alias("e1")
    )
    scores = stored(
        scored.groupBy(entity).agg(
            F.count(F.lit(1)).alias("_n"),
            F.avg("e1").alias("_e1_mean"),
            F.sum(F.col("e1") * F.col("e1")).alias("_e1_sq"),
            *[F.sum(f"z_{j}").alias(f"_z_{j}") for j in range(len(terms))],
            *[F.sum(F.col(f"z_{j}") * F.col("e1")).alias(f"_ze_{j}") for j in range(len(terms))],
        )
    )
    # residuals sum to zero per entity, which the mean of e1 accounts for
    summed = scores.select(
        (F.col("_e1_sq") - F.col("_n") * F.col("_e1_mean") * F.col("_e1_mean")).alias("rss"),
        *[
            (F.col(f"_ze_{j}") - F.col("_e1_mean") * F.col(f"_z_{j}")).alias(f"s{j}")
            for j in range(len(terms))
        ],
    ).agg(F.sum("rss").alias("rss"), *moment_columns([f"s{j}" for j in range(len(terms))])).first()
    rss = max(summed["rss"], 0.0)
    meat = moment_matrix(summed.asDict(), len(terms))

    absorbed = n_entities + n_periods - 1
    df_resid = n_obs - len(terms) - absorbed
    if df_resid <= 0:
        raise ValueError("not enough rows for the number of effects")
    scale = n_obs / df_resid if debias else 1.0
    unadjusted = m_inv * (rss / n_obs) * scale
    cov = scale * m_inv @ meat @ m_inv if clustered else unadjusted

    def fit_share(moments: np.ndarray) -> float:
        total = moments[0, 0]
        left = total - 2 * beta @ moments[1:, 0] + beta @ moments[1:, 1:] @ beta
        return float(1 - left / total) if total > 0 else 0.0

    raw = within + moment_matrix(between["weighted"].asDict(), k)
    return PanelFit(
        spec=spec, terms=terms, beta=beta, cov=cov, cov_unadjusted=unadjusted,
        df_resid=int(df_resid), n_obs=int(n_obs), n_entities=int(n_entities),
        n_periods=int(n_periods), rss=float(rss),
        r2_within=fit_share(within), r2_between=fit_share(between_moments),
        r2_overall=fit_share(raw),
        sample=sample, means=means, rows=scored,
        row_effects=scores.select(entity, "_e1_mean"),
        between_moments=between_moments, within_moments=within,
    )
