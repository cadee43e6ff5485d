"""Exact k-nearest-neighbour join and regression.

An index holds the points in shards of bounded size with a box around each, cut by the
medians of a sample. One shard is sent to all tasks and searched there, without any
shuffle. With more of them a query first meets the shard its box lies next to, and the
distance of the k-th point found there bounds the other shards that it has to meet.
Inside a shard the same is done once more with leaves of a few hundred points. Ties
go by the points' keys, nothing is left out, so the result is exact. The index is
built once for a set of points and serves any number of queries.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from panelkit.models.scaling import ZScores
from panelkit.operators.reshape import complete_cases
from panelkit.runtime import lookup_side, stored
from panelkit.spec import PanelSpec

#: Most points of a shard, and points in a leaf of it.
SHARD, LEAF = 200_000, 256
#: Points from which the cuts between shards are taken.
SAMPLE = 20_000
#: Queries that meet a shard in one task, and rows of one distance matrix.
QUERY_CHUNK, SLICE = 8_192, 512
#: Leaves that a query visits one after the other; further ones are searched in one go.
SINGLY = 12
#: Distances are compared after rounding, so float noise cannot reorder ties.
DECIMALS = 9
#: How far a box may lie beyond the k-th rounded distance and still hold a point that counts.
RELATIVE, SLACK = 1e-12, 2 * 10.0**-DECIMALS


def distances(a: np.ndarray, b: np.ndarray, metric: str) -> np.ndarray:
    """Distance of every row of ``a`` to every row of ``b``."""
    out = np.zeros((len(a), len(b)))
    for j in range(a.shape[1]):
        gap = a[:, j, None] - b[None, :, j]
        out += np.abs(gap) if metric == "manhattan" else gap * gap
    return out if metric == "manhattan" else np.sqrt(out)


def box_distances(a: np.ndarray, low: np.ndarray, high: np.ndarray, metric: str) -> np.ndarray:
    """Least distance of every row of ``a`` to any place in every box."""
    out = np.zeros((len(a), len(low)))
    for j in range(a.shape[1]):
        at = a[:, j, None]
        gap = np.maximum(np.maximum(low[None, :, j] - at, at - high[None, :, j]), 0)
        out += gap if metric == "manhattan" else gap * gap
    return out if metric == "manhattan" else np.sqrt(out)


def _cut(values: np.ndarray) -> float | None:
    """A value above some of ``values`` and at or below the rest, near their median; none if all are equal."""
    half = np.partition(values, len(values) // 2)[len(values) // 2]
    below, above = values[values < half], values[values > half]
    if not len(below) and not len(above):
        return None
    # all values equal to the median stay together, on the smaller side
    left, right = (below.max(), half) if len(below) >= len(above) else (half, above.min())
    middle = left / 2 + right / 2
    return float(middle if left < middle <= right else right)


def median_cells(x: np.ndarray, most: int) -> tuple[list[np.ndarray], np.ndarray, np.ndarray]:
    """Row numbers of ``x`` in parts of at most ``most``, and the cells that they are cut into.

    A part is cut along its widest side, and equal values stay on one side of a cut, so
    the parts' boxes do not overlap. Only equal rows make a part larger. The cells fill the space.
    """
    sides = x.shape[1]
    open_parts = [(np.arange(len(x)), np.full(sides, -np.inf), np.full(sides, np.inf))]
    done = []
    while open_parts:
        part, low, high = open_parts.pop()
        cut = None
        if len(part) > most:
            side = int(np.argmax(x[part].max(axis=0) - x[part].min(axis=0)))
            values = x[part, side]
            cut = _cut(values)
        if cut is None:
            done.append((part, low, high))
            continue
        under, over = high.copy(), low.copy()
        under[side] = over[side] = cut
        less = values < cut
        open_parts += [(part[less], low, under), (part[~less], over, high)]
    return [p for p, _, _ in done], np.array([a for _, a, _ in done]), np.array([b for _, _, b in done])


class Leaves:
    """The points of a shard, in leaves with a box around each."""

    def __init__(self, x: np.ndarray, k: int):
        self.parts = [np.sort(p) for p in median_cells(x, max(LEAF, 4 * k))[0]] if len(x) else []
        self.points = [np.ascontiguousarray(x[p]) for p in self.parts]
        self.low = np.array([p.min(axis=0) for p in self.points])
        self.high = np.array([p.max(axis=0) for p in self.points])

    def nearest(self, q: np.ndarray, k: int, metric: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(query, point, rounded distance) of the k nearest points of every query, nearest first; ties by point number."""
        found = []
        parts = [np.arange(len(q))]
        if len(q) > SLICE:  # neighbours in one slice visit the same leaves
            parts = [cell[at : at + SLICE] for cell in median_cells(q, SLICE)[0] for at in range(0, len(cell), SLICE)]
        for rows in parts if len(q) else []:
            row, point, value = self._slice(q[rows], k, metric)
            found.append((rows[row], point, value))
        row, point, value = (np.concatenate(c) for c in zip(*found)) if found else [np.zeros(0)] * 3
        by_row = np.argsort(row, kind="stable")
        return row[by_row], point[by_row], value[by_row]

    def _slice(self, q: np.ndarray, k: int, metric: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Every query visits its leaves nearest first, until the next lies beyond the k-th point found so far."""
        away = box_distances(q, self.low, self.high, metric)
        asking = np.arange(len(q))
        best = (np.zeros(0, dtype=int), np.zeros(0, dtype=int), np.zeros(0))
        reach = np.full(len(q), np.inf)
        for visit in range(SINGLY + 1):
            left = away[asking]
            if visit < SINGLY:
                at, leaf_of = np.arange(len(asking)), left.argmin(axis=1)
                near = (left[at, leaf_of] <= reach[asking]) & (left[at, leaf_of] < np.inf)
                at, leaf_of = at[near], leaf_of[near]
            else:  # the rest at once
                at, leaf_of = np.nonzero((left <= reach[asking, None]) & (left < np.inf))
            if not len(at):
                break
            asked = asking[at]
            away[asked, leaf_of] = np.inf
            by_leaf = np.argsort(leaf_of, kind="stable")
            ends = np.flatnonzero(np.diff(leaf_of[by_leaf], append=-1)) + 1
            out = [best]
            for start, end in zip([0, *ends], ends):
                rows, leaf = asked[by_leaf[start:end]], leaf_of[by_leaf[start]]
                d = np.round(distances(q[rows], self.points[leaf], metric), DECIMALS)
                bound = reach[rows]
                if d.shape[1] > k:
                    bound = np.minimum(bound, np.partition(d, k - 1, axis=1)[:, k - 1])
                row, place = np.nonzero(d <= bound[:, None])
                out.append((rows[row], self.parts[leaf][place], d[row, place]))
            best = _first(*(np.concatenate(c) for c in zip(*out)), k)
            last = np.flatnonzero(np.diff(best[0], append=-1))
            full = last[best[0][last] == best[0][np.maximum(last - k + 1, 0)]] if k > 1 else last
            full = full[full >= k - 1]
            reach[best[0][full]] = best[2][full] * (1 + RELATIVE) + SLACK
            asking = np.unique(asked)
        return best


def _first(row: np.ndarray, point: np.ndarray, value: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The k first of every row by value, then by point."""
    order = np.lexsort((point, value, row))
    row, point, value = row[order], point[order], value[order]
    keep = np.arange(len(row)) - np.searchsorted(row, row) < k
    return row[keep], point[keep], value[keep]


@dataclass
class NeighbourIndex:
    """Points in shards. ``most`` is the largest k that it answers."""

    points: DataFrame  # p_<key>..., dims..., y, shard
    keys: list[str]
    dims: list[str]
    most: int
    n: int
    low: np.ndarray = field(repr=False)
    high: np.ndarray = field(repr=False)
    counts: np.ndarray = field(repr=False)
    sent: Broadcast | None = field(default=None, repr=False)

    @classmethod
    def build(
        cls, points: DataFrame, keys: Sequence[str], dims: Sequence[str], label: str, most: int, shard: int | None = None
    ) -> "NeighbourIndex":
        """Index ``points`` by ``dims``; ``label`` is returned as y, ``keys`` tell points apart.

        Of equal points only the first ``most`` keys can ever be among the nearest, and only
        these are kept, so that many equal points do not fill shards.
        """
        keys, dims, shard = list(keys), list(dims), shard or SHARD
        cast = [F.col(c).cast("double").alias(c) for c in dims]
        p_keys = [f"p_{c}" for c in keys]
        p = points.select(*[F.col(c).alias(f"p_{c}") for c in keys], *cast, F.col(label).cast("double").alias("y"))
        twins = Window.partitionBy(*dims).orderBy(*p_keys)
        p = stored(p.withColumn("_twin", F.row_number().over(twins)).where(F.col("_twin") <= most).drop("_twin"))
        n = p.count()
        if n == 0:
            raise ValueError("no points to search")
        if n <= shard:
            return cls(p.withColumn("shard", F.lit(0)), keys, dims, most, n, np.zeros((1, len(dims))), np.zeros((1, len(dims))), np.array([n]))
        sharded = stored(_sharded(p, dims, p_keys, n, shard))
        sides = sharded.groupBy("shard").agg(
            F.count(F.lit(1)).alias("n"), *[F.min(c).alias(f"low_{i}") for i, c in enumerate(dims)],
            *[F.max(c).alias(f"high_{i}") for i, c in enumerate(dims)],
        ).orderBy("shard").toPandas()
        numbers = {int(s): i for i, s in enumerate(sides["shard"])}
        if list(numbers) != list(range(len(numbers))):  # a cut may have caught no point
            names = p.sparkSession.createDataFrame(list(numbers.items()), "shard int, _place int")
            sharded = sharded.join(F.broadcast(names), "shard").drop("shard").withColumnRenamed("_place", "shard")
        return cls(
            sharded, keys, dims, most, n, sides[[f"low_{i}" for i in range(len(dims))]].to_numpy(float),
            sides[[f"high_{i}" for i in range(len(dims))]].to_numpy(float), sides["n"].to_numpy(),
        )

    def _named(self, df: DataFrame) -> DataFrame:
        cast = [F.col(c).cast("double").alias(c) for c in self.dims]
        return df.select(*[F.col(c).alias(f"q_{c}") for c in self.keys], *cast)

    def _schema(self, q: DataFrame) -> T.StructType:
        return T.StructType([
            *[q.schema[f"q_{c}"] for c in self.keys], T.StructField("distance", T.DoubleType()),
            *[self.points.schema[f"p_{c}"] for c in self.keys], T.StructField("y", T.DoubleType()),
            T.StructField("rank", T.IntegerType()),
        ])

    def nearest(self, queries: DataFrame, k: int, metric: str = "euclidean") -> DataFrame:
        """The k nearest points of every query: q_<key>..., distance, p_<key>..., y, rank.

        ``queries`` has the keys and dims, none of them null.
        """
        if k > self.most:
            raise ValueError(f"the index answers {self.most} neighbours at most")
        q = self._named(queries)
        if len(self.counts) == 1:
            return self._in_one_shard(q, k, metric)
        homes = self._routed(q, k, metric)
        first = stored(self._met(homes, k, metric))
        q_keys = [f"q_{c}" for c in self.keys]
        reach = first.groupBy(*q_keys).agg(
            F.when(F.count(F.lit(1)) >= k, F.max("distance")).otherwise(F.lit(float("inf"))).alias("_reach")
        )
        more = self._met(self._routed(q.join(reach, q_keys), k, metric), k, metric)
        best = Window.partitionBy(*q_keys).orderBy("distance", *[f"p_{c}" for c in self.keys])
        both = first.unionByName(more).drop("rank")
        return both.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)

    def _in_one_shard(self, q: DataFrame, k: int, metric: str) -> DataFrame:
        """Search the only shard in the tasks that have the queries; it has ``SHARD`` rows at most."""
        if self.sent is None:
            local = self.points.drop("shard").toPandas().sort_values([f"p_{c}" for c in self.keys], kind="stable")
            self.sent = q.sparkSession.sparkContext.broadcast(local.reset_index(drop=True))
        sent, search = self.sent, self._search(k, metric)

        def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            points, leaves = sent.value, None
            for batch in batches:
                if leaves is None:
                    leaves = search.leaves(points)
                yield search(batch, points, leaves)

        return q.mapInPandas(run, self._schema(q))

    def _search(self, k: int, metric: str) -> "_Search":
        return _Search(tuple(self.keys), tuple(self.dims), k, metric)

    def _routed(self, q: DataFrame, k: int, metric: str) -> DataFrame:
        """A row per query and shard to meet: the home shard, or with ``_reach`` all others within it."""
        dims, low, high = self.dims, self.low, self.high
        short = np.where(self.counts >= min(k, self.counts.max()), 0.0, np.inf)
        rest = "_reach" in q.columns
        schema = T.StructType([*[f for f in q.schema.fields if f.name != "_reach"], T.StructField("shard", T.IntegerType())])

        def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for batch in batches:
                for start in range(0, len(batch), SLICE):
                    part = batch.iloc[start : start + SLICE]
                    away = box_distances(part[dims].to_numpy(float), low, high, metric)
                    home = (away + short).argmin(axis=1)
                    if rest:
                        visits = away <= (part["_reach"].to_numpy(float) * (1 + RELATIVE) + SLACK)[:, None]
                        visits[np.arange(len(part)), home] = False
                        row, shard = np.nonzero(visits)
                        yield part.drop(columns="_reach").iloc[row].assign(shard=shard.astype("int32"))
                    else:
                        yield part.assign(shard=home.astype("int32"))

        return q.mapInPandas(run, schema)

    def _met(self, routed: DataFrame, k: int, metric: str) -> DataFrame:
        """The k nearest points of each query in each shard it is routed to; a shard with many queries meets them in chunks."""
        q_keys = [f"q_{c}" for c in self.keys]
        chunks = lookup_side(routed.groupBy("shard").agg(
            F.ceil(F.count(F.lit(1)) / F.lit(QUERY_CHUNK)).cast("int").alias("_chunks")
        ))
        asked = routed.join(chunks, "shard").withColumn("_chunk", F.pmod(F.xxhash64(*q_keys), F.col("_chunks")).cast("int"))
        offered = self.points.join(chunks, "shard").withColumn("_chunk", F.explode(F.sequence(F.lit(0), F.col("_chunks") - 1)))
        schema, search = self._schema(routed), self._search(k, metric)

        def run(ask: pd.DataFrame, offer: pd.DataFrame) -> pd.DataFrame:
            if ask.empty or offer.empty:
                return pd.DataFrame(columns=schema.names)
            points = offer.sort_values([f"p_{c}" for c in search.keys], kind="stable").reset_index(drop=True)
            return search(ask, points, search.leaves(points))

        return (
            asked.drop("_chunks").groupBy("shard", "_chunk")
            .cogroup(offered.drop("_chunks").groupBy("shard", "_chunk"))
            .applyInPandas(run, schema)
        )


@dataclass(frozen=True)
class _Search:
    """Search of a pandas frame of points, sorted by their keys."""

    keys: tuple[str, ...]
    dims: tuple[str, ...]
    k: int
    metric: str

    def leaves(self, points: pd.DataFrame) -> Leaves:
        return Leaves(points[list(self.dims)].to_numpy(float), self.k)

    def __call__(self, queries: pd.DataFrame, points: pd.DataFrame, leaves: Leaves) -> pd.DataFrame:
        row, at, value = leaves.nearest(queries[list(self.dims)].to_numpy(float), self.k, self.metric)
        row, at = row.astype(int), at.astype(int)
        out = {f"q_{c}": queries[f"q_{c}"].to_numpy()[row] for c in self.keys}
        out["distance"] = value
        out |= {f"p_{c}": points[f"p_{c}"].to_numpy()[at] for c in self.keys}
        out["y"] = points["y"].to_numpy()[at]
        out["rank"] = (np.arange(len(row)) - np.searchsorted(row, row) + 1).astype("int32")
        return pd.DataFrame(out)


def _sharded(p: DataFrame, dims: list[str], p_keys: list[str], n: int, shard: int) -> DataFrame:
    """Add ``shard``: cuts at the medians of a sample, and by hash of the key where a part is still too large."""
    sample = p.select(*p_keys, *dims).orderBy(F.xxhash64(*p_keys), *p_keys).limit(SAMPLE).select(*dims).toPandas().to_numpy(float)
    _, low, high = median_cells(sample, max(1, int(len(sample) * shard / n / 2)))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for start in range(0, len(batch), SLICE):
                part = batch.iloc[start : start + SLICE]
                away = box_distances(part[dims].to_numpy(float), low, high, "euclidean")
                yield part.assign(_cell=away.argmin(axis=1).astype("int32"))

    placed = stored(p.mapInPandas(run, T.StructType([*p.schema.fields, T.StructField("_cell", T.IntegerType())])))
    sizes = placed.groupBy("_cell").agg(F.ceil(F.count(F.lit(1)) / F.lit(shard)).cast("int").alias("_parts"))
    before = Window.orderBy("_cell").rowsBetween(Window.unboundedPreceding, -1)  # a row per cell
    sizes = lookup_side(sizes.withColumn("_first", F.coalesce(F.sum("_parts").over(before), F.lit(0)).cast("int")))
    split = F.pmod(F.xxhash64(*p_keys), F.col("_parts")).cast("int")
    return placed.join(sizes, "_cell").withColumn("shard", F.col("_first") + split).drop("_cell", "_parts", "_first")


def nearest_neighbours(
    queries: DataFrame,
    points: DataFrame,
    keys: Sequence[str],
    dims: Sequence[str],
    label: str,
    k: int,
    metric: str = "euclidean",
    shard: int | None = None,
) -> DataFrame:
    """The k nearest points of every query, by an index that is made for this call.

    Columns: q_<key>..., distance, p_<key>..., y, rank. ``keys`` identify rows in
    both frames, ``dims`` are compared, ``label`` of the points is returned as y.
    """
    return NeighbourIndex.build(points, keys, dims, label, k, shard).nearest(queries, k, metric)


def neighbour_average(weights: str = "uniform") -> Column:
    """Aggregate over a query's neighbours: plain or inverse-distance mean.

    If neighbours coincide with the query, the weighted mean is theirs alone.
    """
    plain = F.avg("y")
    if weights == "uniform":
        return plain
    exact = F.avg(F.when(F.col("distance") == 0, F.col("y")))
    weight = F.try_divide(F.lit(1.0), F.col("distance"))
    return F.coalesce(exact, F.try_divide(F.sum(F.col("y") * weight), F.sum(weight)))


def knn_predict(
    train: DataFrame,
    test: DataFrame,
    spec: PanelSpec,
    k: int = 5,
    weights: str = "uniform",
    metric: str = "euclidean",
) -> DataFrame:
    """(entity, period, y_true, y_pred) on the complete rows of ``test``."""
    features = list(spec.features)
    known = complete_cases(train.select(*spec.keys, spec.target, *features))
    scores = ZScores.of(known, features)
    asked = complete_cases(test.select(*spec.keys, spec.target, *features))
    near = nearest_neighbours(
        scores.apply(asked), scores.apply(known), spec.keys, features, spec.target, k, metric
    )
    means = near.groupBy(*[F.col(f"q_{c}").alias(c) for c in spec.keys]).agg(
        neighbour_average(weights).alias("y_pred")
    )
    return asked.select(*spec.keys, F.col(spec.target).alias("y_true")).join(means, spec.keys)
