"""Near-duplicate vectors by NN-descent.

Equal vectors of a label are one node. Every node keeps a list of its nearest
known neighbours. Lists start from windows over several orders of the vectors by
random hashes; then rounds of joins compare, for every node, its
neighbours and those that have it as a neighbour with each other, since the
neighbour of a neighbour is likely a neighbour. Only pairs with something new
are compared, and only what improves a list is sent. A list that is full of links is
saturated and may be twice as long in the next round. Where it is still full at its longest, its
whole cluster is compared in blocks, and also with the other saturated clusters that a
centre and a radius do not keep apart, so that no links are cut off by the length of
lists. A uniform sample of nodes is compared with all vectors; while the mean recall of those
with links falls short, lists get new starts from further orders and another round. If the last
round falls short of it, every cluster and single node is compared in blocks.

The hashes are cross-polytopes: the direction among a random set, and its opposites, that is
nearest to a vector from which the mean of its label was taken. What all vectors of a label
share thus does not blur the orders.
"""

from __future__ import annotations

import logging
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from panelkit.llm.common import in_arrow, release, width
from panelkit.llm.graph import components
from panelkit.runtime import stored

#: Length of a list at first and at most, and most nodes that have a node as a neighbour which join at it.
NEIGHBOURS, LONGEST = 12, 96
#: Orders of a start, hashes of each, most directions of a hash, and nodes of a window.
ORDERS, HASHES, DIRECTIONS, WINDOW = 8, 4, 64, 32
#: Rounds before the first audit and at most; a round that changes a smaller share of lists ends the wait for it.
ROUNDS, MOST_ROUNDS, STILL = 2, 6, 0.002
#: Nodes of an audit and the mean recall of those with links that is asked for.
AUDIT, RECALL = 4096, 0.97
#: Nodes of a block of a saturated cluster, and clusters of a block of centres.
BLOCK, CENTRES = 256, 2048
#: Angle by which the bound on two clusters is widened, for rounding.
SLACK = 1e-5

log = logging.getLogger(__name__)


def unit(column: pa.Array, rows: slice | np.ndarray | None = None) -> np.ndarray:
    """Vectors of one length as rows of length 1, in double precision."""
    n = len(column)
    x = np.asarray(column.flatten()).astype(np.float64).reshape(n, -1 if n else 0)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def _summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sums of the unit vectors of each label and length, as far as a batch has them."""
    for batch in batches:
        size = np.diff(np.asarray(batch.column("emb").offsets))
        for d in np.unique(size):
            own = batch.filter(pa.array(size == d))
            grp, place = np.unique(np.asarray(own.column("grp")), return_inverse=True)
            total = np.zeros((len(grp), int(d)))
            np.add.at(total, place, unit(own.column("emb")))
            yield pa.RecordBatch.from_arrays(
                [pa.array(grp), pa.array(list(total), pa.list_(pa.float64())), pa.array(np.bincount(place))], ["grp", "total", "n"]
            )


def _means(nodes: DataFrame) -> DataFrame:
    """(grp, mean): the mean unit vector of each label and length."""
    parts = nodes.select("grp", "emb").transform(in_arrow, _summed, "grp long, total array<double>, n long")
    parts = parts.select("grp", "n", F.posexplode("total").alias("at", "x"))
    sums = parts.groupBy("grp", "at").agg((F.sum("x") / F.sum("n")).alias("x"))
    return sums.groupBy("grp").agg(F.transform(F.array_sort(F.collect_list(F.struct("at", "x"))), lambda s: s["x"]).alias("mean"))


def _coded(seed: int):
    """The place of every vector in each order: its nearest directions under some hashes, one after the other."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            size = np.diff(np.asarray(batch.column("emb").offsets))
            for d in np.unique(size):
                own = batch.filter(pa.array(size == d))
                mean = np.asarray(own.column("mean").flatten()).reshape(own.num_rows, -1)
                x = unit(own.column("emb")) - mean
                m = min(int(d), DIRECTIONS)
                for t in range(ORDERS):
                    code = np.zeros(own.num_rows, np.int64)
                    for h in range(HASHES):
                        at = x @ np.random.default_rng([seed, t, h, int(d)]).standard_normal((int(d), m))
                        best = np.abs(at).argmax(axis=1)
                        code = code * (2 * DIRECTIONS) + 2 * best + (at[np.arange(len(at)), best] < 0)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(own.num_rows, t)), own.column("grp"), pa.array(code), own.column("node"), own.column("emb")],
                        ["t", "grp", "code", "node", "emb"],
                    )

    return run


def _top(nodes: np.ndarray, sims: np.ndarray, k: int) -> list[np.ndarray]:
    """The ``k`` nearest others of each row of a square of similarities."""
    np.fill_diagonal(sims, -2)
    k = min(k, len(nodes) - 1)
    at = np.argpartition(-sims, k - 1, axis=1)[:, :k]
    row = np.repeat(np.arange(len(nodes)), k)
    return [nodes[row], nodes[at.ravel()], sims[row, at.ravel()]]


def _windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Nearest neighbours within overlapping windows of rows in order of (t, grp, code)."""

    def flush(rows: pa.Table) -> Iterator[pa.RecordBatch]:
        if rows.num_rows > 1:
            nodes = np.asarray(rows.column("node"))
            x = unit(rows.column("emb").combine_chunks())
            parts = _top(nodes, x @ x.T, NEIGHBOURS)
            yield pa.RecordBatch.from_arrays([pa.array(p) for p in parts], ["node", "nbr", "sim"])

    held: pa.Table | None = None
    for batch in batches:
        rows = pa.Table.from_batches([batch.select(["t", "grp", "node", "emb"])])
        if held is not None:
            rows = pa.concat_tables([held, rows]).combine_chunks()
        t, grp = (np.asarray(rows.column(c)) for c in ("t", "grp"))
        cut = np.flatnonzero((np.diff(t) != 0) | (np.diff(grp) != 0)) + 1
        edges = [0, *cut.tolist(), rows.num_rows]
        for i, (s, e) in enumerate(zip(edges, edges[1:])):
            last = i == len(edges) - 2
            at = s
            while at < e and (e - at > WINDOW or not last):
                yield from flush(rows.slice(at, min(WINDOW, e - at)))
                if at + WINDOW >= e:
                    at = e
                else:
                    at += WINDOW // 2
            held = rows.slice(at) if last else None
    if held is not None:
        yield from flush(held)


def _groups(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[pa.Table]:
    """Consecutive rows with equal keys, as tables; they must be few."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        change = np.zeros(batch.num_rows, bool)
        for k in keys:
            v = np.asarray(batch.column(k))
            change[1:] |= v[1:] != v[:-1]
        edges = [0, *np.flatnonzero(change).tolist(), batch.num_rows]
        for s, e in zip(edges, edges[1:]):
            part = batch.slice(s, e - s)
            if held and s == 0 and any(held[-1].column(k)[0] != part.column(k)[0] for k in keys):
                yield pa.Table.from_batches(held)
                held = []
            held.append(part)
            if e < batch.num_rows:
                yield pa.Table.from_batches(held)
                held = []
    if held:
        yield pa.Table.from_batches(held)


def _joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """What each group's members tell each other: pairs that improve the first one's list."""
    out: list[list[np.ndarray]] = []
    held = 0

    def batch_of() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in zip(*out)], ["node", "nbr", "sim"])

    for group in _groups(batches, ["g"]):
        nodes, first = np.unique(np.asarray(group.column("u")), return_index=True)
        fresh = np.zeros(len(nodes), bool)
        every = np.asarray(group.column("u"))
        np.logical_or.at(fresh, np.searchsorted(nodes, every), np.asarray(group.column("fresh")) > 0)
        if len(nodes) < 2 or not fresh.any():
            continue
        rows = group.take(first)
        x = unit(rows.column("emb").combine_chunks())
        sims = x @ x.T
        np.fill_diagonal(sims, -2)
        better = (sims > np.asarray(rows.column("worst"))[:, None]) & (fresh[:, None] | fresh[None, :])
        i, j = np.nonzero(better)
        if len(i):
            out.append([nodes[i], nodes[j], sims[i, j]])
            held += len(i)
        if held > 1 << 17:
            yield batch_of()
            out, held = [], 0
    if out:
        yield batch_of()


def _counted(threshold: float):
    """Links (weighted by copies) of each node in a pair of blocks, of a cluster (root = far) or of two."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in _groups(batches, ["root", "far", "p", "q"]):
            nodes, part, copies = (np.asarray(group.column(c)) for c in ("node", "part", "copies"))
            root, far, p, q = (group.column(c)[0].as_py() for c in ("root", "far", "p", "q"))
            x = unit(group.column("emb").combine_chunks())
            linked = x @ x.T >= threshold
            np.fill_diagonal(linked, False)
            if root != far or p != q:
                linked &= part[:, None] != part[None, :]
            n = len(nodes)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(n, root)), pa.array(np.full(n, far)), pa.array(nodes), pa.array(linked @ copies)], ["root", "far", "node", "links"]
            )

    return run


def _centred(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A direction for each cluster: the mean of the vectors of its first block."""
    for group in _groups(batches, ["root"]):
        x = unit(group.column("emb").combine_chunks())
        mean = x.mean(axis=0)
        if np.linalg.norm(mean) < 1e-6:
            mean = x[0]
        yield pa.RecordBatch.from_arrays([group.column("root").slice(0, 1).combine_chunks(), pa.array([mean / np.linalg.norm(mean)])], ["root", "centre"])


def _spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Angle between each row's vector and the centre of its cluster."""
    for batch in batches:
        size = np.diff(np.asarray(batch.column("emb").offsets))
        for d in np.unique(size):
            own = batch.filter(pa.array(size == d))
            cos = np.einsum("ij,ij->i", unit(own.column("emb")), unit(own.column("centre")))
            yield pa.RecordBatch.from_arrays([own.column("root"), pa.array(np.arccos(np.clip(cos, -1, 1)))], ["root", "angle"])


def _close(threshold: float):
    """Pairs of clusters of two blocks that the triangle inequality on angles does not keep apart."""
    reach = float(np.arccos(np.clip(threshold, -1, 1))) + SLACK

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in _groups(batches, ["grp", "p", "q"]):
            roots, block, radius = (np.asarray(group.column(c)) for c in ("root", "block", "radius"))
            x = unit(group.column("centre").combine_chunks())
            near = np.arccos(np.clip(x @ x.T, -1, 1)) <= radius[:, None] + radius[None, :] + reach
            near &= roots[:, None] < roots[None, :]
            if group.column("p")[0] != group.column("q")[0]:
                near &= block[:, None] != block[None, :]
            i, j = np.nonzero(near)
            yield pa.RecordBatch.from_arrays([pa.array(roots[i]), pa.array(roots[j])], ["root", "far"])

    return run


def _lists(found: DataFrame, size: int, lengths: DataFrame | None = None) -> DataFrame:
    """(node, most, list array of (sim, nbr, fresh)) from (node, nbr, sim, fresh) rows, the best ``most`` first.

    ``lengths`` says how long a node's list may be, where it is not ``size``.
    """
    one = found.groupBy("node", "nbr").agg(F.max("sim").alias("sim"), F.min("fresh").alias("fresh"))
    every = one.groupBy("node").agg(F.sort_array(F.collect_list(F.struct("sim", "nbr", "fresh")), asc=False).alias("list"))
    every = every.join(lengths, "node", "left") if lengths is not None else every.withColumn("most", F.lit(None).cast("int"))
    most = F.coalesce("most", F.lit(size))
    return stored(every.select("node", most.alias("most"), F.slice("list", F.lit(1), most).alias("list")))


def _full(threshold: float) -> Column:
    """True for lists without room that hold nothing but links."""
    return (F.size("list") >= F.col("most")) & (F.element_at("list", -1)["sim"] >= threshold)


def _started(nodes: DataFrame, seed: int) -> DataFrame:
    """(node, nbr, sim) of neighbours within windows over orders by random hashes."""
    n = 2 * width(nodes)
    kind = nodes.schema["emb"].dataType.simpleString()
    return (
        nodes.select("grp", "node", "emb").join(_means(nodes), "grp")
        .transform(in_arrow, _coded(seed), f"t long, grp long, code long, node long, emb {kind}")
        .repartitionByRange(n, "t", "grp", "code", "node").sortWithinPartitions("t", "grp", "code", "node")
        .transform(in_arrow, _windows, "node long, nbr long, sim double")
    )


def _round(nodes: DataFrame, lists: DataFrame, size: int, threshold: float) -> DataFrame:
    """Lists after a neighbours-of-neighbours join; saturated ones may be twice as long."""
    edges = lists.select(F.col("node").alias("g"), F.inline("list")).select("g", F.col("nbr").alias("u"), "sim", "fresh")
    place = F.row_number().over(Window.partitionBy("u").orderBy(F.col("sim").desc(), "g"))
    back = edges.withColumn("place", place).where(F.col("place") <= size).select(F.col("u").alias("g"), F.col("g").alias("u"), "fresh")
    members = edges.select("g", "u", "fresh").unionByName(back).unionByName(
        lists.select(F.col("node").alias("g"), F.col("node").alias("u"), F.lit(0).alias("fresh"))
    )
    most = F.when(_full(threshold), F.least(F.col("most") * 2, F.lit(max(size, LONGEST)))).otherwise(F.col("most"))
    worst = F.when(F.size("list") >= most, F.element_at("list", -1)["sim"]).otherwise(F.lit(-1.5))
    facts = nodes.select("node", "emb").join(lists.select("node", worst.alias("worst")), "node").withColumnRenamed("node", "u")
    news = (
        members.join(facts, "u").repartition(4 * width(nodes), "g").sortWithinPartitions("g")
        .select("g", "u", "fresh", "worst", "emb").transform(in_arrow, _joined, "node long, nbr long, sim double")
    )
    old = lists.select("node", F.inline("list")).select("node", "nbr", "sim", F.lit(0).alias("fresh"))
    return _lists(news.withColumn("fresh", F.lit(1)).unionByName(old), size, lists.select("node", most.alias("most")))


def _edges(lists: DataFrame, threshold: float) -> DataFrame:
    rows = lists.select("node", F.inline("list")).where(F.col("sim") >= threshold)
    return rows.select(F.least("node", "nbr").alias("a"), F.greatest("node", "nbr").alias("b")).distinct()


def _neighbours(members: DataFrame, threshold: float) -> DataFrame:
    """(root, far), root < far, of clusters that may hold links between them; ``members`` are (root, grp, block, node, emb)."""
    n = width(members)
    first = members.where("block = 0").select("root", "emb").repartition(n, "root").sortWithinPartitions("root")
    centres = first.transform(in_arrow, _centred, "root long, centre array<double>")
    told = members.select("root", "emb").join(centres, "root").select("root", "emb", "centre").transform(in_arrow, _spread, "root long, angle double")
    some = members.groupBy("root").agg(F.first("grp").alias("grp")).join(told.groupBy("root").agg(F.max("angle").alias("radius")), "root").join(centres, "root")
    some = stored(some)
    sizes = some.groupBy("grp").agg(F.ceil(F.count("*") / CENTRES).cast("long").alias("blocks"))
    some = some.join(sizes, "grp").withColumn("block", F.pmod(F.xxhash64("root", F.lit(5)), F.col("blocks")))
    some = some.withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
    dealt = some.select("grp", F.least("block", "other").alias("p"), F.greatest("block", "other").alias("q"), "root", "block", "radius", "centre")
    dealt = dealt.repartition(n, "grp", "p", "q").sortWithinPartitions("grp", "p", "q")
    return stored(dealt.transform(in_arrow, _close(threshold), "root long, far long"))


def _links(nodes: DataFrame, lists: DataFrame, threshold: float, every: bool = False) -> tuple[DataFrame, DataFrame]:
    """(node, links) and (node, root), with saturated clusters, or ``every`` one, compared whole and with each other."""
    edges = stored(_edges(lists, threshold))
    found = stored(components(edges))
    if every:
        found = stored(nodes.select("node").join(found, "node", "left").select("node", F.coalesce("root", "node").alias("root")))
        dense = found.select("root").distinct()
    else:
        full = lists.where(_full(threshold)).select("node")
        dense = found.join(full, "node", "left_semi").select("root").distinct()
    dense = stored(dense)
    members = found.join(dense, "root", "left_semi")
    sizes = stored(members.groupBy("root").agg(F.ceil(F.count("*") / BLOCK).cast("long").alias("blocks")))
    members = members.join(sizes, "root").join(nodes.select("node", "grp", "emb", "copies"), "node")
    members = stored(members.withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks"))))
    # a cluster's first block may be empty by chance: its lowest one counts as the first
    lowest = members.groupBy("root").agg(F.min("block").alias("lowest"))
    pairs = _neighbours(members.join(lowest, "root").withColumn("block", F.col("block") - F.col("lowest")), threshold)

    other = F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)).alias("other")
    within = members.select("root", F.col("root").alias("far"), "node", "block", "copies", "emb", other).select(
        "root", "far", F.least("block", "other").alias("p"), F.greatest("block", "other").alias("q"), "node", F.col("block").alias("part"), "copies", "emb"
    )
    ends = [pairs.select("root", "far", F.col(a).alias("own"), F.col(b).alias("there"), F.lit(k).cast("long").alias("part")) for k, (a, b) in enumerate((("root", "far"), ("far", "root")))]
    across = ends[0].unionByName(ends[1]).join(sizes.withColumnRenamed("root", "there"), "there")
    across = across.join(members.select(F.col("root").alias("own"), "node", "block", "copies", "emb"), "own")
    across = across.select("root", "far", "part", "node", "block", "copies", "emb", other).select(
        "root", "far", F.when(F.col("part") == 0, F.col("block")).otherwise(F.col("other")).alias("p"),
        F.when(F.col("part") == 0, F.col("other")).otherwise(F.col("block")).alias("q"), "node", "part", "copies", "emb",
    )
    dealt = within.unionByName(across).repartition(width(nodes), "root", "far", "p", "q").sortWithinPartitions("root", "far", "p", "q")
    told = dealt.transform(in_arrow, _counted(threshold), "root long, far long, node long, links long")
    told = stored(told.groupBy("root", "far", "node").agg(F.sum("links").alias("links")))
    whole = told.groupBy("node").agg(F.sum("links").alias("links"))
    bridges = told.where("root <> far and links > 0").select(F.col("root").alias("a"), F.col("far").alias("b")).distinct()
    rest = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    sparse = rest.join(members.select(F.col("node").alias("a")), "a", "left_anti")
    sparse = sparse.join(nodes.select(F.col("node").alias("b"), "copies"), "b").groupBy(F.col("a").alias("node")).agg(F.sum("copies").alias("links"))
    merged = components(bridges).select(F.col("node").alias("root"), F.col("root").alias("top"))
    found = found.join(merged, "root", "left").select("node", F.coalesce("top", "root").alias("root"))
    return stored(whole.unionByName(sparse)), stored(found)


def _audited(sample, threshold: float):
    """Links of each node of the sample, by comparing it with all nodes, some hundreds at a time."""
    keys = [(r.node, r.grp) for r in sample]
    sizes = np.array([len(r.emb) for r in sample])
    rows = [np.array(r.emb, np.float64) / np.linalg.norm(np.array(r.emb, np.float64)) for r in sample]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            have = np.diff(np.asarray(batch.column("emb").offsets))
            for d in np.unique(have):
                own = batch.filter(pa.array(have == d))
                asked = np.flatnonzero(sizes == d)
                if not len(asked):
                    continue
                there = np.stack([rows[i] for i in asked]).T
                want = np.array([keys[i] for i in asked], np.int64)
                found = np.zeros(len(asked), np.int64)
                for at in range(0, own.num_rows, BLOCK):
                    some = own.slice(at, BLOCK)
                    grp, node, copies = (np.asarray(some.column(c)) for c in ("grp", "node", "copies"))
                    hit = (unit(some.column("emb")) @ there >= threshold) & (grp[:, None] == want[:, 1]) & (node[:, None] != want[:, 0])
                    found += copies @ hit
                yield pa.RecordBatch.from_arrays([pa.array(want[:, 0]), pa.array(found)], ["node", "truth"])

    return run


def audit(nodes: DataFrame, links: DataFrame, threshold: float, sample: int = AUDIT) -> tuple[float, float]:
    """Mean share of their true links that nodes have, and its standard error, from a uniform sample of nodes.

    Every node that has links counts alike, however many they are. Without any the mean is 1.
    """
    rows = nodes.orderBy(F.xxhash64("node", F.lit(3)), "node").limit(sample).select("node", "grp", "emb").collect()
    if not rows:
        return 1.0, 0.0
    truth = nodes.select("node", "grp", "copies", "emb").transform(in_arrow, _audited(rows, threshold), "node long, truth long")
    truth = truth.groupBy("node").agg(F.sum("truth").alias("truth")).where("truth > 0")
    share = F.coalesce("links", F.lit(0)) / F.col("truth")
    got = truth.join(links, "node", "left").agg(F.count("*"), F.avg(share), F.stddev_pop(share)).first()
    return (1.0, 0.0) if not got[0] else (float(got[1]), float(got[2]) / got[0] ** 0.5)


def near_duplicates(
    vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label",
    threshold: float = 0.93, size: int = NEIGHBOURS, recall: float = RECALL, seed: int = 29,
) -> DataFrame:
    """(id_col, n_links long, component_id, kept boolean) for every row of ``vectors``.

    Rows link when their labels are equal and not null and the cosine of their
    vectors, in double precision, is ``threshold`` or more. Vectors that are null, empty, zero
    or hold null or non-finite components, or have different lengths, link with
    nothing. component_id is the smallest id that links reach; kept says that it is
    the row's own. Repeated rows link like others; null ids take part, name no
    component, and are not kept. An empty table gives no rows.

    Links between equal vectors are exact; others are found by the search, whose
    recall is audited against brute force on ``AUDIT`` nodes and logged: the mean over the nodes with
    links, each counting alike. Where it stays below ``recall``, all clusters and single nodes are
    compared. Vectors are known by two hashes; two that share the first and not the second raise.
    """
    kind = "float" if vectors.schema[vector_col].dataType.simpleString() == "array<float>" else "double"
    rows = vectors.select(
        F.col(f"`{id_col}`").alias("vec"), F.col(f"`{label_col}`").alias("label"),
        F.transform(F.col(f"`{vector_col}`").cast(f"array<{kind}>"), lambda x: x + F.lit(0).cast(kind)).alias("emb"),
    )
    bad = F.exists("emb", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    valid = F.col("label").isNotNull() & F.col("emb").isNotNull() & ~bad & F.exists("emb", lambda x: x != 0)
    rows = rows.withColumn("node", F.when(valid, F.xxhash64("label", "emb")))
    grp, second = F.xxhash64("label", F.size("emb")), F.xxhash64(F.lit(11), "emb", "label")
    clash = F.raise_error(F.lit("two vectors share a hash")).cast("long")
    nodes = stored(
        rows.where("node is not null").groupBy("node").agg(
            F.min("vec").alias("first"), F.count("*").alias("copies"), F.first("emb").alias("emb"), F.first(grp).alias("grp"),
            F.min(second).alias("least"), F.max(second).alias("largest"),
        )
        .withColumn("copies", F.when(F.col("least") == F.col("largest"), F.col("copies")).otherwise(clash)).drop("least", "largest")
    )
    lists = _lists(_started(nodes, seed).withColumn("fresh", F.lit(1)), size)
    release(vectors.sparkSession)
    links = found = None
    got = 0.0
    for k in range(1, MOST_ROUNDS + 1):
        lists = _round(nodes, lists, size, threshold)
        release(vectors.sparkSession)
        news = lists.select(F.avg(F.aggregate("list", F.lit(0), lambda s, x: s + x["fresh"]) / F.size("list"))).first()[0] or 0.0
        if k < ROUNDS and news >= STILL:
            continue
        links, found = _links(nodes, lists, threshold)
        got, error = audit(nodes, links, threshold)
        log.info("round %d: %.4f of the lists new, mean recall %.4f, standard error %.4f", k, news, got, error)
        if got >= recall:
            break
        if k < MOST_ROUNDS:
            more = _started(nodes, seed + 1000 * k).withColumn("fresh", F.lit(1))
            old = lists.select("node", F.inline("list")).select("node", "nbr", "sim", F.lit(0).alias("fresh"))
            lists = _lists(more.unionByName(old), size, lists.select("node", "most"))
    if got < recall:
        log.warning("mean recall of the audited nodes is %.3f, below %.3f: all clusters are compared", got, recall)
        links, found = _links(nodes, lists, threshold, every=True)
    named = nodes.join(found, "node", "left").select("node", "first", "copies", F.coalesce("root", "node").alias("root"))
    per = named.groupBy("root").agg(F.min("first").alias("component_id"))
    facts = named.join(per, "root").join(links, "node", "left").select(
        F.col("node").alias("key"), "component_id", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links")
    )
    out = rows.select("vec", "node").join(facts, F.col("node") == F.col("key"), "left")
    component = F.when(F.col("node").isNull(), F.col("vec")).otherwise(F.col("component_id"))
    return out.select(
        F.col("vec").alias(id_col), F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"),
        F.coalesce(F.col("vec") == component, F.lit(False)).alias("kept"),
    )
