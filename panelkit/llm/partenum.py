"""Jaccard self-join of texts on word shingles by PartEnum signatures.

Distinct shingle sets are the nodes; texts with the same set share one. Sizes
fall into bands that grow by 1 / threshold. Family f joins the bands f and f + 1
under one bound k on the number of shingles that a linked pair may differ in. It
partitions the shingle domain into n1 groups of n2 parts and enumerates the
subsets of n2 - k2 parts of a group: the shingles of a set inside such a subset,
hashed together, are one signature. k differences cannot spoil every subset, so
linked sets share a signature.

A signature is unusable for a set if it holds no shingle, or if it is common
(more than ``HOT`` clusters meet there). A set whose usable signatures outlast k
differences is found through them alone. The others also meet at their single
shingles that are not common; and those that have not more than k of these, which are
almost wholly common text, at the common signatures; so no link is lost. Inside a bucket each set first meets the smallest; only sets that are
still in different clusters then meet each other, so that a big group of copies
never becomes all its pairs. Candidates pass a bound on the differences (from
parity bits) and then an exact comparison of the sets.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from panelkit.llm.common import in_arrow, keys, mix, own_name, settled, shingle_sets, signed, text_chunks
from panelkit.llm.graph import components
from panelkit.runtime import stored

#: A signature is common when more than this many clusters share it.
HOT = 8
#: Sets of up to this size use subsets of two of three parts, larger ones single parts.
SMALL = 48
#: Spare groups, so that empty parts and common signatures can be borne.
SPARE, SPARE_GROUPS = 1.2, 2
#: Bytes of text for each bucket of signatures, and the fewest buckets.
BUCKET_BYTES, LEAST_BUCKETS = 64 << 20, 64
#: Parity bits for each shingle, in powers of two between these.
LEAST_BITS, MOST_BITS = 64, 1 << 14
#: Columns of 64 parity bits each that go with a set into the join of signatures.
SKETCH = [f"s{i}" for i in range(8)]


@cache
def bands(percent: int) -> np.ndarray:
    """First sizes of the bands, up to 2^40 shingles; the last entry closes the last band."""
    starts = [1]
    while starts[-1] < 1 << 40:
        starts.append(starts[-1] * 100 // percent + 1)
    return np.array(starts, np.int64)


@cache
def family(f: int, percent: int) -> tuple[int, int, int, int]:
    """(k, n1, n2, k2) of the pairs whose smaller set is in band ``f``."""
    most = int(bands(percent)[f + 1]) - 1
    k = (100 - percent) * (most + most * 100 // percent) // (100 + percent)
    n2, k2 = (3, 1) if most <= SMALL else (2, 1)
    n1 = int(np.ceil((k // (k2 + 1) + 1) * SPARE)) + SPARE_GROUPS
    return k, n1, n2, k2


@cache
def strengths(n2: int, k2: int) -> np.ndarray:
    """Differences needed to spoil all usable subsets of a group, by the bit mask of the usable ones."""
    subsets = list(combinations(range(n2), n2 - k2))
    out = np.zeros(1 << len(subsets), np.int64)
    for mask in range(1, len(out)):
        usable = [set(s) for i, s in enumerate(subsets) if mask >> i & 1]
        out[mask] = next(
            r for r in range(1, n2 + 1)
            if any(all(set(h) & s for s in usable) for h in combinations(range(n2), r))
        )
    return out


def band_of(sizes: np.ndarray, percent: int) -> np.ndarray:
    return np.searchsorted(bands(percent), sizes, "right") - 1


def signatures(values: np.ndarray, sizes: np.ndarray, f: int, percent: int, singles: bool = True):
    """Signatures of sets in family ``f``: (set number, signature) arrays, and each set's slack.

    ``values`` has the sorted sets one after the other. The slack is what the
    usable signatures bear beyond k; a set without slack also gets a signature
    for every shingle.
    """
    k, n1, n2, k2 = family(f, percent)
    parts, m = n1 * n2, len(sizes)
    number = np.repeat(np.arange(m), sizes)
    cell = number * parts + ((values >> np.uint64(32)) * np.uint64(parts) >> np.uint64(32)).astype(np.int64)
    first = np.flatnonzero(np.diff(cell, prepend=-1))
    total, full = np.zeros(m * parts, np.uint64), np.zeros(m * parts, bool)
    total[cell[first]] = np.add.reduceat(mix(values), first)
    full[cell[first]] = True
    total, full = total.reshape(m, n1, n2), full.reshape(m, n1, n2)
    mask = np.zeros((m, n1), np.int64)
    numbers, found = [], []
    group = np.arange(n1, dtype=np.uint64)
    for i, subset in enumerate(combinations(range(n2), n2 - k2)):
        usable = full[:, :, subset].any(axis=2)
        mask |= usable.astype(np.int64) << i
        tag = mix((np.uint64(f) << np.uint64(48)) + (group << np.uint64(4)) + np.uint64(i))
        sig = mix(total[:, :, subset].sum(axis=2, dtype=np.uint64) ^ tag)
        numbers.append(np.nonzero(usable)[0])
        found.append(sig[usable])
    slack = strengths(n2, k2)[mask].sum(axis=1) - k
    if singles and (slack <= 0).any():
        weak = (slack <= 0)[number]
        numbers.append(number[weak])
        found.append(single(values[weak], f))
    # the lowest bit tells a set's two families apart
    return np.concatenate(numbers), np.concatenate(found) & ~np.uint64(1) | np.uint64(f & 1), slack


def single(values: np.ndarray, f: int) -> np.ndarray:
    """The signature of each shingle alone, in family ``f``."""
    return mix(mix(values) ^ mix(np.array([f + 1 << 56], np.uint64))) & ~np.uint64(1) | np.uint64(f & 1)


def families(f: int) -> list[int]:
    """Families that a set of band ``f`` takes part in."""
    return [f, f - 1] if f else [f]


def slacks(values: np.ndarray, offsets: np.ndarray, percent: int) -> np.ndarray:
    """Slack of each set in its even and its odd family, as two rows; large where it has no such family."""
    sizes = np.diff(offsets)
    out, band = np.full((2, len(sizes)), 1 << 40, np.int64), band_of(sizes, percent)
    for b in np.unique(band[sizes > 0]):
        rows = np.flatnonzero(band == b)
        some = np.concatenate([values[offsets[r] : offsets[r + 1]] for r in rows])
        for f in families(int(b)):
            out[f & 1, rows] = signatures(some, sizes[rows], f, percent, False)[2]
    return out


def set_ids(values: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """A hash of each set; ``check`` of ``sets`` guards against two sets with one hash."""
    sizes = np.diff(offsets)
    out = np.zeros(len(sizes), np.uint64)
    some = np.flatnonzero(sizes)
    if len(some):
        out[some] = np.add.reduceat(mix(values ^ keys(1, 5)[0]), offsets[:-1][some])
    return mix(out + sizes.astype(np.uint64))


def parity(values: np.ndarray) -> bytes:
    """Bit i is set if an odd number of shingles falls on it; sets that differ little differ in few bits."""
    bits = LEAST_BITS
    while bits < min(2 * len(values), MOST_BITS):
        bits *= 2
    return np.packbits(np.bincount((values & np.uint64(bits - 1)).astype(np.int64), minlength=bits) & 1 == 1).tobytes()


def sketches(values: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Parity bits of fixed length for each set, as rows of 64-bit integers; one row for each of ``SKETCH``."""
    bits, m = 64 * len(SKETCH), len(offsets) - 1
    place = np.repeat(np.arange(m), np.diff(offsets)) * bits + (values & np.uint64(bits - 1)).astype(np.int64)
    odd = np.bincount(place, minlength=m * bits).reshape(m, bits) & 1 == 1
    return np.packbits(odd, axis=1).view(np.int64).reshape(m, len(SKETCH)).T


def may_link(percent: int) -> Column:
    """Whether two sets can be similar enough, by their sizes and sketches (those of the other with ``_b``)."""
    both = F.col("n") + F.col("n_b")
    apart = sum((F.bit_count(F.col(c).bitwiseXOR(F.col(f"{c}_b"))).cast("long") for c in SKETCH), F.lit(0).cast("long"))
    apart = F.greatest(apart, F.abs(F.col("n") - F.col("n_b")))
    return apart * (100 + percent) <= both * (100 - percent)


def parity_distance(a: bytes, b: bytes) -> int:
    """A lower bound on the number of differing shingles."""
    x, y = np.frombuffer(a, np.uint8), np.frombuffer(b, np.uint8)
    while len(x) > len(y):
        x = x[: len(x) // 2] ^ x[len(x) // 2 :]
    while len(y) > len(x):
        y = y[: len(y) // 2] ^ y[len(y) // 2 :]
    return int(np.bitwise_count(x ^ y).sum())


def _described(words: int, percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start, end, data, offsets in text_chunks(batch.column(1)):
                values, at = shingle_sets(data, offsets, words)
                ids = set_ids(values, at)
                yield pa.RecordBatch.from_arrays([
                    batch.column(0).slice(start, end - start),
                    batch.column(2).slice(start, end - start),
                    pa.array(np.diff(at)),
                    pa.array(signed(ids)),
                    pa.array(signed(set_ids(mix(values), at))),
                    *map(pa.array, slacks(values, at, percent)),
                    *(pa.array(np.ascontiguousarray(x)) for x in sketches(values, at)),
                    pa.array([parity(values[a:b]) for a, b in zip(at, at[1:])], pa.binary()),
                ], ["doc", "mark", "n", "set_id", "check", "slack0", "slack1", *SKETCH, "bits"])

    return run


def _signed_blobs(words: int, percent: int, buckets: int):
    """One row for each bucket and batch of texts: the sets, how many signatures each has there, and these."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for batch in batches:
            for _, _, data, offsets in text_chunks(batch.column(0), 3 << 20):
                values, at = shingle_sets(data, offsets, words)
                sizes, ids, band = np.diff(at), signed(set_ids(values, at)), band_of(np.diff(at), percent)
                fresh = [r for r in range(len(ids)) if sizes[r] and not (ids[r] in seen or seen.add(ids[r]))]
                rows, sigs = [], []
                for b in np.unique(band[fresh]) if fresh else []:
                    own = np.array([r for r in fresh if band[r] == b])
                    some = np.concatenate([values[at[r] : at[r + 1]] for r in own])
                    for f in families(int(b)):
                        number, sig, _ = signatures(some, sizes[own], f, percent)
                        rows.append(own[number])
                        sigs.append(sig)
                if not rows:
                    continue
                rows, sigs = np.concatenate(rows), np.concatenate(sigs)
                bucket = ((sigs >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32)).astype(np.int64)
                order = np.argsort(bucket * len(ids) + rows, kind="stable")
                rows, sigs, bucket = rows[order], sigs[order], bucket[order]
                edge = np.flatnonzero(np.diff(bucket, prepend=-1))
                out: list[list] = [[], [], [], []]
                for s, e in zip(edge, np.append(edge[1:], len(rows))):
                    own = rows[s:e]
                    start = np.flatnonzero(np.diff(own, prepend=-1))
                    place = np.arange(e - s) - np.repeat(start, np.diff(start, append=e - s))
                    head = np.flatnonzero(place % 255 == 0)  # a count has one byte
                    out[0].append(int(bucket[s]))
                    out[1].append(ids[own[head]].tobytes())
                    out[2].append(np.diff(head, append=e - s).astype(np.uint8).tobytes())
                    out[3].append(sigs[s:e].tobytes())
                yield pa.RecordBatch.from_arrays(
                    [pa.array(out[0], pa.int64()), *(pa.array(x, pa.binary()) for x in out[1:])],
                    ["bucket", "sets", "counts", "sigs"],
                )

    return run


def _unpacked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def out() -> pa.RecordBatch:
        rows = [pa.array(np.concatenate([p[i] for p in parts])) for i in (0, 1)]
        return pa.RecordBatch.from_arrays(rows, ["sig", "a"])

    parts, held = [], 0
    for batch in batches:
        for ids, counts, sigs in zip(*(batch.column(i) for i in (1, 2, 3))):
            ids = np.frombuffer(ids.as_py(), np.int64)
            ids = np.repeat(ids, np.frombuffer(counts.as_py(), np.uint8))
            parts.append((np.frombuffer(sigs.as_py(), np.int64), ids))
            held += len(ids)
            if held > 1 << 18:
                yield out()
                parts, held = [], 0
    if parts:
        yield out()


def _shared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """From rows in order of (sig, set): those of signatures with several sets, and the first set of each."""
    sig0 = set0 = None  # the last row so far
    lead0, told0 = None, False  # the first set of its signature, and whether that row is out
    for batch in batches:
        sig, own = (np.asarray(batch.column(i)) for i in (0, 1))
        if not len(sig):
            continue
        new = np.concatenate([[sig0 is None or sig[0] != sig0], sig[1:] != sig[:-1]])
        rep = ~new & (own == np.concatenate([[own[0] if set0 is None else set0], own[:-1]]))  # the same row again
        first = np.flatnonzero(new)
        run = np.cumsum(new) - 1
        leads = np.concatenate([[lead0 if lead0 is not None else own[0]], own[first]])
        lead = leads[run + 1]
        member = ~new & ~rep
        # a leader's own row goes out with its first member
        runs, at = np.unique(run[member], return_index=True)
        fresh = runs[(runs >= 0) | (not told0)]
        who = np.flatnonzero(member)
        late = who[at[np.isin(runs, fresh)]]
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.concatenate([x[late], x[who]])) for x in (sig,)]
            + [pa.array(np.concatenate([lead[late], own[who]])), pa.array(np.concatenate([lead[late], lead[who]]))],
            ["sig", "a", "lead"],
        )
        told0 = bool((runs == run[-1]).any()) or (not new.any() and told0)
        sig0, set0, lead0 = sig[-1], own[-1], lead[-1]


def _near(percent: int):
    """Keeps the pairs whose sizes and parity bits do not rule a link out."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n, m = (np.asarray(batch.column(c)).astype(np.int64) for c in ("n_a", "n_b"))
            most = (100 - percent) * (n + m) // (100 + percent)
            keep = np.abs(n - m) <= most
            x, y = batch.column("bits_a"), batch.column("bits_b")
            for i in np.flatnonzero(keep):
                keep[i] = parity_distance(x[i].as_py(), y[i].as_py()) <= most[i]
            yield batch.select(["a", "b"]).filter(pa.array(keep))

    return run


def _wanted_sets(words: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start, end, data, offsets in text_chunks(batch.column(1)):
                values, at = shingle_sets(data, offsets, words)
                wanted = np.asarray(batch.column(0).slice(start, end - start))
                hit = np.flatnonzero(signed(set_ids(values, at)) == wanted)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(wanted[hit]), pa.array([values[at[i] : at[i + 1]].tobytes() for i in hit], pa.binary())],
                    ["set_id", "members"],
                )

    return run


def _single_shingles(words: int, percent: int):
    """A signature for every shingle of a set, in its even or odd family, with what the set has beyond that family's k."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start, end, data, offsets in text_chunks(batch.column(2)):
                values, at = shingle_sets(data, offsets, words)
                wanted, odd = (np.asarray(batch.column(i).slice(start, end - start)) for i in (0, 1))
                for i in np.flatnonzero(signed(set_ids(values, at)) == wanted):
                    own = values[at[i] : at[i + 1]]
                    band = int(band_of(np.array([len(own)]), percent)[0])
                    f = next(f for f in families(band) if f & 1 == odd[i])
                    room = len(own) - family(f, percent)[0]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(signed(single(own, f))), pa.array(np.full(len(own), wanted[i])), pa.array(np.full(len(own), room))],
                        ["sig", "a", "room"],
                    )

    return run


def _linked(percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x, y, keep = batch.column("x"), batch.column("y"), []
            for i in range(len(x)):
                a, b = (np.frombuffer(s[i].as_py(), np.uint64) for s in (x, y))
                both = len(np.intersect1d(a, b, assume_unique=True))
                keep.append(100 * both >= percent * (len(a) + len(b) - both))
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return run


def jaccard_components(docs: DataFrame, id_col: str, text_col: str, words: int = 5, percent: int = 75) -> DataFrame:
    """(id_col, n_shingles long, component_id, cluster long, text_hash long) for every row of ``docs``.

    Words are runs without white space, with A-Z in lower case; a text's set holds
    its distinct ``words``-word shingles, or its whole sequence if it is shorter.
    Texts link when 100 * intersection >= ``percent`` * union. component_id is the
    smallest id that links reach, its own included. Null or wordless texts have
    an empty set and link with nothing. Rows with the same text link, also when
    they repeat an id; each stays a row. A null id stays null and takes part; its
    component is named by the ids that are not null. cluster numbers the
    components, also those without an id; it is null for an empty set. An empty
    table gives no rows.
    Other columns are not read and may have any names.

    Shingles and sets are known by 64-bit hashes; two sets with one hash raise.
    Texts are read whole, in chunks of a few MB.
    """
    spark = docs.sparkSession
    flat = docs.select(F.col(f"`{id_col}`").alias("doc"), F.col(f"`{text_col}`").alias("text"))
    id_type = flat.schema["doc"].dataType
    schema = T.StructType([
        T.StructField("doc", id_type), *(T.StructField(c, T.LongType()) for c in ("mark", "n", "set_id", "check", "slack0", "slack1", *SKETCH)),
        T.StructField("bits", T.BinaryType()),
    ])
    marked = flat.select("doc", "text", F.xxhash64("text").alias("mark"))
    rows = settled(marked.transform(in_arrow, _described(words, percent), schema))
    sets = stored(
        rows.where("n > 0").groupBy("set_id").agg(
            F.min("doc").alias("first"), F.min("check").alias("check"), F.max("check").alias("other"),
            *(F.first(c).alias(c) for c in ("n", "slack0", "slack1", *SKETCH, "bits")),
        )
    )
    if not sets.where("check <> other").isEmpty():
        raise ValueError("two different shingle sets share a hash; change the factors of the hash")

    total = flat.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    buckets = max(LEAST_BUCKETS, total // BUCKET_BYTES)
    shared = settled(
        flat.select("text")
        .transform(in_arrow, _signed_blobs(words, percent, buckets), "bucket long, sets binary, counts binary, sigs binary")
        .repartitionById(buckets, F.col("bucket").cast("int"))
        .transform(in_arrow, _unpacked, "sig long, a long")
        .sortWithinPartitions("sig", "a")
        .transform(in_arrow, _shared, "sig long, a long, lead long")
    )

    facts = sets.select("set_id", "n", "bits")
    known: DataFrame | None = None  # the sets already fetched, as (set_id, members)

    def links(pairs: DataFrame) -> DataFrame:
        """The true links among candidate ``pairs`` (a, b)."""
        nonlocal known
        near = stored(
            pairs.join(facts.toDF("a", "n_a", "bits_a"), "a").join(facts.toDF("b", "n_b", "bits_b"), "b")
            .transform(in_arrow, _near(percent), "a long, b long")
        )
        need = near.select(F.col("a").alias("set_id")).unionByName(near.select(F.col("b").alias("set_id"))).distinct()
        if known is not None:
            need = need.join(known, "set_id", "left_anti")
        where = stored(need.join(sets.select("set_id", "first"), "set_id"))  # small as a rule, and Spark sees its size
        got = settled(
            flat.join(where, F.col("doc").eqNullSafe(F.col("first"))).select("set_id", "text")
            .transform(in_arrow, _wanted_sets(words), "set_id long, members binary")
            .groupBy("set_id").agg(F.first("members").alias("members"))
        )
        known = got if known is None else known.unionByName(got)
        return stored(
            near.join(known.toDF("a", "x"), "a").join(known.toDF("b", "y"), "b")
            .transform(in_arrow, _linked(percent), "a long, b long")
        )

    star = links(shared.where("a <> lead").select("a", F.col("lead").alias("b")).distinct())
    found = components(star)
    placed = (
        shared.join(found, F.col("a") == F.col("node"), "left")
        .select("sig", "a", F.coalesce("root", "a").alias("root"))
    )
    meets = placed.groupBy("sig").agg(F.min("root").alias("low"), F.max("root").alias("high")).where("low <> high")
    placed = stored(placed.join(meets.select("sig"), "sig", "left_semi"))
    counts = placed.select("sig", "root").distinct().groupBy("sig").agg((F.count("*") > HOT).alias("hot"))
    placed = stored(placed.join(counts, "sig"))
    # sets that the common signatures of a family leave without slack meet there as well
    odd = F.col("sig").bitwiseAND(F.lit(1))
    common = placed.where("hot").groupBy("a", odd.alias("odd")).agg(F.count("*").alias("common"))
    bare = sets.select(F.col("set_id").alias("a"), F.posexplode(F.array("slack0", "slack1")).alias("odd", "slack"))
    weak = (
        bare.join(common.withColumn("odd", F.col("odd").cast("int")), ["a", "odd"], "left")
        .where("slack <= coalesce(common, 0)").select(F.col("a").alias("weak"), "odd")
    )
    weak = stored(weak)
    # these meet at their uncommon single shingles; what has too few of them as well, at the common signatures
    where = stored(weak.join(sets.select(F.col("set_id").alias("weak"), "first"), "weak"))
    fine = stored(
        flat.join(where, F.col("doc").eqNullSafe(F.col("first"))).select("weak", "odd", "text")
        .transform(in_arrow, _single_shingles(words, percent), "sig long, a long, room long").distinct()
        .join(found, F.col("a") == F.col("node"), "left").select("sig", "a", "room", F.coalesce("root", "a").alias("root"))
    )
    crowd = fine.select("sig", "root").distinct().groupBy("sig").agg(F.count("*").alias("roots")).where("roots > 1")
    fine = stored(fine.join(crowd, "sig"))
    bare = fine.where(F.col("roots") > HOT).groupBy(F.col("a").alias("weak"), odd.cast("int").alias("odd"))
    bare = bare.agg((F.count("*") >= F.max("room")).alias("bare")).where("bare").select("weak", "odd")
    cool = placed.where("not hot")
    warm = placed.where("hot").join(bare, (F.col("a") == F.col("weak")) & (odd == F.col("odd")), "left_semi")
    left = cool.unionByName(warm.select(cool.columns)).select("sig", "a", "root")
    left = left.unionByName(fine.where(F.col("roots") <= HOT).select("sig", "a", "root")).distinct()
    left = left.join(sets.select(F.col("set_id").alias("a"), "n", *SKETCH), "a")
    right = left.select("sig", F.col("a").alias("b"), *(F.col(c).alias(f"{c}_b") for c in ("root", "n", *SKETCH)))
    pairs = left.join(right, "sig").where((F.expr("root <> root_b and a < b")) & may_link(percent)).select("a", "b").distinct()
    found = components(star.unionByName(links(pairs)))

    cluster = sets.join(found, F.col("set_id") == F.col("node"), "left").select(
        "set_id", "first", F.coalesce("root", "set_id").alias("root")
    )
    named = cluster.join(cluster.groupBy("root").agg(F.min("first").alias("component")), "root").select(
        F.col("set_id").alias("set_key"), "component", "root"
    )
    return rows.join(named, (F.col("n") > 0) & (F.col("set_id") == F.col("set_key")), "left").select(
        F.col("doc").alias(id_col),
        F.col("n").alias("n_shingles"),
        F.when(F.col("n") > 0, F.col("component")).otherwise(F.col("doc")).alias("component_id"),
        F.when(F.col("n") > 0, F.col("root")).alias("cluster"),
        F.col("mark").alias("text_hash"),
    )


def keep_first(docs: DataFrame, id_col: str, text_col: str, words: int = 5, percent: int = 75) -> DataFrame:
    """``docs`` with one row of each group of near copies: that with the smallest id, then the smallest text hash.

    Null ids come last. Rows whose text has no word are all kept.
    """
    found = stored(jaccard_components(docs, id_col, text_col, words, percent).withColumnRenamed(id_col, "doc"))
    kinds = found.groupBy("cluster", "doc", "text_hash").agg(F.count("*").alias("n"))
    place = F.struct(F.col("doc").isNull().alias("no_doc"), "doc", "text_hash", "n")
    first = kinds.where("cluster is not null").groupBy("cluster").agg(F.min(place).alias("f")).select("f.doc", "f.text_hash", "f.n")
    blank = kinds.where("cluster is null").select("doc", "text_hash", F.lit(1).cast("long").alias("n"))
    names = [own_name(docs, f"first_{c}") for c in ("doc", "text_hash", "n")]
    mark = own_name(docs, "mark")
    doc, text_hash, n = (F.col(c) for c in names)
    rows = docs.withColumn(mark, F.xxhash64(f"`{text_col}`")).join(
        stored(first.unionByName(blank)).toDF(*names), (F.col(mark) == text_hash) & F.col(f"`{id_col}`").eqNullSafe(doc)
    )
    alike = rows.where(n > 1).dropDuplicates([id_col, mark])
    return rows.where(n == 1).unionByName(alike).select(*[f"`{c}`" for c in docs.columns])
