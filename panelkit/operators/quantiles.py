"""Exact quantiles of whole columns by distributed radix selection.

A double's bits, with the sign turned, are an integer of the same order. A scan counts the
leading 16 bits of all values, for all columns at once; the counts tell in which bin a
wanted rank lies, and the next scan looks only at values of that bin, 16 bits further. After
four scans all bits are known. As soon as the bins that matter hold few values, these are
fetched instead. Rows are never moved: only counts leave a task.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelkit.runtime import cached

#: Bits that a scan resolves, and the most values that are fetched to the driver.
BITS, FETCHED = 16, 100_000


def ordered_keys(values: np.ndarray) -> np.ndarray:
    """Unsigned integers in the order of the doubles; both zeros are one, NaN comes last."""
    values = np.where(np.isnan(values), np.nan, values + 0.0)
    bits = np.ascontiguousarray(values).view(np.int64)
    return (bits ^ ((bits >> 63) & np.int64(2**63 - 1))).view(np.uint64) ^ np.uint64(1 << 63)


def doubles(keys: np.ndarray) -> np.ndarray:
    """The doubles behind ``ordered_keys``."""
    bits = (np.asarray(keys, np.uint64) ^ np.uint64(1 << 63)).view(np.int64)
    return (bits ^ ((bits >> 63) & np.int64(2**63 - 1))).view(np.float64)


def _chosen(key: np.ndarray, prefixes: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """The keys that begin with one of ``prefixes``, and with which."""
    if not depth:
        return key, np.zeros(len(key), np.int64)
    head = key >> np.uint64(64 - depth)
    at = np.minimum(np.searchsorted(prefixes, head), len(prefixes) - 1)
    hit = prefixes[at] == head
    return key[hit], at[hit]


def _scan(batches: Iterator[pa.RecordBatch], active: dict[int, np.ndarray], depth: int, whole: bool) -> Iterator[pa.RecordBatch]:
    """Counts of the next bits of the values below ``active`` prefixes, or the values themselves, of one task."""
    found: dict[int, list[tuple[np.ndarray, np.ndarray]]] = {j: [] for j in active}
    for batch in batches:
        for j, prefixes in active.items():
            column = batch.column(j).drop_null()
            key, at = _chosen(ordered_keys(column.to_numpy(zero_copy_only=False)), prefixes, depth)
            if not whole:
                key = (at.astype(np.uint64) << np.uint64(BITS)) | ((key >> np.uint64(64 - depth - BITS)) & np.uint64((1 << BITS) - 1))
            found[j].append(np.unique(key, return_counts=True))
            if len(found[j]) == 16:
                found[j] = [_summed(found[j])]
    for j, parts in found.items():
        key, n = _summed(parts)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.full(len(key), j, np.int32)), pa.array(key.view(np.int64)), pa.array(n)], ["j", "key", "n"]
        )


def _summed(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    if not parts:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    key, place = np.unique(np.concatenate([p[0] for p in parts]), return_inverse=True)
    n = np.zeros(len(key), np.int64)
    np.add.at(n, place, np.concatenate([p[1] for p in parts]).astype(np.int64))
    return key, n


def _counted(df: DataFrame, active: dict[int, np.ndarray], depth: int, whole: bool) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    """One scan: per column the found keys in order, and how often they occur."""
    rows = df.mapInArrow(partial(_scan, active=active, depth=depth, whole=whole), "j int, key long, n long")
    table = rows.groupBy("j", "key").agg(F.sum("n").alias("n")).toArrow()
    j, key, n = (table.column(c).to_numpy() for c in ("j", "key", "n"))
    out = {}
    for column in active:
        mine = j == column
        keys = key[mine].view(np.uint64)
        order = np.argsort(keys)
        out[column] = keys[order], n[mine][order]
    return out


def column_quantiles(df: DataFrame, columns: Sequence[str], probs: Sequence[float]) -> dict[str, dict[float, float]]:
    """Linearly interpolated quantiles of each column's values: column -> prob -> quantile.

    Nulls do not count; a column without values has no entry. Columns are read as doubles and kept by the
    executors between the scans. The driver gets at most 65,536 counts for each column and wanted rank.
    """
    columns, probs = list(columns), [float(p) for p in probs]
    wide = df.select(*[F.col(f"`{c}`").cast("double").alias(f"v{i}") for i, c in enumerate(columns)])
    ranks: dict[int, dict[int, tuple[int, int]]] = {}  # column -> rank -> (prefix, rank among the keys with it)
    value: dict[tuple[int, int], int] = {}
    total: dict[int, int] = {}
    with cached(wide) as kept:
        active = {j: np.zeros(1, np.uint64) for j in range(len(columns))}
        for depth in range(0, 64, BITS):
            if not active:
                break
            counts = _counted(kept, active, depth, False)
            inside = 0
            for j, (key, n) in counts.items():
                if not depth:
                    total[j] = int(n.sum())
                    at = [p * (total[j] - 1) for p in probs] if total[j] else []
                    ranks[j] = {r: (0, r) for a in at for r in {int(np.floor(a)), int(np.ceil(a))}}
                ends = np.cumsum(n)
                group = key >> np.uint64(BITS)
                heads, used = [], set()
                for rank, (prefix, within) in ranks[j].items():
                    place = int(np.searchsorted(active[j], np.uint64(prefix)))
                    first = int(np.searchsorted(group, np.uint64(place)))
                    before = int(ends[first - 1]) if first else 0
                    hit = int(np.searchsorted(ends, before + within, "right"))
                    head = (prefix << BITS) | (int(key[hit]) & ((1 << BITS) - 1))
                    heads.append((rank, head, within - (int(ends[hit]) - int(n[hit]) - before)))
                    used.add(hit)
                inside += sum(int(n[h]) for h in used)
                ranks[j] = {rank: (head, within) for rank, head, within in heads}
            done = depth + BITS
            active = {j: np.array(sorted({h for h, _ in r.values()}), np.uint64) for j, r in ranks.items() if r}
            if done == 64:
                value = {(j, rank): head for j, r in ranks.items() for rank, (head, _) in r.items()}
            elif inside <= FETCHED and active:
                for j, (key, n) in _counted(kept, active, done, True).items():
                    ends, group = np.cumsum(n), key >> np.uint64(64 - done)
                    for rank, (head, within) in ranks[j].items():
                        first = int(np.searchsorted(group, np.uint64(head)))
                        before = int(ends[first - 1]) if first else 0
                        value[j, rank] = int(key[np.searchsorted(ends, before + within, "right")])
                break
    out: dict[str, dict[float, float]] = {}
    for j, c in enumerate(columns):
        for p in probs if total.get(j) else []:
            at = p * (total[j] - 1)
            low, high = doubles(np.array([value[j, int(np.floor(at))], value[j, int(np.ceil(at))]], np.uint64)).tolist()
            out.setdefault(c, {})[p] = low if low == high else low + (high - low) * float(at - np.floor(at))
    return out
