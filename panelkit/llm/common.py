"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from panelkit.runtime import stored

#: Characters that separate words, as a regular-expression class and as bytes.
SPACE = r"[\x20\x09-\x0D]"
WORD = r"[^\x20\x09-\x0D]+"

#: Text that is turned into arrays at once; longer texts are cut between words.
CHUNK_BYTES = 1 << 20

#: Most bytes of a batch for a Python worker. The JVM and the worker each hold a few batches beside the heap.
BATCH_BYTES, BATCH_SETTING = 8 << 20, "spark.sql.execution.arrow.maxBytesPerBatch"

_SEPARATOR = np.zeros(256, bool)
_SEPARATOR[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256, dtype=np.uint64) + np.uint64(1)
_LOWER[65:91] += np.uint64(32)


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """One of the tables kept as Parquet in ``folder``."""
    return spark.read.parquet(f"{folder}/{name}.parquet")


def release(spark: SparkSession) -> None:
    """Let Spark delete the shuffle files of finished jobs.

    They go when the driver's collector finds their plans unused, which a driver
    that only waits for jobs does not notice for a long time.
    """
    spark.sparkContext._jvm.System.gc()


def settled(df: DataFrame) -> DataFrame:
    """``stored``, and then the shuffle files that led to it may go."""
    out = stored(df)
    release(df.sparkSession)
    return out


def in_arrow(df: DataFrame, run: Callable[[Iterator], Iterator], schema) -> DataFrame:
    """``df.mapInArrow`` over batches of ``BATCH_BYTES``, after which the worker gives freed memory back to the system.

    Workers are kept for later tasks, and would keep what a large batch once needed; so would
    the JVM outside its heap. A limit that the session was given itself stays.
    """
    conf = df.sparkSession.conf
    if conf.get(BATCH_SETTING, None) is None:
        conf.set(BATCH_SETTING, f"{BATCH_BYTES}b")

    def lean(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from run(batches)
        finally:
            pa.default_memory_pool().release_unused()
            trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
            if trim:
                trim(0)

    if not any(set(".`") & set(c) for c in df.columns):
        return df.mapInArrow(lean, schema)
    # such names would be read as paths: they are others inside, and the old ones again outside
    plain = [c.translate({ord("."): "\u2024", ord("`"): "\u2018"}) for c in df.columns]
    inside = T.StructType([
        T.StructField(f.name.translate({ord("."): "\u2024", ord("`"): "\u2018"}), f.dataType) for f in schema
    ])
    return df.toDF(*plain).mapInArrow(lean, inside).toDF(*[f.name for f in schema])


def width(df: DataFrame) -> int:
    """Shuffle partitions of the session."""
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def own_name(df: DataFrame, name: str) -> str:
    """``name``, or the first of name_1, name_2, ... that no column of ``df`` has."""
    taken = {c.lower() for c in df.columns}
    out, n = name, 0
    while out.lower() in taken:
        n += 1
        out = f"{name}_{n}"
    return out


def col(name: str) -> Column:
    """A column by its exact name, dots and all."""
    return F.col("`" + name.replace("`", "``") + "`")


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit integers (the finaliser of splitmix64)."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def keys(n: int, salt: int) -> np.ndarray:
    """``n`` fixed random 64-bit numbers."""
    return mix(np.arange(1, n + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(salt << 32))


_PLACE = keys(4096, 1)


def _places(n: int) -> np.ndarray:
    global _PLACE
    if n > len(_PLACE):
        _PLACE = keys(2 * n, 1)
    return _PLACE


def word_hashes(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hash and first byte of every word of UTF-8 ``data``, with A-Z in lower case.

    A hash is the sum of byte times a random factor of its place, scrambled.
    """
    hashes, starts, at = [], [], 0
    while at < len(data):
        end = min(len(data), at + CHUNK_BYTES)
        if end < len(data):  # back to a separator, or on to the next one in a huge word
            cut = np.flatnonzero(_SEPARATOR[data[at:end]])
            if len(cut):
                end = at + int(cut[-1]) + 1
            else:
                step = end
                while step < len(data) and not _SEPARATOR[data[step]]:
                    step += 1
                end = step
        part = data[at:end]
        inside = np.flatnonzero(~_SEPARATOR[part])
        if len(inside):
            first = np.flatnonzero(np.diff(inside, prepend=-2) > 1)
            length = np.diff(first, append=len(inside))
            place = np.arange(len(inside)) - np.repeat(first, length)
            value = _LOWER[part[inside]] * _places(int(length.max()))[place]
            hashes.append(mix(np.add.reduceat(value, first) + length.astype(np.uint64)))
            starts.append(inside[first] + at)
        at = end
    if not hashes:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    return np.concatenate(hashes), np.concatenate(starts)


def text_chunks(column: pa.Array, limit: int = CHUNK_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Cut a string column: (first row, last row + 1, bytes, offsets of the rows in them).

    Between two texts a newline is put, so that no word runs over.
    Nulls count as empty. A chunk has one text at least, however long it is.
    """
    column = column.cast(pa.large_string())
    n = len(column)
    sizes = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + n + 1]
    body = column.buffers()[2]
    body = np.frombuffer(body, np.uint8) if body is not None and body.size else np.zeros(0, np.uint8)
    at = 0
    while at < n:
        end = max(at + 1, int(np.searchsorted(sizes, sizes[at] + limit, "right")) - 1)
        end = min(end, n)
        length = np.diff(sizes[at : end + 1])
        offsets = np.concatenate([[0], np.cumsum(length + 1)])
        data = np.full(int(offsets[-1]), 10, np.uint8)
        for k in range(end - at):
            data[offsets[k] : offsets[k] + length[k]] = body[sizes[at + k] : sizes[at + k + 1]]
        yield at, end, data, offsets
        at = end


def shingle_sets(data: np.ndarray, offsets: np.ndarray, words: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct hashes of the ``words``-word shingles of each text, and their offsets.

    A text with fewer words has its whole sequence as its only shingle.
    """
    hashes, starts = word_hashes(data)
    n = len(offsets) - 1
    first = np.searchsorted(starts, offsets)
    count = np.diff(first)
    factor = keys(words, 2)
    if len(hashes) >= words:
        rolled = np.zeros(len(hashes) - words + 1, np.uint64)
        for k in range(words):
            rolled += hashes[k : len(hashes) - words + 1 + k] * factor[k]
        rolled = mix(rolled)
    else:
        rolled = np.zeros(0, np.uint64)
    parts = []
    for k in range(n):
        if count[k] >= words:
            s = np.sort(rolled[first[k] : first[k + 1] - words + 1])
            parts.append(s[np.concatenate([[True], s[1:] != s[:-1]])])
        elif count[k]:
            w = hashes[first[k] : first[k + 1]]
            parts.append(mix((w * factor[: len(w)]).sum(dtype=np.uint64, keepdims=True) + np.uint64(words - len(w))))
        else:
            parts.append(np.zeros(0, np.uint64))
    return np.concatenate(parts), np.concatenate([[0], np.cumsum([len(p) for p in parts])])


def signed(x: np.ndarray) -> np.ndarray:
    """Unsigned 64-bit integers as the signed ones of a long column."""
    return np.ascontiguousarray(x, np.uint64).view(np.int64)
