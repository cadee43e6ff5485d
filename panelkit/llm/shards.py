"""Two-pass external shuffle into shards.

Pass one scatters the rows uniformly into buckets that fit a task's memory, by a
seeded hash of id and text. Pass two shuffles each bucket by Fisher and Yates.
Buckets in order, and rows in their bucket's order, then form one uniform random
order of the whole table, which is cut into shards of equal row counts. A task
holds neighbouring buckets, so it writes a stretch of that order: a shard is a few
files, each in the order of the slots.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from panelkit.llm.common import in_arrow, own_name, release, width
from panelkit.runtime import broadcast_if_small, scratch_dir, stored

#: Bytes of text that a bucket holds about, and the fewest buckets.
BUCKET_BYTES, LEAST_BUCKETS = 16 << 20, 256


def fisher_yates(n: int, seed: int, bucket: int) -> np.ndarray:
    """Where each of ``n`` rows goes: numpy's permutation is the shuffle of Fisher and Yates."""
    return np.random.default_rng([seed, bucket]).permutation(n)


def _shuffled(seed: int, stretch: str, bucket: str, mark: str, place: str):
    def flush(parts: list[pa.RecordBatch], base: int) -> Iterator[pa.RecordBatch]:
        rows = pa.Table.from_batches(parts)
        marks = np.asarray(rows.column(mark).combine_chunks())
        order = np.argsort(marks, kind="stable")  # the order in which rows came is not repeatable
        at = np.empty(len(order), np.int64)
        at[order] = fisher_yates(len(order), seed, rows.column(bucket)[0].as_py())
        rows = rows.set_column(rows.schema.get_field_index(place), place, pa.array(base + at))
        yield from rows.take(np.argsort(at)).to_batches(max_chunksize=1024)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows come by stretch and bucket; their places count from 0 in each stretch."""
        parts: list[pa.RecordBatch] = []
        now, base = (None, None), 0
        for batch in batches:
            ids = np.asarray(batch.column(bucket))
            cuts = [0, *(np.flatnonzero(np.diff(ids)) + 1).tolist(), len(ids)]
            for s, e in zip(cuts, cuts[1:]):
                if s == e:
                    continue
                own = (batch.column(stretch)[s].as_py(), ids[s])
                if parts and own != now:
                    yield from flush(parts, base)
                    base = base + sum(len(p) for p in parts) if own[0] == now[0] else 0
                    parts = []
                now = own
                parts.append(batch.slice(s, e - s))
        if parts:
            yield from flush(parts, base)

    return run


def shards(
    docs: DataFrame, id_col: str, text_col: str, count: int = 16, seed: int = 23, bucket_bytes: int = BUCKET_BYTES,
) -> DataFrame:
    """``docs`` with (shard int, slot long): written by shard to the shared folder, and read from there.

    Law ``rows``: shards 0 to ``count`` - 1 differ by one row at most; slots run
    from 0 without gaps. Reruns agree whatever the partitions: the order comes from
    hashes of id and text and from a seed for each bucket. Rows equal in both
    are alike and share a bucket. The files of a shard, by name, hold its rows in
    the order of their slots. Null ids and texts are values; an empty table gives no rows. Own columns named shard or slot give way to the new ones.
    """
    spark = docs.sparkSession
    docs = docs.select(*[f"`{c}`" for c in docs.columns if c.lower() not in ("shard", "slot")])
    stretch, bucket, mark, place, start = (own_name(docs, c) for c in ("stretch", "bucket", "mark", "place", "start"))
    total, rows = docs.agg(F.sum(F.octet_length(F.col(f"`{text_col}`"))), F.count("*")).first()
    buckets = max(LEAST_BUCKETS, (total or 0) // bucket_bytes)
    parts = min(buckets, max(width(docs), buckets // 8))
    hashed = docs.withColumn(mark, F.xxhash64(F.lit(seed), f"`{id_col}`", f"`{text_col}`"))
    keyed = hashed.withColumn(bucket, F.pmod(F.xxhash64(F.lit(seed + 1), mark), F.lit(buckets)))
    keyed = keyed.withColumn(stretch, F.expr(f"cast(`{bucket}` * {parts} div {buckets} as int)"))
    # one row for each task of pass two, so their running sum is small at any size
    counts = stored(keyed.groupBy(stretch).agg(F.count("*").alias("rows")))
    before = Window.orderBy(stretch).rowsBetween(Window.unboundedPreceding, -1)
    key = own_name(docs, "stretch_key")
    starts = stored(counts.select(F.col(stretch).alias(key), F.coalesce(F.sum("rows").over(before), F.lit(0)).alias(start)))
    keyed = keyed.withColumn(place, F.lit(0).cast("long"))
    dealt = keyed.repartitionById(parts, F.col(stretch)).sortWithinPartitions(stretch, bucket)
    schema = T.StructType([T.StructField(f.name, f.dataType) for f in keyed.schema])
    placed = dealt.transform(in_arrow, _shuffled(seed, stretch, bucket, mark, place), schema)
    placed = placed.join(broadcast_if_small(starts), F.col(stretch) == F.col(key))
    at = F.col(start) + F.col(place)
    scaled, whole = at * F.lit(count), F.lit(max(rows, 1))
    shard = (scaled - scaled % whole) / whole
    placed = placed.withColumn("shard", shard.cast("int"))
    first = F.ceil(F.col("shard").cast("decimal(38,0)") * F.lit(rows) / F.lit(count)).cast("long")
    placed = placed.withColumn("slot", at - first).select(*[f"`{c}`" for c in docs.columns], "shard", "slot")
    path = f"{scratch_dir(spark)}/shards-{uuid.uuid4().hex}"
    placed.sortWithinPartitions("shard", "slot").write.partitionBy("shard").parquet(path)
    release(spark)
    return spark.read.schema(placed.schema).parquet(path)
