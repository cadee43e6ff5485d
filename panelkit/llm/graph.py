"""Connected components of a graph that may be far larger than one machine."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelkit.runtime import stored


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of ``edges`` (a long, b long); root is the smallest node.

    Large-star and small-star rounds in turn: each hangs neighbours on the
    smallest node that is known to reach them, until every edge leads to a root.
    Every round is one minimum by key (combined before the shuffle) and one join
    whose hot keys Spark splits; rounds grow with the logarithm of the longest
    path. Each round is written to the shared folder. Null ends and loops are
    ignored; an empty graph has no rows.
    """
    now = stored(
        edges.where("a is not null and b is not null and a <> b")
        .select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        .distinct()
    )
    mark = None
    while True:
        both = now.unionByName(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"))
        large = (
            both.where("b > a").join(least, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        ).distinct()
        large = stored(large)
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a")
        now = stored(
            small.where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
            .unionByName(least.select("a", F.col("m").alias("b")))
            .distinct()
        )
        row = now.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if tuple(row) == mark:
            break
        mark = tuple(row)
    return now.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(
        now.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    )
