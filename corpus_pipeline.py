"""From raw documents to shards: quality, near copies, decontamination, mixing, sharding.

Every stage takes (spark, docs, folder of the tables) and returns what it keeps.
``run`` writes each stage's rows to the shared folder and reads them again, so that
a lost executor costs one stage's tasks and no more.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from panelkit.llm import bradley_terry, decontaminate, mixing, partenum, shards
from panelkit.llm.common import settled, table
from panelkit.runtime import ship_package


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose pairwise quality score passes (operator 7)."""
    ship_package(spark)
    return bradley_terry.keep_good(docs, table(spark, sf_dir, "labels"), "doc_id", "text", "quality")


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies (operator 2)."""
    ship_package(spark)
    return partenum.keep_first(docs, "doc_id", "text")


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without benchmark passages (operator 8)."""
    return decontaminate.clean(docs, table(spark, sf_dir, "benchmark"), "doc_id", "text", "item_id", "text")


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of the sources takes them (operator 3)."""
    return mixing.mixed(docs, "doc_id", "text", "source")


def sharded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All rows in 16 shuffled shards, with shard and slot (operator 9)."""
    ship_package(spark)
    return shards.shards(docs, "doc_id", "text", 16)


STAGES = [
    ("quality classifier", quality),
    ("n-gram Jaccard join", near_copies),
    ("benchmark decontamination", decontaminated),
    ("mixing sources to target weights", mix),
    ("sharding", sharded),
]

#: A learnt classifier and seeded chance have no SQL twin; tests/llm holds run() against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages one after the other, over all documents."""
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES:
        docs = settled(stage(spark, docs, sf_dir))
    return docs
