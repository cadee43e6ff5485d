"""Session-level helpers shared by the operators."""

from __future__ import annotations

import shutil
import tempfile
import uuid
from collections.abc import Callable, Iterator, Sequence
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager
from pathlib import Path
from typing import Any

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.storagelevel import StorageLevel

#: Most rows a side may hold before it is no longer hinted as a broadcast.
BROADCAST_ROWS = 200_000


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder of the session.

    The folder configured as ``spark.checkpoint.dir`` wins. A folder of our own
    is only made in local mode, where driver and executors share one machine.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        configured = tempfile.mkdtemp(prefix="panelkit-checkpoint-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir()


def scratch_dir(spark: SparkSession) -> str:
    """Where this application keeps its intermediate tables."""
    return f"{checkpoint_dir(spark)}/panelkit-{spark.sparkContext.applicationId}"


def stored(df: DataFrame) -> DataFrame:
    """Write ``df`` as a table in the shared folder and read it back.

    For row-sized intermediates that several steps read: they stay compressed
    and columnar, each step only reads its columns, and all of them see the same
    rows even if an executor is lost and its tasks run again.
    """
    path = f"{scratch_dir(df.sparkSession)}/{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def clean_scratch(spark: SparkSession) -> None:
    """Delete the intermediate tables of this application; call it when done."""
    jvm = spark.sparkContext._jvm
    folder = jvm.org.apache.hadoop.fs.Path(scratch_dir(spark))
    folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)


def durable(df: DataFrame) -> DataFrame:
    """Checkpoint a small table, such as one row per group or period."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def broadcast_if_small(df: DataFrame, limit: int = BROADCAST_ROWS) -> DataFrame:
    """Hint a broadcast only if ``df`` has at most ``limit`` rows.

    ``df`` should be cheap to count (a checkpoint or a small aggregate). Beyond
    the limit the frame is returned unhinted and Spark shuffles the join.
    """
    if df.limit(limit + 1).count() <= limit:
        return F.broadcast(df)
    return df


def lookup_side(df: DataFrame) -> DataFrame:
    """Materialise a small per-group table and hint its broadcast if it is small.

    Knowing the size before the join is planned spares a shuffle of the large
    side, which would send a hot group to one task.
    """
    return broadcast_if_small(durable(df))


def ship_package(spark: SparkSession) -> None:
    """Make this package importable in the Python workers of the session."""
    package = Path(__file__).resolve().parent
    name = f"{package.name}.zip"
    if any(name in str(f) for f in spark.sparkContext.listFiles):
        return
    folder = tempfile.mkdtemp(prefix="panelkit-package-")
    archive = shutil.make_archive(
        str(Path(folder) / package.name), "zip", root_dir=package.parent, base_dir=package.name
    )
    spark.sparkContext.addPyFile(archive)


def run_jobs(spark: SparkSession, jobs: Sequence[Callable[[], Any]], parallelism: int) -> list:
    """Run independent fits with a few in flight, so that their tails overlap."""
    with ThreadPoolExecutor(max_workers=max(1, parallelism)) as pool:
        started = [pool.submit(inheritable_thread_target(spark)(job)) for job in jobs]
        return [job.result() for job in started]


@contextmanager
def cached(df: DataFrame) -> Iterator[DataFrame]:
    """Keep ``df`` in memory, spilling to disk, while a loop of jobs reads it."""
    kept = df.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        yield kept
    finally:
        kept.unpersist()
