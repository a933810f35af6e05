"""Shared-folder, checkpoint and partition-count helpers."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_KEY = "spark.checkpoint.dir"


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors can reach, as named by the cluster.

    Only a local session without the setting falls back to a temporary folder.
    """
    named = spark.conf.get(CHECKPOINT_KEY, None) or spark.sparkContext.getCheckpointDir()
    if named:
        return named
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError(f"set {CHECKPOINT_KEY} to a folder all executors can reach")
    folder = tempfile.mkdtemp(prefix="askloom-")
    spark.sparkContext.setCheckpointDir(folder)
    return spark.sparkContext.getCheckpointDir()


def has_shared_dir(spark: SparkSession) -> bool:
    """Whether ``shared_dir`` has a folder to give."""
    named = spark.conf.get(CHECKPOINT_KEY, None) or spark.sparkContext.getCheckpointDir()
    return bool(named) or spark.sparkContext.master.startswith("local")


# What this driver has put into the shared folder.
SCRATCH: list[str] = []


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path below the shared folder."""
    path = f"{shared_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    SCRATCH.append(path)
    return path


def drop_scratch(spark: SparkSession) -> int:
    """Remove the intermediate tables of this driver once their results are stored; returns how many."""
    gone = 0
    while SCRATCH:
        gone += delete_path(spark, SCRATCH.pop())
    return gone


@contextmanager
def configured(spark: SparkSession, **settings: str | int) -> Iterator[None]:
    """Session settings (``__`` for a dot) that hold for as long as the block lasts."""
    before = {}
    try:
        for name, value in settings.items():
            key = name.replace("__", ".")
            before[key] = spark.conf.get(key)
            spark.conf.set(key, str(value))
        yield
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)


def file_system(spark: SparkSession, name: str):
    """A Hadoop path and its file system."""
    path = spark._jvm.org.apache.hadoop.fs.Path(name)
    return path, path.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())


def delete_path(spark: SparkSession, name: str) -> bool:
    path, system = file_system(spark, name)
    return bool(system.delete(path, True))


def literal_path(path: str) -> str:
    """``path`` as a file pattern that matches only itself; a trailing slash is dropped."""
    kept = path.rstrip("/") or path
    return re.sub(r"([\\*?\[\]{}])", r"\\\1", kept)


@contextmanager
def stored(df: DataFrame, name: str) -> Iterator[DataFrame]:
    """``df`` written once to the shared folder, for as long as the block lasts."""
    path = scratch_path(df.sparkSession, name)
    try:
        df.write.parquet(path)
        yield df.sparkSession.read.schema(df.schema).parquet(path)
    finally:
        SCRATCH.remove(path)
        delete_path(df.sparkSession, path)


def cut_lineage(df: DataFrame) -> DataFrame:
    """Write ``df`` once to reliable storage and go on from the written copy.

    Used after model calls and before numbering, where a recomputed task could
    return something else than the first run did.
    """
    spark = df.sparkSession
    path = scratch_path(spark, "cut")
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def read_table(spark: SparkSession, folder: str, name: str, *columns: str) -> DataFrame:
    """Read ``folder/name.parquet``, column-pruned.

    A scan of a few splits (one small file) is spread over all cores; any other keeps its
    splits and is not shuffled.
    """
    df = spark.read.parquet(f"{folder}/{name}.parquet")
    return spread(df.select(*columns) if columns else df)


# A scan of fewer splits is spread: below a gigabyte at Spark's default size of a split.
FEW_SPLITS = 8


def spread(scan: DataFrame) -> DataFrame:
    """Spread a bare scan of a few splits over all cores; a larger scan is never shuffled.

    Call it on scans only: asking a plan with shuffles for its partition count
    would run those shuffles.
    """
    cores = scan.sparkSession.sparkContext.defaultParallelism
    return scan.repartition(cores) if scan.rdd.getNumPartitions() < min(cores, FEW_SPLITS) else scan


# Spark makes a task of 32 small files, as opening one counts as 4 MB.  So many of its tasks become one,
# but no fewer than this a core.
TASKS_AT_ONCE, TASKS_PER_CORE = 32, 4


def gather(scan: DataFrame) -> DataFrame:
    """A bare scan of a folder of files in fewer tasks, if they are very many; nothing is shuffled."""
    tasks = scan.rdd.getNumPartitions()
    few = max(tasks // TASKS_AT_ONCE, TASKS_PER_CORE * scan.sparkSession.sparkContext.defaultParallelism)
    return scan.coalesce(few) if tasks > few else scan
