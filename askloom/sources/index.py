"""The chunk index as a Parquet table.

Layout: ``session_id=…/load_id=…/`` below the index path.  A session reads its own
directory only (partition pruning), and a load that is written again under its own id
replaces itself, so a retried load does not double its rows.
"""

from __future__ import annotations

import uuid
from concurrent.futures import ThreadPoolExecutor
from typing import NamedTuple

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from askloom import schemas
from askloom.session import delete_path, file_system, literal_path

SHARED = "shared"
BASE_LOAD = "base"
PARTS = ("session_id", "load_id")
DELETES_AT_ONCE = 32
# Natural order first; the last two tell repeated chunks apart.
STORED_KEY = ("source", "page", "chunk_no", "load_id", "row_id")


class Load(NamedTuple):
    load_id: str
    n_rows: int


def write_index(chunks: DataFrame, path: str, session: str = SHARED) -> Load:
    """Build a session's index anew; what it held before is replaced."""
    return _write(chunks, path, session, BASE_LOAD, keep_other_loads=False)


def append_index(
    chunks: DataFrame, path: str, session: str = SHARED, load_id: str | None = None
) -> Load:
    """Add chunks, repeats included; returns the id of the load and its number of rows.

    Calling again with that id replaces the load instead of adding to it.
    """
    return _write(chunks, path, session, load_id or uuid.uuid4().hex, keep_other_loads=True)


def _write(chunks: DataFrame, path: str, session: str, load_id: str, keep_other_loads: bool) -> Load:
    counted = Observation()
    rows = chunks.withColumn("row_id", F.monotonically_increasing_id()).observe(counted, F.count(F.lit(1)).alias("n"))
    # Each call writes one directory, so no task opens more than one file at a time and
    # no shuffle is needed to group the partitions.
    target = _session_path(chunks.sparkSession, path, session)
    if keep_other_loads:
        rows.write.mode("overwrite").parquet(f"{target}/load_id={load_id}")
    else:
        rows.withColumn("load_id", F.lit(load_id)).write.mode("overwrite").partitionBy("load_id").parquet(target)
    return Load(load_id, counted.get["n"])


def _session_path(spark: SparkSession, path: str, session: str) -> str:
    """A session's directory, named as Spark names partitions."""
    name = spark._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.escapePathName(session)
    return f"{path.rstrip('/')}/session_id={name}"


def _replaced_loads(spark: SparkSession, path: str, load_id: str) -> list[str]:
    """The other loads of all sessions that have the load ``load_id``, told by one listing."""
    root = path.rstrip("/")
    pattern, system = file_system(spark, f"{literal_path(root)}/session_id=*/load_id=*")
    loads = [status.getPath() for status in system.globStatus(pattern) or []]
    fresh = {load.getParent().toString() for load in loads if load.getName() == f"load_id={load_id}"}
    return [load.toString() for load in loads
            if load.getName() != f"load_id={load_id}" and load.getParent().toString() in fresh]


def write_sessions(chunks: DataFrame, path: str) -> int:
    """Build the indexes of all sessions in the ``session_id`` column in one pass.

    The rows are rebalanced by session, so that small sessions do not become many small
    files and a very large one is still written by many tasks.  Sessions that are not in
    ``chunks`` keep what they have; those in it lose their earlier loads, which go after the
    new rows are in place.  Returns how many loads went.

    ``chunks`` is evaluated once: which sessions it had is told by where its load lies.  A session
    costs no call of its own; a load that goes costs one, and many go at a time.
    """
    spark, load_id = chunks.sparkSession, f"{BASE_LOAD}-{uuid.uuid4().hex}"
    rows = chunks.hint("rebalance", F.col("session_id")).withColumns(
        {"row_id": F.monotonically_increasing_id(), "load_id": F.lit(load_id)})
    rows.write.mode("append").partitionBy(*PARTS).parquet(path)
    gone = _replaced_loads(spark, path, load_id)
    with ThreadPoolExecutor(DELETES_AT_ONCE) as pool:
        return sum(pool.map(lambda load: delete_path(spark, load), gone))


def read_index(
    spark: SparkSession, path: str, session: str | None = SHARED, schema: T.StructType = schemas.INDEX
) -> DataFrame:
    """The index of one session, or of all with ``session=None``.

    One session's directory is read without listing the others.  A session that the index
    does not have has no rows; a path without any index raises ``FileNotFoundError``.
    """
    stored = T.StructType(
        [f for f in schema.fields if f.name not in (*PARTS, "row_id")]
        + [T.StructField("row_id", T.LongType())]
        + [T.StructField(p, T.StringType()) for p in PARTS]
    )
    reader = spark.read.schema(stored).option("basePath", path)
    try:
        return reader.parquet(path if session is None else _session_path(spark, path, session))
    except AnalysisException as problem:
        if problem.getCondition() != "PATH_NOT_FOUND":
            raise
        root, system = file_system(spark, path)
        if session is not None and system.exists(root):
            return spark.createDataFrame([], stored)
        raise FileNotFoundError(f"no index at '{path}': run the ingest flow first") from None


def load_or_create(
    spark: SparkSession, path: str, chunks: DataFrame, session: str = SHARED,
    schema: T.StructType = schemas.INDEX,
) -> DataFrame:
    """The stored index of the session, written from ``chunks`` first when it has none."""
    try:
        rows = read_index(spark, path, session, schema)
        if not rows.isEmpty():
            return rows
    except FileNotFoundError:
        pass
    write_index(chunks, path, session)
    return read_index(spark, path, session, schema)
