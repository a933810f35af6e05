"""Incremental ingest: files not seen by an earlier run are chunked, embedded, appended."""

from __future__ import annotations

import threading
from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from askloom.config import Settings
from askloom.operators.embedding import EmbedderFactory
from askloom.plans.ingest import errors_of, index_parsed, index_rows
from askloom.session import TASKS_PER_CORE, configured, file_system, gather, literal_path, stored
from askloom.sources.files import (
    NAMES, SUPPORTED_NAMES, LocalFolder, Parser, direct_files, local_files, local_folder, local_names, parse_files, size_limit,
)
from askloom.sources.index import SHARED, append_index

# A large backlog is worked off in batches of this many files, each with its own commit.
FILES_PER_BATCH = 100_000

BINARY_FILES = T.StructType([
    T.StructField("path", T.StringType()),
    T.StructField("modificationTime", T.TimestampType()),
    T.StructField("length", T.LongType()),
    T.StructField("content", T.BinaryType()),
])


def process_arrivals(arriving: DataFrame, handle: Callable[[DataFrame, str], None], checkpoint: str) -> None:
    """Hand everything that has arrived since the last run to ``handle``, batch by batch, then stop.

    The checkpoint remembers the files and the id of the query.  Each micro-batch is a load
    named after both: a batch that is repeated after a failure comes with the same name, and
    streams with checkpoints of their own never share one.
    """
    known, stream = threading.Event(), []

    def take(batch: DataFrame, number: int) -> None:
        known.wait()
        handle(batch, load_name(stream[0], number))

    query = (
        arriving.writeStream.foreachBatch(take)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    stream.append(query.id)
    known.set()
    query.awaitTermination()


def stream_into_index(
    arriving: DataFrame,
    to_rows: Callable[[DataFrame], DataFrame],
    index_path: str,
    checkpoint: str,
    session: str = SHARED,
) -> None:
    """Append everything that has arrived since the last run; a repeated batch replaces its own rows."""
    process_arrivals(
        arriving, lambda batch, load: append_index(to_rows(batch), index_path, session, load_id=load), checkpoint)


def load_name(query_id: str, batch: int) -> str:
    return f"stream-{query_id}-{batch}"


def arriving_files(spark: SparkSession, folder: str, files_per_batch: int = FILES_PER_BATCH) -> DataFrame:
    """A stream of ``(path, content)`` of the files that ``folder_files`` reads: direct ones of supported kinds."""
    found = (
        spark.readStream.format("binaryFile").schema(BINARY_FILES).option("pathGlobFilter", SUPPORTED_NAMES)
        .option("recursiveFileLookup", True).option("maxFilesPerTrigger", files_per_batch).load(literal_path(folder))
    )
    return direct_files(found, folder)


def arrived_names(spark: SparkSession, place: LocalFolder, checkpoint: str, files_per_batch: int) -> DataFrame | None:
    """A stream of ``NAMES`` of new files of a local or mounted folder; None if there has never been one.

    Spark's file stream holds all files of a folder, and of a batch with their paths, in the driver.  Here
    the names that the checkpoint does not have yet are added to a table in it, oldest files first and a Parquet file
    a batch, and the stream reads that table.  What a run that failed has not added, the next one finds again.
    """
    table = _arrivals(checkpoint)
    path, system = file_system(spark, table)
    with stored(local_names(spark, place, supported_only=True), "listed") as names:
        if system.exists(path):
            names = names.join(spark.read.schema(NAMES).parquet(literal_path(table)), "name", "left_anti")
        if not names.isEmpty():
            names.repartition(1).sortWithinPartitions("modified", "name").write.mode("append").option(
                "maxRecordsPerFile", files_per_batch).parquet(table)
    if not system.exists(path):
        return None
    return spark.readStream.schema(NAMES).option("maxFilesPerTrigger", 1).parquet(literal_path(table))


def _arrivals(checkpoint: str) -> str:
    return f"{checkpoint.rstrip('/')}/arrivals"


def _begun_by_file_stream(spark: SparkSession, checkpoint: str) -> bool:
    """Whether the checkpoint knows its files as Spark's file stream does: it goes on that way."""
    (sources, system), (table, _) = (file_system(spark, f) for f in (f"{checkpoint}/sources", _arrivals(checkpoint)))
    return system.exists(sources) and not system.exists(table)


def ingest_new_files(
    spark: SparkSession,
    checkpoint: str,
    settings: Settings = Settings(),
    embedder: EmbedderFactory | None = None,
    parsers: Mapping[str, Parser] | None = None,
    session: str = SHARED,
    files_per_batch: int = FILES_PER_BATCH,
    errors_path: str | None = None,
) -> None:
    """Incremental form of the ingest flow over ``settings.docs_folder``.

    It reads what the batch form reads.  Files that cannot be read, too large ones among them,
    are rows of the table at ``errors_path`` (next to the index if not given), under the load
    of their batch, see ``plans.ingest.read_errors``: the checkpoint takes them for done.
    """
    errors = errors_path or errors_of(settings.index_path)

    def handle(files: DataFrame, load: str) -> None:
        index_parsed(
            parse_files(files, parsers),
            lambda documents: append_index(index_rows(documents, settings, embedder), settings.index_path, session, load),
            lambda failures: append_index(failures, errors, session, load))

    place = local_folder(spark, settings.docs_folder)
    if place and not _begun_by_file_stream(spark, checkpoint):
        arrived, most = arrived_names(spark, place, checkpoint, files_per_batch), size_limit(spark)
        if arrived is not None:
            process_arrivals(arrived, lambda names, load: handle(local_files(names, place, most), load), checkpoint)
        return
    # A batch lists its files once more, path by path, in up to 10,000 tasks if it is left to Spark.
    with configured(spark, spark__sql__sources__parallelPartitionDiscovery__parallelism=
                    TASKS_PER_CORE * spark.sparkContext.defaultParallelism):
        process_arrivals(arriving_files(spark, settings.docs_folder, files_per_batch),
                         lambda batch, load: handle(gather(batch), load), checkpoint)


def ingest_new_documents(
    spark: SparkSession,
    table: str,
    schema: T.StructType,
    index_path: str,
    checkpoint: str,
    to_rows: Callable[[DataFrame], DataFrame] = index_rows,
    session: str = SHARED,
    files_per_batch: int = FILES_PER_BATCH,
) -> None:
    """Incremental ingest of a document table that grows by Parquet files.

    A stream takes a plain path for a folder; written as a pattern that only matches
    itself, the path may also be a single file.
    """
    table = literal_path(table)
    if table[-1].isalnum():
        table = f"{table[:-1]}[{table[-1]}]"
    arriving = (
        spark.readStream.schema(schema)
        .option("maxFilesPerTrigger", files_per_batch).parquet(table)
    )
    stream_into_index(arriving, to_rows, index_path, checkpoint, session)
