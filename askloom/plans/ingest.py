"""Ingest flow: folder -> documents -> chunks -> vectors -> stored index."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame, SparkSession

from askloom import schemas
from askloom.config import Settings
from askloom.operators.chunking import recursive_chunks
from askloom.operators.embedding import EmbedderFactory, embed
from askloom.session import stored
from askloom.sources.files import Parser, good_documents, list_folder, parse_files, quarantine
from askloom.sources.index import SHARED, Load, append_index, read_index, write_index


def index_rows(
    documents: DataFrame, settings: Settings = Settings(), embedder: EmbedderFactory | None = None
) -> DataFrame:
    """Chunks with vectors.  Narrow from end to end: nothing is shuffled."""
    pieces = recursive_chunks(documents, settings.chunk_size, settings.chunk_overlap)
    return embed(pieces, embedder)


def index_parsed(
    parsed: DataFrame, to_index: Callable[[DataFrame], Load], to_errors: Callable[[DataFrame], Load]
) -> Load:
    """Hand the readable sections to one sink and the failures to another; returns the index load.

    The sections are stored in between, so both sinks see the same and every file is parsed once.
    """
    with stored(parsed, "parsed") as once:
        to_errors(quarantine(once))
        return to_index(good_documents(once))


def errors_of(index_path: str) -> str:
    """Where the flows keep the failures of an index's files, unless told otherwise."""
    return f"{index_path.rstrip('/')}-errors"


def read_errors(spark: SparkSession, path: str, session: str | None = SHARED) -> DataFrame:
    """``(source, error)`` of files that could not be read, with ``session_id`` and ``load_id``."""
    return read_index(spark, path, session, schemas.ERRORS).drop("row_id")


def ingest_folder(
    spark: SparkSession,
    settings: Settings = Settings(),
    embedder: EmbedderFactory | None = None,
    parsers: Mapping[str, Parser] | None = None,
    session: str = SHARED,
    append: bool = False,
    errors_path: str | None = None,
) -> bool:
    """Index the documents of ``settings.docs_folder``; False when there is nothing to index.

    Whether there are files is told from their names, so every file is parsed once.  If there
    are none, an index that is there stays.  With ``errors_path`` files that cannot be read are
    recorded there, see ``read_errors``; the sections are then stored in between.
    """
    listed = list_folder(spark, settings.docs_folder, supported_only=True)
    if listed.paths.isEmpty():
        return False
    parsed = parse_files(listed.files, parsers)
    write = append_index if append else write_index

    def to_index(documents: DataFrame) -> Load:
        return write(index_rows(documents, settings, embedder), settings.index_path, session)

    if errors_path is None:
        return to_index(good_documents(parsed)).n_rows > 0
    return index_parsed(parsed, to_index, lambda failures: write(failures, errors_path, session)).n_rows > 0
