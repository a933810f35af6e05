"""Folders of files, batch and streamed: every query writes the documents out as files and reads them back."""

from __future__ import annotations

import io
import zipfile
from collections.abc import Iterator
from contextlib import contextmanager
from xml.sax.saxutils import escape

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from askloom.catalog.base import documents, query, sql_strip, sql_text
from askloom.config import Settings
from askloom.functions.text import strip_space
from askloom.operators.scoring import NothingEvaluated, mean_scores, require_evaluated
from askloom.plans.ingest import errors_of, ingest_folder, read_errors
from askloom.session import read_table, scratch_path
from askloom.sources.files import folder_files, list_folder, load_documents, load_totals, parse_files, write_texts
from askloom.sources.index import read_index, write_index
from askloom.streaming.incremental import ingest_new_files

#: Larger than any file of these queries, so that a file is one chunk.
WHOLE = Settings(chunk_size=1 << 30, chunk_overlap=0)
#: Bytes above which a file counts as too large in ``streamed_folder``.
LIMIT = 10_000

# The id goes into the first line, as the names of the files are Spark's.
_SQL_FILE = "doc_id || chr(10) || regexp_replace(text, '\\r\\n?', chr(10), 'g') || chr(10)"


def _named_texts(spark: SparkSession, folder: str) -> DataFrame:
    return documents(spark, folder, "doc_id", "lang", "text").select(
        "doc_id", "lang", F.concat_ws("\n", "doc_id", "text").alias("text"))


def _id(text: Column | str) -> Column:
    return F.split(text, "\n", 2)[0].cast("bigint")


def _folder(spark: SparkSession, folder: str) -> str:
    """Documents as text files; German ones are of a kind that is not read, French ones lie in sub-folders."""
    target = scratch_path(spark, "files")
    texts = _named_texts(spark, folder)
    write_texts(texts.where("lang NOT IN ('de', 'fr')"), target)
    write_texts(texts.where("lang = 'de'"), target, as_json=True)
    write_texts(texts.where("lang = 'fr'"), f"{target}/lang=fr")
    return target


@query(f"""SELECT doc_id, CAST(length(t) AS INTEGER) AS n_chars, md5(t) AS digest
           FROM (SELECT doc_id, {_SQL_FILE} AS t FROM documents WHERE lang NOT IN ('de', 'fr'))""")
def folder_texts(spark: SparkSession, folder: str) -> DataFrame:
    """The direct text files of a folder."""
    return load_documents(spark, _folder(spark, folder)).select(
        _id("text").alias("doc_id"), F.char_length("text").alias("n_chars"), F.md5("text").alias("digest"))


@query("""SELECT 'folder' AS place, CAST(count_if(lang NOT IN ('de', 'fr')) AS BIGINT) AS n_sections, CAST(0 AS BIGINT) AS n_errors,
                 CAST(count_if(lang <> 'fr') AS BIGINT) AS n_files FROM documents
          UNION ALL SELECT p, 0, 0, 0 FROM (VALUES ('absent'), ('empty')) v(p)""")
def folder_totals(spark: SparkSession, folder: str) -> DataFrame:
    """What was read of a folder, of an empty one and of one that is not there."""
    full, empty = _folder(spark, folder), scratch_path(spark, "empty")
    spark.createDataFrame([], "x int").write.json(empty)
    found = None
    for place, at in (("folder", full), ("empty", empty), ("absent", scratch_path(spark, "absent"))):
        supported = parse_files(folder_files(spark, at, supported_only=True))
        totals = load_totals(supported, list_folder(spark, at).paths).select(F.lit(place).alias("place"), "*")
        found = totals if found is None else found.unionByName(totals)
    return found


def _docx(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
    for batch in batches:
        packed = []
        for text in batch.to_pylist():
            out = io.BytesIO()
            with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as package:
                package.writestr("word/document.xml", (
                    '<w:document xmlns:w="http://schemas.openxmlformats.org/wordprocessingml/2006/main"><w:body>'
                    + "".join(f"<w:p><w:r><w:t>{escape(line)}</w:t></w:r></w:p>" for line in text.split("\n"))
                    + "</w:body></w:document>"))
            packed.append(out.getvalue())
        yield pa.array(packed, pa.binary())


@query(f"""SELECT doc_id, CASE lang WHEN 'es' THEN 'BadZipFile: File is not a zip file' WHEN 'fr' THEN 'not valid UTF-8' END AS error,
                  CASE WHEN lang IN ('es', 'fr') THEN NULL ELSE md5(CASE WHEN lang = 'de' THEN
                      trim(replace(text, chr(10), chr(10) || chr(10)), {sql_text(''.join(map(chr, (9, 10, 11, 12, 13, 28, 29, 30, 31, 32, 133, 160))))})
                      ELSE text END) END AS digest
           FROM documents""")
def parsed_files(spark: SparkSession, folder: str) -> DataFrame:
    """A table of file contents of several kinds, some broken: no failure touches another file."""
    docs = documents(spark, folder, "doc_id", "lang", "text")
    kind = F.when(F.col("lang").isin("de", "es"), ".docx").otherwise(".txt")
    raw = F.encode("text", "UTF-8")
    content = F.when(F.col("lang") == "de", F.arrow_udf(_docx, "binary")("text")).when(
        F.col("lang") == "fr", F.concat(raw, F.unhex(F.lit("C328")))).otherwise(raw)
    files = docs.select(F.concat(F.lit("file:/in/"), "doc_id", kind).alias("path"), content.alias("content"))
    return parse_files(files).select(
        F.regexp_extract("source", "([0-9]+)[.][a-z]+$", 1).cast("bigint").alias("doc_id"), "error", F.md5("text").alias("digest"))


@contextmanager
def _size_limit(spark: SparkSession, most: int) -> Iterator[None]:
    """Files above ``most`` bytes count as too large while the block lasts."""
    key = "spark.sql.sources.binaryFile.maxLength"
    before = spark.conf.get(key)
    spark.conf.set(key, str(most))
    try:
        yield
    finally:
        spark.conf.set(key, before)


@query(f"""SELECT CASE WHEN strlen(t) <= {LIMIT} THEN CAST(doc_id AS VARCHAR) END AS doc_id,
                  CASE WHEN strlen(t) <= {LIMIT} THEN md5({sql_strip('t')}) END AS digest,
                  CASE WHEN strlen(t) > {LIMIT} THEN 'larger than the limit for binary files' END AS error
           FROM (SELECT doc_id, {_SQL_FILE} AS t FROM documents WHERE lang NOT IN ('de', 'fr'))""")
def streamed_folder(spark: SparkSession, folder: str) -> DataFrame:
    """A folder as a stream, the second half of the files arriving later: indexed files and error rows."""
    target, index, checkpoint = _folder(spark, folder), scratch_path(spark, "index"), scratch_path(spark, "stream")
    settings = Settings(docs_folder=target, index_path=index, chunk_size=WHOLE.chunk_size, chunk_overlap=0)
    arrived = list_folder(spark, target).paths
    with _size_limit(spark, LIMIT):
        for _ in range(2):  # the second run finds nothing new
            ingest_new_files(spark, checkpoint, settings, files_per_batch=max(1, arrived.count() // 2))
    none = F.lit(None).cast("string")
    good = read_index(spark, index).select(
        _id("text").cast("string").alias("doc_id"), F.md5("text").alias("digest"), none.alias("error"))
    bad = read_errors(spark, errors_of(index)).select(none.alias("doc_id"), none.alias("digest"), "error")
    return good.unionByName(bad)


@query(f"""SELECT doc_id, md5({sql_strip('t')}) AS digest
           FROM (SELECT doc_id, {_SQL_FILE} AS t FROM documents WHERE lang NOT IN ('de', 'fr'))""")
def ingested_folder(spark: SparkSession, folder: str) -> DataFrame:
    """The same folder in one batch."""
    index = scratch_path(spark, "index")
    settings = Settings(docs_folder=_folder(spark, folder), index_path=index, chunk_size=WHOLE.chunk_size, chunk_overlap=0)
    ingest_folder(spark, settings)
    return read_index(spark, index).select(_id("text").alias("doc_id"), F.md5("text").alias("digest"))


_GUARDED = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType())])


@query("""SELECT 'session' AS place, count(*) AS n_rows, false AS stopped FROM documents
          UNION ALL SELECT 'other session', 0, false UNION ALL SELECT 'no index', 0, true""")
def guarded_reads(spark: SparkSession, folder: str) -> DataFrame:
    """A session of an index, one that the index does not have, and a path without an index."""
    index = scratch_path(spark, "index")
    write_index(documents(spark, folder, *_GUARDED.names), index, "here")
    found = None
    for place, path, session in (("session", index, "here"), ("other session", index, "there"), ("no index", f"{index}-none", "here")):
        stopped, rows = False, spark.createDataFrame([], _GUARDED)
        try:
            rows = read_index(spark, path, session, _GUARDED)
        except FileNotFoundError:
            stopped = True
        part = rows.agg(F.count(F.lit(1)).alias("n_rows")).select(F.lit(place).alias("place"), "n_rows", F.lit(stopped).alias("stopped"))
        found = part if found is None else found.unionByName(part)
    return found


@query("""SELECT quality, count(*) AS n_evaluated, false AS stopped FROM labels GROUP BY quality
          UNION ALL SELECT -1, 0, true""")
def guarded_means(spark: SparkSession, folder: str) -> DataFrame:
    """Means by quality label; a label that no row has stops the evaluation."""
    labels = read_table(spark, folder, "labels")
    found = None
    for quality in (0, 1, -1):
        rows = labels.where(F.col("quality") == quality).select(
            F.col("quality").cast("double").alias("faithfulness"), F.col("toxic").cast("double").alias("answer_relevancy"),
            F.lit(0.0).alias("seconds"))
        means = mean_scores(rows)
        stopped = False
        try:
            require_evaluated(means.head().asDict())
        except NothingEvaluated:
            stopped = True
        part = means.select(F.lit(quality).alias("quality"), "n_evaluated", F.lit(stopped).alias("stopped"))
        found = part if found is None else found.unionByName(part)
    return found
