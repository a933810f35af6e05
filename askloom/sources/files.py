"""Reading a folder of PDF, DOCX and TXT files as documents."""

from __future__ import annotations

import io
import os
import re
import stat
import uuid
import zipfile
from collections.abc import Callable, Iterator, Mapping
from contextlib import suppress
from typing import NamedTuple
from xml.etree import ElementTree

import pyarrow as pa
from pyspark import TaskContext
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from askloom.config import EXTENSIONS
from askloom.functions.text import as_column, file_extension, unix_newlines
from askloom.session import cut_lineage, delete_path, file_system, gather, has_shared_dir

# ``bytes -> [(page or None, text)]``
Parser = Callable[[bytes], list[tuple[int | None, str]]]

_WORD = "{http://schemas.openxmlformats.org/wordprocessingml/2006/main}"
# What each element of a Word part contributes to the text.
_WORD_BREAKS = {_WORD + "tab": "\t", _WORD + "br": "\n", _WORD + "cr": "\n", _WORD + "p": "\n\n"}


def parse_pdf(content: bytes) -> list[tuple[int | None, str]]:
    """One section per page, counted from 0; needs a PDF library on the executors."""
    from pypdf import PdfReader

    pages = PdfReader(io.BytesIO(content)).pages
    return [(number, page.extract_text() or "") for number, page in enumerate(pages)]


def parse_docx(content: bytes) -> list[tuple[int | None, str]]:
    """One section: headers, body, footers."""
    with zipfile.ZipFile(io.BytesIO(content)) as package:
        names = sorted(n for n in package.namelist() if n.startswith("word/") and n.endswith(".xml"))
        headers = [n for n in names if n.startswith("word/header")]
        footers = [n for n in names if n.startswith("word/footer")]
        text = "".join(_word_text(package.read(n)) for n in [*headers, "word/document.xml", *footers])
    return [(None, text.strip())]


def _word_text(xml: bytes) -> str:
    pieces = []
    for element in ElementTree.fromstring(xml).iter():
        if element.tag == _WORD + "t":
            pieces.append(element.text or "")
        else:
            pieces.append(_WORD_BREAKS.get(element.tag, ""))
    return "".join(pieces)


PARSERS: Mapping[str, Parser] = {".pdf": parse_pdf, ".docx": parse_docx}


# What a listing holds: names as the file system has them, sizes, times in nanoseconds.
NAMES = "name binary, length long, modified long"
FILES_PER_TASK = 1000
# Names and bytes of contents that a task holds.
_NAMES_AT_ONCE, _READ_AT_ONCE = 10_000, 4 << 20
# As Spark's file sources have it.
_HIDDEN = re.compile(rb"^(\.|_[^=]*$)|\._COPYING_$")
TOO_LARGE = "larger than the limit for binary files"
# The supported extensions in any letter case, as a file name pattern.
SUPPORTED_NAMES = "*{%s}" % ",".join(
    "".join(f"[{c}{c.upper()}]" if c.isalpha() else c for c in ext) for ext in EXTENSIONS)


class Listed(NamedTuple):
    """The direct files of a folder; ``paths`` does not look into them."""

    paths: DataFrame  # path
    files: DataFrame  # path, content


def folder_files(spark: SparkSession, folder: str, supported_only: bool = False) -> DataFrame:
    """``(path, content)`` of the direct files of a folder; no rows when it is absent.

    Files of sub-folders, and with ``supported_only`` other kinds of files, are dropped while
    listing, before their content is read.  A file above Spark's limit for binary files has
    no content.  Names that start with ``_`` or ``.``, and empty files, are invisible to Spark's file sources.
    """
    return list_folder(spark, folder, supported_only).files


def list_folder(spark: SparkSession, folder: str, supported_only: bool = False) -> Listed:
    """What ``folder_files`` reads, listed once.

    Spark's file sources hold every file of a folder in the driver.  A local or mounted folder is listed
    and read by tasks instead, and the list is a table in the shared folder.
    """
    place = local_folder(spark, folder)
    if place:
        names = cut_lineage(local_names(spark, place, supported_only))
        return Listed(names.select(_path(place)), local_files(names, place, size_limit(spark)))
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", True)
    if supported_only:
        reader = reader.option("pathGlobFilter", SUPPORTED_NAMES)
    try:
        found = reader.load(folder)
    except AnalysisException as problem:
        if problem.getCondition() == "PATH_NOT_FOUND":
            none = spark.createDataFrame([], "path string, content binary")
            return Listed(none.select("path"), none)
        raise
    files = gather(direct_files(found, folder))
    return Listed(files.select("path"), files)


class LocalFolder(NamedTuple):
    path: str  # as tasks open it
    uri: str  # as Spark names it


def local_folder(spark: SparkSession, folder: str) -> LocalFolder | None:
    """A local or mounted folder that tasks can list; None for any other path."""
    path, system = file_system(spark, folder)
    if system.getUri().getScheme() != "file" or not has_shared_dir(spark):
        return None
    if not system.exists(path) or not system.getFileStatus(path).isDirectory():
        return None
    whole = system.makeQualified(path)
    return LocalFolder(whole.toUri().getPath(), whole.toString().rstrip("/"))


def local_names(spark: SparkSession, place: LocalFolder, supported_only: bool) -> DataFrame:
    """``NAMES`` of the direct files that Spark's sources see, listed by one task."""
    folder = place.path
    wanted = re.compile(rb"(?i)\.(%s)\Z" % b"|".join(e[1:].encode() for e in EXTENSIONS)) if supported_only else None

    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _ in batches:
            pass
        rows: list[tuple[bytes, int, int]] = []
        with os.scandir(os.fsencode(folder)) as entries:
            for entry in entries:
                if _HIDDEN.search(entry.name) or wanted and not wanted.search(entry.name):
                    continue
                with suppress(FileNotFoundError):  # it has just gone
                    status = entry.stat()
                    if stat.S_ISREG(status.st_mode) and status.st_size:
                        rows.append((entry.name, status.st_size, status.st_mtime_ns))
                if len(rows) == _NAMES_AT_ONCE:
                    yield batch(rows)
                    rows = []
        if rows:
            yield batch(rows)

    def batch(rows: list[tuple[bytes, int, int]]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(zip(*rows), (pa.binary(), pa.int64(), pa.int64()))], ["name", "length", "modified"])

    return spark.range(0, 1, 1, 1).mapInArrow(found, NAMES)


def local_files(names: DataFrame, place: LocalFolder, most: int) -> DataFrame:
    """``(path, content)`` of listed files, read by tasks; files above ``most`` bytes have no content.

    A task has about ``FILES_PER_TASK`` files, fewer if they are large.  A file that has gone is left out.
    """
    spark, folder = names.sparkSession, os.fsencode(place.path)
    n, size = names.agg(F.count(F.lit(1)), F.coalesce(F.sum("length"), F.lit(0))).head()
    at_once = spark._jsparkSession.sessionState().conf().filesMaxPartitionBytes()
    tasks = max(spark.sparkContext.defaultParallelism, n // FILES_PER_TASK, size // at_once)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            paths, contents, held = [], [], 0
            for k, (path, name, length) in enumerate(zip(*batch.columns), 1):
                content = None
                try:
                    if length.as_py() <= most:
                        with open(os.path.join(folder, name.as_py()), "rb") as file:
                            content = file.read()
                        held += len(content)
                    paths.append(path.as_py())
                    contents.append(content if content is None or len(content) <= most else None)
                except FileNotFoundError:  # gone since it was listed, unless all are
                    os.stat(folder)
                if held >= _READ_AT_ONCE or k == batch.num_rows:
                    yield pa.RecordBatch.from_arrays([pa.array(paths, pa.string()), pa.array(contents, pa.binary())], ["path", "content"])
                    paths, contents, held = [], [], 0

    dealt = names.select(_path(place), "name", "length").repartition(int(max(1, min(n, tasks))))
    return dealt.mapInArrow(read, "path string, content binary")


def _path(place: LocalFolder) -> Column:
    return F.concat(F.lit(f"{place.uri}/"), F.make_valid_utf8(F.col("name").cast("string"))).alias("path")


def direct_files(found: DataFrame, folder: str) -> DataFrame:
    """``(path, content)`` of the files that lie in ``folder`` itself, of a batch or a stream of binary files.

    A folder whose name looks like a partition is a sub-folder like any other, if ``found`` is
    listed with ``recursiveFileLookup``.  A file above Spark's limit has no content.
    """
    spark = found.sparkSession
    parent = F.regexp_replace("_metadata.file_path", "/[^/]*$", "")
    direct = found.where(_one_root(parent) == _one_root(F.lit(_uri(spark, folder))))
    readable = direct.where(F.col("length") <= size_limit(spark)).select("path", "content")
    # By the size in the listing, so that no file is looked at a second time.
    too_large = direct.where(F.col("_metadata.file_size") > size_limit(spark)).select(
        "path", F.lit(None).cast("binary").alias("content"))
    return readable.unionByName(too_large)


def size_limit(spark: SparkSession) -> int:
    """Bytes of a binary file above which Spark does not read it."""
    return int(spark.conf.get("spark.sql.sources.binaryFile.maxLength"))


def _uri(spark: SparkSession, folder: str) -> str:
    """The folder as Spark writes it into ``_metadata``, but for the slashes after the scheme."""
    path, system = file_system(spark, folder)
    return system.makeQualified(path).toUri().toString().rstrip("/")


def _one_root(uri: Column) -> Column:
    return F.regexp_replace(uri, "^([A-Za-z0-9+.-]+):/+", "$1:/")


def is_supported(path: Column | str) -> Column:
    return F.lower(file_extension(path)).isin(*EXTENSIONS)


def decode_text(content: Column | str) -> Column:
    """UTF-8 text with unix newlines; NULL when the bytes are not valid UTF-8."""
    return unix_newlines(F.try_validate_utf8(as_column(content).cast("string")))


def parse_files(files: DataFrame, parsers: Mapping[str, Parser] | None = None) -> DataFrame:
    """``(source, page, text, error)``: the sections of every supported file.

    A file that cannot be read gives one row with ``error`` and never stops the others.
    The files are read once: text is decoded by Spark, and only the bytes of formats that
    have a parser are handed to Python.
    """
    parsers = {**PARSERS, **(parsers or {})}
    extension = F.lower(file_extension("path"))
    files = files.where(is_supported("path")).withColumn("_parsed", extension.isin(*parsers))
    text = decode_text("content")
    problem = F.when(F.col("content").isNull(), TOO_LARGE).when(text.isNull(), "not valid UTF-8")
    plain = F.array(F.struct(
        F.lit(None).cast("int").alias("page"), text.alias("text"), problem.alias("error")))
    parsed = _parse(parsers)(F.when(F.col("_parsed"), F.col("content")), F.when(F.col("_parsed"), extension))
    sections = files.select(
        F.col("path").alias("source"),
        F.explode_outer(F.when(F.col("_parsed"), parsed).otherwise(plain)).alias("_s"))
    return sections.select("source", "_s.page", "_s.text", "_s.error").where(
        F.col("text").isNotNull() | F.col("error").isNotNull())


def _parse(parsers: Mapping[str, Parser]) -> Callable[[Column, Column], Column]:
    section = pa.struct([("page", pa.int32()), ("text", pa.string()), ("error", pa.string())])

    def sections(content: bytes | None, extension: str) -> list[dict]:
        if content is None:
            return [{"error": TOO_LARGE}]
        try:
            return [{"page": page, "text": text} for page, text in parsers[extension](content)]
        except ImportError as problem:
            return [{"error": f"missing dependency: {problem}"}]
        except Exception as problem:  # noqa: BLE001 - any failure of a parser becomes data
            return [{"error": f"{type(problem).__name__}: {problem}"}]

    @F.arrow_udf("array<struct<page:int,text:string,error:string>>")
    def run(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        for contents, extensions in batches:
            rows = [sections(c.as_py(), e.as_py()) if e.is_valid else None for c, e in zip(contents, extensions)]
            yield pa.array(rows, pa.list_(section))

    return run


def good_documents(parsed: DataFrame) -> DataFrame:
    return parsed.where(F.col("error").isNull()).drop("error")


def quarantine(parsed: DataFrame) -> DataFrame:
    return parsed.where(F.col("error").isNotNull()).select("source", "error")


def load_documents(
    spark: SparkSession, folder: str, parsers: Mapping[str, Parser] | None = None
) -> DataFrame:
    """``(source, page, text)`` of every readable file of a folder."""
    return good_documents(parse_files(folder_files(spark, folder, supported_only=True), parsers))


def write_texts(texts: DataFrame, folder: str, as_json: bool = False) -> None:
    """Write the ``text`` of every row as a file of its own, ending with a newline, or as a JSON record.

    ``load_documents`` reads such a folder back (texts).  Files that are there stay.
    """
    spark, rows = texts.sparkSession, texts.select("text")
    path, system = file_system(spark, folder)
    if system.getUri().getScheme() == "file":
        content = F.to_json(F.struct("text")) if as_json else F.col("text")
        system.mkdirs(path)
        _write_local(rows.select(content.cast("binary")), system.makeQualified(path).toUri().getPath(), ".json" if as_json else ".txt")
    else:
        writer = rows.write.mode("append").option("maxRecordsPerFile", 1)
        writer.json(folder) if as_json else writer.text(folder)


def _write_local(contents: DataFrame, folder: str, extension: str) -> None:
    """Write every row of a binary column as a file of a local or mounted folder.

    Hadoop's local file system starts four processes (``chmod``) for every file, so tasks write
    by themselves: first into a folder of the attempt that Spark's sources do not see.  When all
    rows are written, the files of the attempts that ended well are moved to their place.
    """
    spark, run = contents.sparkSession, uuid.uuid4().hex
    hidden = f"{folder}/_temporary-{run}"

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, n = TaskContext.get(), 0
        mine = f"{hidden}/{task.partitionId()}-{task.taskAttemptId()}"
        for batch in batches:
            for content in batch.column(0):
                if not n:
                    os.makedirs(mine)
                with open(f"{mine}/part-{task.partitionId():05d}-{run}-c{n:06d}{extension}", "wb") as file:
                    file.write((content.as_py() or b"") + b"\n")
                n += 1
        yield pa.RecordBatch.from_arrays([pa.array([mine] if n else [], pa.string())], ["path"])

    def move(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for made in batch.column(0).to_pylist():
                with suppress(FileNotFoundError):  # an earlier attempt of this task has moved them
                    for name in os.listdir(made):
                        os.replace(f"{made}/{name}", f"{folder}/{name}")
            yield batch.slice(0, 0)

    try:
        made = contents.mapInArrow(write, "path string").toArrow()  # a row a task
        if len(made):
            spark.createDataFrame(made).repartition(min(len(made), spark.sparkContext.defaultParallelism)).mapInArrow(
                move, "path string").count()
    finally:
        delete_path(spark, f"file://{hidden}")


def in_order(documents: DataFrame, *order: str) -> DataFrame:
    return documents.orderBy(*(order or ("source", "page")))


def load_summary(documents: DataFrame, source: str = "source") -> DataFrame:
    """Sections per source."""
    return documents.groupBy(source).agg(F.count(F.lit(1)).alias("n_sections"))


def load_totals(parsed: DataFrame, files: DataFrame) -> DataFrame:
    """One row: sections read, sections failed, files seen (unsupported ones included)."""
    seen = files.agg(F.count(F.lit(1)).alias("n")).select(
        F.lit(0).alias("s"), F.lit(0).alias("e"), "n")
    read = parsed.agg(
        F.count_if(F.col("error").isNull()).alias("s"), F.count_if(F.col("error").isNotNull()).alias("e"),
    ).select("s", "e", F.lit(0).alias("n"))
    return read.unionByName(seen).agg(
        F.sum("s").alias("n_sections"), F.sum("e").alias("n_errors"), F.sum("n").alias("n_files"))


def concat_documents(first: DataFrame, *more: DataFrame) -> DataFrame:
    """All documents of several loads; repeats are kept."""
    for part in more:
        first = first.unionByName(part)
    return first
