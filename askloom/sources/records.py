"""Records that span lines, out of files that many tasks read.

A JSON array or a CSV with line breaks in quotes has no border that a task could find from the
middle of a file, so Spark's readers give such a file to one task.  Here Spark's text reader
splits the file at a character that every record contains, whatever it means where it stands.
What a piece means depends only on how many quotes and braces come before it: those are counted
per piece and summed over the splits of the file, with one narrow row per split.  Pieces of a
record then meet under the record's number; no file is ever whole in a task.

Files are UTF-8; a byte order mark at the start of a file is dropped.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from askloom.operators.windows import running_sum, running_sums

#: Where a split starts; ``running_sums`` orders the rows of one value of this column in one task.
SPLIT = "_group"
KEYS = ["_file"]


def _pieces(spark: SparkSession, path: str, border: str) -> DataFrame:
    """``(_file, _group, _at, piece)``: the files of a path cut at ``border``, which is left out.

    ``_group`` is where the split starts, ``_at`` orders the pieces of a split.
    """
    try:
        lines = spark.read.option("lineSep", border).text(path)
    except AnalysisException as problem:
        if problem.getCondition() == "PATH_NOT_FOUND":
            raise FileNotFoundError(f"nothing at '{path}'") from None
        raise
    return lines.select(
        F.col("_metadata.file_path").alias("_file"), F.col("_metadata.file_block_start").alias(SPLIT),
        F.monotonically_increasing_id().alias("_at"), F.col("value").alias("piece"))


def _count(text: Column, sign: str) -> Column:
    return (F.char_length(text) - F.char_length(F.replace(text, F.lit(sign), F.lit("")))).cast("bigint")


def _joined(pieces: DataFrame, ends: Column, border: str) -> DataFrame:
    """``(_file, _record, record)``: the pieces up to and with one that ``ends`` a record, numbered from 0."""
    numbered = running_sum(pieces.withColumn("_ends", ends.cast("bigint")), KEYS, "_at", F.col("_ends"), "_upto")
    parts = F.sort_array(F.collect_list(F.struct(SPLIT, "_at", "piece")))
    return numbered.groupBy("_file", (F.col("_upto") - F.col("_ends")).alias("_record")).agg(
        F.array_join(F.transform(parts, lambda p: p["piece"]), border).alias("record"))


def csv_records(spark: SparkSession, path: str) -> DataFrame:
    """``(_file, _record, record)`` of CSV files; the header is record 0 of its file.

    A quote stands only around a field or doubled inside one, as RFC 4180 asks; ``write_results``
    writes so.  A quote that is never closed makes the rest of its file one record.
    """
    counted = running_sum(_pieces(spark, path, "\n"), KEYS, "_at", _count(F.col("piece"), '"'), "_quotes")
    found = _joined(counted, F.col("_quotes") % 2 == 0, "\n")
    bare = F.when(F.col("_record") == 0, F.regexp_replace("record", "^\ufeff", "")).otherwise(F.col("record"))
    return found.withColumn("record", F.regexp_replace(bare, "\r$", "")).where(F.col("record") != "")


def json_records(spark: SparkSession, path: str) -> DataFrame:
    """``(_file, _record, record)``: the outermost objects of JSON files, as text.

    They may stand in an array, one a line, or alone.  What stands between objects but is no
    object is left out; what cannot be parsed stays a record for the parser to judge.
    """
    # A brace never follows a backslash in valid JSON, so a cut at one parts no escape.
    plain = F.regexp_replace("piece", r"(?s)\\.", "")
    counted = running_sum(
        _pieces(spark, path, "}").withColumn("_plain", plain), KEYS, "_at", _count(F.col("_plain"), '"'), "_quotes")
    starts_inside = (F.col("_quotes") - _count(F.col("_plain"), '"')) % 2 == 1
    outside = F.regexp_replace(
        F.when(starts_inside, F.concat(F.lit('"'), "_plain")).otherwise(F.col("_plain")), '"[^"]*("|$)', "")
    closes = (F.col("_quotes") % 2 == 0).cast("bigint")
    nested = running_sums(
        counted.withColumns({"_opens": _count(outside, "{"), "_closes": closes}), KEYS, "_at",
        {"_depth": F.col("_opens") - F.col("_closes")})
    found = _joined(nested, (F.col("_closes") == 1) & (F.col("_depth") <= 0), "}")
    # The end of a file has no brace to close and no object.
    first = F.instr("record", "{")
    return found.where(first > 0).withColumn(
        "record", F.concat(F.substr("record", first, F.char_length("record")), F.lit("}")))
