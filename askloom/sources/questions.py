"""Question sets."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from askloom import schemas
from askloom.operators.windows import running_number
from askloom.sources.records import json_records


def read_questions(spark: SparkSession, path: str) -> DataFrame:
    """``(question_id, question, ground_truth)`` of JSON arrays or JSON lines, numbered from 1.

    Files count in the order of their names.  A file of any size is read by as many tasks as it
    has splits, however the array is laid out.  A record that cannot be parsed, or whose values
    are no text, has NULL in their place.
    """
    read = F.from_json("record", schemas.QUESTIONS)
    rows = json_records(spark, path).withColumn("_read", read)
    return running_number(rows, "_file", "_record", out="question_id").select(
        "question_id", *[F.col(f"_read.{name}").alias(name) for name in schemas.QUESTIONS.names])


def _array_lines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    before, held = "[", False
    for batch in batches:
        lines = []
        for record in batch.column(0).to_pylist():
            lines.append(before + record)
            before, held = ",", True
        yield pa.RecordBatch.from_pydict({"value": pa.array(lines, pa.string())})
    yield pa.RecordBatch.from_pydict({"value": pa.array(["]" if held else "[]"], pa.string())})


def write_questions(questions: DataFrame, path: str) -> None:
    """JSON arrays, one file for each partition; ``read_questions`` reads them back.

    NULL is left out of a record.
    """
    records = questions.select(F.to_json(F.struct(*schemas.QUESTIONS.names)).alias("value"))
    records.mapInArrow(_array_lines, "value string").write.mode("overwrite").text(path)
