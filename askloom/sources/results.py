"""Result CSV, run log and report."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from askloom import schemas
from askloom.sources.records import csv_records

_CSV = {
    "header": True, "quote": '"', "escape": '"', "encoding": "UTF-8",
    "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False,
}
# An empty string is written in quotes and NULL as nothing.  On reading, "nothing" gets a
# name that no text has, so that the quoted empty string stays a string.
_WRITE = {**_CSV, "emptyValue": '""', "nullValue": ""}
_READ = {**_CSV, "emptyValue": "", "nullValue": "\x00", "multiLine": True}


def write_results(rows: DataFrame, path: str) -> None:
    """CSV with header; values may hold quotes, commas and newlines."""
    rows.write.mode("overwrite").options(**_WRITE).csv(path)


def read_results(spark: SparkSession, path: str, schema: T.StructType = schemas.RESULTS) -> DataFrame:
    """Rows of result CSV files; a file of any size is read by as many tasks as it has splits."""
    columns = ", ".join(f"`{field.name}` {field.dataType.simpleString()}" for field in schema)
    rows = csv_records(spark, path).where(F.col("_record") > 0)
    return rows.select(F.from_csv("record", columns, _READ).alias("_read")).select("_read.*")


def run_record(
    spark: SparkSession,
    run_name: str,
    params: Mapping[str, object],
    metrics: Mapping[str, float],
    tags: Mapping[str, str],
    artifact: str,
) -> DataFrame:
    row = (
        run_name,
        {k: str(v) for k, v in params.items()},
        {k: float(v) for k, v in metrics.items() if v is not None},
        dict(tags),
        artifact,
    )
    return spark.createDataFrame([row], schemas.RUNS)


def append_run(record: DataFrame, path: str) -> None:
    record.write.mode("append").parquet(path)


def read_runs(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(schemas.RUNS).parquet(path)


def evaluation_report(gate: DataFrame, seconds: float) -> DataFrame:
    """One row ``faithfulness, answer_relevancy, execution_time, status``."""
    return gate.select(
        "faithfulness", "answer_relevancy",
        F.lit(float(seconds)).alias("execution_time"),
        F.lit("completed").alias("status"),
    )


def write_report(report: DataFrame, path: str) -> None:
    report.write.mode("overwrite").json(path)
