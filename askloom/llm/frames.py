"""Steps that several operators share: inputs, written tables and hash folds."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from askloom.session import scratch_path

SPACE = r"\x20\x09-\x0D"
WORD = rf"[^{SPACE}]+"


def read(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def written(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and go on from the copy.

    It cuts the lineage: whatever is lost later is read again, not computed again, and
    a value that depends on the order of rows stays what it was at first.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def fold(key: Column | str, folds: int) -> Column:
    """The part of a key's row: CRC-32 of the key written as text, modulo ``folds``."""
    key = F.col(key) if isinstance(key, str) else key
    return F.crc32(key.cast("string")) % folds


def held_out(key: Column | str, folds: int, part: int) -> Column:
    """True for the rows that learning must not see; a null key is never held out."""
    return F.coalesce(fold(key, folds) == part, F.lit(False))


def numbered(df: DataFrame, *key: str, out: str) -> DataFrame:
    """Tell repeated rows of one key apart by a number from 1."""
    from pyspark.sql import Window

    order = [F.col(c).asc_nulls_last() for c in df.columns]
    return df.withColumn(out, F.row_number().over(Window.partitionBy(*key).orderBy(*order)))
