"""From raw documents to a training mix: five stages, each by an operator of ``askloom.llm``.

Every stage takes what the one before kept, written as Parquet and read again.  The first
four return the columns of ``documents``; the last returns the mix, one row per document that
is taken with the number of its copies.
"""

from __future__ import annotations

import os
import sys

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from askloom.llm.decontamination import drop_contaminated  # noqa: E402
from askloom.llm.frames import read, written  # noqa: E402
from askloom.llm.jaccard import keep_one_of_each  # noqa: E402
from askloom.llm.mixing import mix_sources  # noqa: E402
from askloom.llm.queries import WEIGHTS, training_labels  # noqa: E402
from askloom.llm.secrets import redact_secrets  # noqa: E402
from askloom.llm.toxicity import drop_toxic, train_toxicity  # noqa: E402

#: Training, connected components and hashed draws have no SQL; tests hold the stages against plain Python.
ORACLE_SQL = None


def clean_of_toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the model rejects go."""
    return drop_toxic(docs, train_toxicity(docs, training_labels(spark, sf_dir, "toxic", 3, 1)))


def one_of_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of every group of linked documents the one with the smallest id stays."""
    return keep_one_of_each(docs)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that contain a benchmark item go."""
    return drop_contaminated(docs, read(spark, sf_dir, "benchmark"))


def without_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are replaced by a mark; every document stays."""
    return redact_secrets(docs, F.col("source"), F.concat_ws("/", "source", "lang"))


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that the mix takes, with their copies and what they give to their source's target."""
    return mix_sources(docs, WEIGHTS).where("copies > 0")


STAGES = [
    ("toxicity", clean_of_toxicity),
    ("ngram_jaccard_join", one_of_near_copies),
    ("benchmark_decontamination", without_benchmark),
    ("secret_scans", without_secrets),
    ("source_mixing", mixed),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), name)
    return docs
