"""A local session for tests, comparison and bench."""

from __future__ import annotations

import tempfile

from pyspark.sql import SparkSession


def local_session(cores: int | str = 8, memory: str = "16g") -> SparkSession:
    spark = (
        SparkSession.builder.master(f"local[{cores}]").appName("askloom")
        .config("spark.driver.memory", memory)
        .config("spark.sql.shuffle.partitions", str(cores if cores != "*" else 8))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="run-"))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark
