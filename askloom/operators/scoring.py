"""Aggregates over evaluation rows and the quality gate."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from askloom.config import LABEL_FAIL, LABEL_PASS, QUALITY_THRESHOLD
from askloom.functions.text import as_column


class NothingEvaluated(ValueError):
    """Raised when no question reached the metrics."""


def mean_known(value: Column | str) -> Column:
    """Mean without NULL and NaN (``avg`` alone would return NaN)."""
    return F.avg(F.nanvl(as_column(value).cast("double"), F.lit(None).cast("double")))


def mean_scores(rows: DataFrame) -> DataFrame:
    """One row: means of the two metrics, their mean, mean seconds and row count.

    The global score is a mean of means, which differs from the mean over rows when the
    metrics have gaps in different rows.
    """
    return rows.agg(
        mean_known("faithfulness").alias("faithfulness"),
        mean_known("answer_relevancy").alias("answer_relevancy"),
        F.coalesce(mean_known("seconds"), F.lit(0.0)).alias("temps_moyen_reponse"),
        F.count(F.lit(1)).alias("n_evaluated"),
    ).withColumn("score_global", (F.col("faithfulness") + F.col("answer_relevancy")) / 2)


def question_counts(gated: DataFrame) -> DataFrame:
    """Total, evaluated, failed and off-topic questions per language and overall.

    ``gated`` has ``language``, ``off_topic`` and ``error``; ``language`` is NULL in the
    overall row.
    """
    answered = ~F.col("off_topic") & F.col("error").isNull()
    return gated.rollup("language").agg(
        F.count(F.lit(1)).alias("n_total"),
        F.count_if(answered).alias("n_evaluated"),
        F.count_if(~F.col("off_topic") & F.col("error").isNotNull()).alias("n_failed"),
        F.count_if("off_topic").alias("n_ignored"),
    )


def meets(score: Column | str, threshold: float = QUALITY_THRESHOLD) -> Column:
    """``score >= threshold``; false for NULL and NaN, which Spark would sort on top."""
    score = as_column(score).cast("double")
    return F.coalesce(~F.isnan(score) & (score >= threshold), F.lit(False))


def quality_gate(means: DataFrame, threshold: float = QUALITY_THRESHOLD) -> DataFrame:
    """Add ``threshold``, ``passed`` and the ``qualite`` label."""
    return (
        means.withColumn("threshold", F.lit(float(threshold)))
        .withColumn("passed", meets("score_global", threshold))
        .withColumn("qualite", F.when(F.col("passed"), LABEL_PASS).otherwise(LABEL_FAIL))
    )


def require_evaluated(means: dict) -> None:
    if not means["n_evaluated"]:
        raise NothingEvaluated("no question could be evaluated")


def unpivot_metrics(rows: DataFrame, *metrics: str) -> DataFrame:
    values = [F.col(m).cast("double").alias(m) for m in metrics]
    return rows.select(*values).unpivot([], list(metrics), "metric", "value")


def metric_summary(rows: DataFrame, *metrics: str) -> DataFrame:
    """Average, minimum and maximum per metric."""
    known = F.nanvl("value", F.lit(None).cast("double"))
    return unpivot_metrics(rows, *metrics).groupBy("metric").agg(
        F.avg(known).alias("avg_value"), F.min(known).alias("min_value"), F.max(known).alias("max_value"),
    )


def metric_checks(rows: DataFrame, *metrics: str, threshold: float = QUALITY_THRESHOLD) -> DataFrame:
    """Values in [0, 1] and values that reach the threshold, per metric."""
    return unpivot_metrics(rows, *metrics).groupBy("metric").agg(
        F.count("value").alias("n_values"),
        F.count_if(meets("value", threshold)).alias("n_passed"),
        F.bool_and(F.col("value").between(0.0, 1.0)).alias("in_range"),
    )


def result_rows(rows: DataFrame) -> DataFrame:
    """The result table: original and English question, answer, ground truth."""
    return rows.select(
        F.col("question").alias("question_originale"),
        F.col("question_en").alias("question_anglais"),
        F.col("answer").alias("reponse_rag"),
        "ground_truth",
    )
