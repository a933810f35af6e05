"""Sources shown with an answer."""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from askloom.config import UNKNOWN_PAGE, UNKNOWN_SOURCE
from askloom.functions.text import as_column, base_name, excerpt


def file_label(source: Column | str = "source") -> Column:
    return base_name(F.coalesce(as_column(source), F.lit(UNKNOWN_SOURCE)))


def page_label(page: Column | str = "page") -> Column:
    return F.coalesce(as_column(page).cast("string"), F.lit(UNKNOWN_PAGE))


def distinct_sources(hits: DataFrame, question: str = "question_id") -> DataFrame:
    """First hit of every (file, page) of a question, as ``file, page, excerpt, rank``.

    A question has at most k hits, so its groups are small whatever the files are.
    """
    shown = hits.select(
        question, "rank", file_label().alias("file"), page_label().alias("page"),
        excerpt("text").alias("excerpt"),
    )
    same = Window.partitionBy(question, "file", "page").orderBy("rank")
    return shown.withColumn("_n", F.row_number().over(same)).where("_n = 1").drop("_n")


def attach_sources(answers: DataFrame, hits: DataFrame, question: str = "question_id") -> DataFrame:
    """Add ``sources``, the de-duplicated sources in retrieval order."""
    listed = (
        distinct_sources(hits, question)
        .groupBy(question)
        .agg(F.sort_array(F.collect_list(F.struct("rank", "file", "page", "excerpt"))).alias("_s"))
        .select(question, F.transform(
            "_s", lambda s: F.struct(s["file"].alias("source"), s["page"].alias("page"),
                                     s["excerpt"].alias("excerpt"))).alias("sources"))
    )
    none = F.array().cast("array<struct<source:string,page:string,excerpt:string>>")
    return answers.join(listed, question, "left").withColumn("sources", F.coalesce("sources", none))
