"""All that an answer needs from its hits, gathered in one shuffle."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from askloom.config import MIN_HIT_CHARS
from askloom.functions.text import excerpt, strip_space
from askloom.operators.citations import file_label, page_label

NO_SOURCES = "array<struct<source:string,page:string,excerpt:string>>"


def gather_hits(hits: DataFrame, question: str = "question_id", cite: bool = False) -> DataFrame:
    """``(question, contexts, sources, best_chars)`` of the at most k hits of every question.

    ``contexts`` are the texts, best first (``cite`` puts ``[file p.N]`` in front), ``sources`` the
    first hit of every file and page in that order, ``best_chars`` the stripped length of
    the best one.
    """
    label = F.concat(F.lit("["), file_label(), F.lit(" p."), page_label(), F.lit("] "))
    row = F.struct(
        "rank", "text", (F.concat(label, "text") if cite else F.col("text")).alias("shown"),
        file_label().alias("source"), page_label().alias("page"), excerpt("text").alias("excerpt"))
    grouped = hits.groupBy(question).agg(F.sort_array(F.collect_list(row)).alias("_h"))

    def first_of_its_page(hit: Column, place: Column) -> Column:
        earlier = F.slice("_h", F.lit(1), place)
        return ~F.exists(earlier, lambda e: (e["source"] == hit["source"]) & (e["page"] == hit["page"]))

    sources = F.transform(
        F.filter("_h", first_of_its_page),
        lambda h: F.struct(h["source"].alias("source"), h["page"].alias("page"), h["excerpt"].alias("excerpt")))
    best = F.when(F.col("_h")[0]["rank"] == 1, F.char_length(strip_space(F.col("_h")[0]["text"])))
    return grouped.select(
        question, F.transform("_h", lambda h: h["shown"]).alias("contexts"), sources.alias("sources"), best.alias("best_chars"))


def is_off_topic(best_chars: Column | str = "best_chars") -> Column:
    """No hit, or a best hit shorter than 50 characters."""
    best = F.col(best_chars) if isinstance(best_chars, str) else best_chars
    return best.isNull() | (best < MIN_HIT_CHARS)


def or_no_sources(sources: Column | str = "sources") -> Column:
    return F.coalesce(F.col(sources) if isinstance(sources, str) else sources, F.array().cast(NO_SOURCES))
