"""Contexts and filled prompts."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from askloom.config import PROMPT_TEMPLATE
from askloom.functions.text import as_column, fill_template, render_history
from askloom.operators.citations import file_label, page_label

CONTEXT_JOINER = "\n\n"


def assemble_contexts(
    hits: DataFrame, question: str = "question_id", text: str = "text", cite: bool = False
) -> DataFrame:
    """``(question, contexts)`` with the texts of at most k hits, best first.

    ``cite`` puts ``[file p.N]`` in front of each text.
    """
    body = F.col(text)
    if cite:
        body = F.concat(F.lit("["), file_label(), F.lit(" p."), page_label(), F.lit("] "), body)
    collected = F.sort_array(F.collect_list(F.struct("rank", body.alias("text"))))
    return hits.groupBy(question).agg(F.transform(collected, lambda h: h["text"]).alias("contexts"))


def default_contexts(contexts: Column | str) -> Column:
    """One empty context where there is none."""
    contexts = as_column(contexts)
    none = contexts.isNull() | (F.size(contexts) == 0)
    return F.when(none, F.array(F.lit(""))).otherwise(contexts)


def prompt(
    question: Column | str,
    contexts: Column | str,
    history: Column | None = None,
    template: str = PROMPT_TEMPLATE,
) -> Column:
    """The filled template; ``history`` is an array of messages."""
    return fill_template(
        template,
        context=F.array_join(as_column(contexts), CONTEXT_JOINER),
        chat_history=F.lit("") if history is None else render_history(history),
        question=as_column(question),
    )
