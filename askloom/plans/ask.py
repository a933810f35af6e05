"""Ask flow: questions -> stand-alone questions -> hits -> prompts -> answers + sources."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from askloom.config import Settings
from askloom.operators.chat import chat_history, dialogue, standalone_questions, with_epoch, with_pending
from askloom.operators.embedding import EmbedderFactory, embed_or_error
from askloom.operators.generation import GeneratorFactory, answer, reword_follow_ups
from askloom.operators.hits import gather_hits, or_no_sources
from askloom.operators.prompts import default_contexts, prompt
from askloom.operators.retrieval import retrieve
from askloom.session import cut_lineage


def search(
    questions: DataFrame,
    index: DataFrame,
    settings: Settings = Settings(),
    embedder: EmbedderFactory | None = None,
    text: str = "question",
    key: Sequence[str] | None = None,
) -> DataFrame:
    """Hits of a questions table ``(question_id, text)`` with their chunk texts.

    A question on which the embedder fails has none; ``question_vectors`` says why.
    """
    vectors = question_vectors(questions, embedder, text, settings.time_limit)
    return retrieve(vectors.drop("embed_error"), index, settings.top_k, key=key)


def question_vectors(
    questions: DataFrame, embedder: EmbedderFactory | None = None, text: str = "question", time_limit: float | None = None
) -> DataFrame:
    """``(question_id, embedding, embed_error)``."""
    made = questions.select("question_id", embed_or_error(text, embedder, time_limit).alias("_made"))
    return made.select("question_id", F.col("_made.vector").alias("embedding"), F.col("_made.error").alias("embed_error"))


def ask(
    questions: DataFrame,
    index: DataFrame,
    settings: Settings = Settings(),
    embedder: EmbedderFactory | None = None,
    generator: GeneratorFactory | None = None,
    text: str = "question",
    key: Sequence[str] | None = None,
    cite: bool = False,
) -> DataFrame:
    """``questions`` with ``contexts``, ``prompt``, ``answer``, ``error``, ``seconds`` and
    ``sources``.  A ``history`` column of earlier messages goes into the prompt.
    """
    hits = search(questions, index, settings, embedder, text, key)
    history = F.col("history") if "history" in questions.columns else None
    prepared = (
        questions.join(gather_hits(hits, cite=cite).drop("best_chars"), "question_id", "left")
        .withColumn("contexts", default_contexts("contexts"))
        .withColumn("prompt", prompt(text, "contexts", history, settings.prompt_template))
    )
    answered = answer(prepared, generator, question=text, time_limit=settings.time_limit)
    return answered.withColumn("sources", or_no_sources())


def conversation_questions(
    messages: DataFrame, generator: GeneratorFactory | None = None, reset: Column | None = None,
    time_limit: float | None = None,
) -> DataFrame:
    """The pending user turn of every conversation as a stand-alone question with the
    history of the earlier turns.

    A generator words follow-ups anew; the default puts the previous user turn in front.
    A reset counts on any row, system messages included.
    """
    turns = with_pending(dialogue(with_epoch(messages, reset)))
    asked = chat_history(turns, F.col("pending")).select(
        "conv_id", "turn", F.concat_ws("/", "conv_id", "turn").alias("question_id"),
        F.col("text").alias("question"), "history")
    if generator is not None:
        return cut_lineage(reword_follow_ups(asked, generator, time_limit=time_limit))
    rewritten = standalone_questions(messages, reset).select(
        "conv_id", "turn", F.col("standalone").alias("question"))
    return asked.drop("question").join(rewritten, ["conv_id", "turn"])
