"""Text-model calls in bulk, translation, and the default extractive answer.

A generator factory is a zero-argument callable that returns a function
``list[str] -> list[str]``.  It is called once per task, so a client is made once and
then fed batches.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from askloom.config import FOLLOW_UP_TEMPLATE, TRANSLATION_TEMPLATE
from askloom.functions.language import detect_language
from askloom.functions.text import (
    as_column, bind, distinct_tokens, fill_template, render_history, sentences, strip_quotes,
)
from askloom.operators.hooks import Hook

Generator = Callable[[list[str]], list[str]]
GeneratorFactory = Callable[[], Generator]

CALL_SIZE = 32
REPLY = pa.struct([("text", pa.string()), ("error", pa.string()), ("seconds", pa.float64())])


def call_generator(
    prompt: Column | str, factory: GeneratorFactory, call_size: int = CALL_SIZE, time_limit: float | None = None
) -> Column:
    """``STRUCT<text, error, seconds>`` per prompt; a NULL prompt is not sent.

    A failing call is repeated prompt by prompt, so an error stays with its own row; for
    ``time_limit`` seconds a call see ``hooks.Hook``.
    Marked as non-deterministic so that no optimizer rule duplicates the calls; write
    the result (``session.cut_lineage``) before using it more than once.
    """
    return F.get(call_generator_times(prompt, factory, 1, call_size, time_limit), F.lit(0))


def call_generator_times(
    prompt: Column | str, factory: GeneratorFactory, times: int, call_size: int = CALL_SIZE, time_limit: float | None = None
) -> Column:
    """``ARRAY<STRUCT<text, error, seconds>>``: every prompt asked ``times`` times, in one call with its like.

    NULL for a NULL prompt.
    """

    @F.arrow_udf("array<struct<text:string,error:string,seconds:double>>")
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        hook = Hook(factory(), time_limit)
        for batch in batches:
            prompts = batch.to_pylist()
            sent = [i for i, p in enumerate(prompts) if p is not None]
            replies: list[list[dict] | None] = [None] * len(prompts)
            for at in range(0, len(sent), call_size):
                part = sent[at:at + call_size]
                found = hook.outcomes([prompts[i] for i in part for _ in range(times)])
                for k, i in enumerate(part):
                    replies[i] = [{"text": o.value, "error": o.error, "seconds": o.seconds}
                                  for o in found[k * times:(k + 1) * times]]
            yield pa.array(replies, pa.list_(REPLY))

    return run.asNondeterministic()(as_column(prompt))


def generate(
    df: DataFrame,
    prompt: Column | str,
    factory: GeneratorFactory,
    out: str = "answer",
    call_size: int = CALL_SIZE,
    concurrency: int | None = None,
    time_limit: float | None = None,
) -> DataFrame:
    """Add ``out``, ``error`` and ``seconds``.

    ``concurrency`` bounds the calls in flight by the number of partitions.
    """
    if concurrency:
        df = df.repartition(concurrency)
    replied = df.withColumn("_reply", call_generator(prompt, factory, call_size, time_limit))
    return replied.select(
        "*", F.col("_reply.text").alias(out), F.col("_reply.error").alias("error"),
        F.col("_reply.seconds").alias("seconds"),
    ).drop("_reply")


def failed(df: DataFrame) -> DataFrame:
    return df.where(F.col("error").isNotNull())


def succeeded(df: DataFrame) -> DataFrame:
    return df.where(F.col("error").isNull())


def translate(
    questions: DataFrame,
    factory: GeneratorFactory | None = None,
    question: str = "question",
    out: str = "question_en",
    template: str = TRANSLATION_TEMPLATE,
    time_limit: float | None = None,
) -> DataFrame:
    """Add ``language`` and ``out``: French questions translated, others unchanged.

    Rows in other languages pass with a NULL prompt, so one pass over the questions
    serves both.  Without a generator, or when it fails, the question stays as it is.
    """
    questions = questions.withColumn("language", detect_language(question))
    if factory is None:
        return questions.withColumn(out, F.col(question))
    wanted = F.when(F.col("language") == "fr", fill_template(template, question=F.col(question)))
    return _reword(questions, wanted, factory, question, out, time_limit)


def reword_follow_ups(
    questions: DataFrame,
    factory: GeneratorFactory,
    question: str = "question",
    history: str = "history",
    out: str = "question",
    template: str = FOLLOW_UP_TEMPLATE,
    time_limit: float | None = None,
) -> DataFrame:
    """Set ``out`` to the question worded without its history.

    A question without history is not sent, and one whose call fails stays as it is.
    """
    filled = fill_template(template, chat_history=render_history(history), question=F.col(question))
    return _reword(questions, F.when(F.size(history) > 0, filled), factory, question, out, time_limit)


def _reword(
    questions: DataFrame, prompt: Column, factory: GeneratorFactory, question: str, out: str, time_limit: float | None
) -> DataFrame:
    reply = questions.withColumn("_reply", call_generator(prompt, factory, time_limit=time_limit))
    return reply.withColumn(out, F.coalesce(strip_quotes("_reply.text"), F.col(question))).drop("_reply")


def extractive_answer(question: Column | str, contexts: Column | str) -> Column:
    """Default answer: the sentence of the contexts that shares most distinct tokens with
    the question, the earliest of equals; empty when there is no sentence."""
    statements = F.flatten(F.transform(as_column(contexts), sentences))

    def choose(asked: Column) -> Column:
        def rate(statement: Column, at: Column) -> Column:
            shared = F.size(F.array_intersect(distinct_tokens(statement), asked))
            return F.struct(shared.alias("shared"), (-at).alias("at"), statement.alias("statement"))

        return F.array_max(F.transform(statements, rate))["statement"]

    return F.coalesce(bind(distinct_tokens(question), choose), F.lit(""))


def answer(df: DataFrame, factory: GeneratorFactory | None = None, prompt: str = "prompt",
           question: str = "question", contexts: str = "contexts", time_limit: float | None = None) -> DataFrame:
    """Add ``answer``, ``error`` and ``seconds`` from a generator or the default."""
    if factory is not None:
        return generate(df, prompt, factory, time_limit=time_limit)
    return df.select(
        "*", extractive_answer(question, contexts).alias("answer"),
        F.lit(None).cast("string").alias("error"), F.lit(0.0).alias("seconds"),
    )
