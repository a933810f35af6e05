"""Per-answer quality metrics between 0 and 1."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from askloom.config import BACK_QUESTION_TEMPLATE
from askloom.functions.text import as_column, bind, distinct_tokens, fill_template, sentences
from askloom.functions.vectors import cosine, round_score
from askloom.operators.embedding import EmbedderFactory, embed_each
from askloom.operators.generation import GeneratorFactory, call_generator_times
from askloom.operators.hooks import Hook

# ``(statements, contexts) -> one verdict per statement``
Judge = Callable[[list[str], list[str]], Sequence[bool]]
JudgeFactory = Callable[[], Judge]
VERDICT = pa.struct([("share", pa.float64()), ("error", pa.string())])


def context_tokens(contexts: Column | str) -> Column:
    return F.array_distinct(F.flatten(F.transform(as_column(contexts), distinct_tokens)))


def faithfulness(
    answer: Column | str, contexts: Column | str, judge: JudgeFactory | None = None, time_limit: float | None = None
) -> Column:
    """Share of the answer's statements that the contexts support; NULL without any.

    The default judge accepts a statement when at least half of its distinct tokens
    occur in the contexts.  A judge that fails gives NULL; ``judged`` tells why.
    """
    if judge is not None:
        return judged(answer, contexts, judge, time_limit)["share"]

    def share(statements: Column) -> Column:
        def supported(known: Column) -> Column:
            def verdict(words: Column) -> Column:
                return (F.size(words) > 0) & (F.size(F.array_intersect(words, known)) * 2 >= F.size(words))

            return F.size(F.filter(statements, lambda s: bind(distinct_tokens(s), verdict)))

        return F.when(F.size(statements) > 0,
                      bind(context_tokens(contexts), supported) / F.size(statements))

    return bind(sentences(answer), share)


def judged(answer: Column | str, contexts: Column | str, judge: JudgeFactory, time_limit: float | None = None) -> Column:
    """``STRUCT<share, error>`` of an answer; a judge that raises, gives another number of
    verdicts than statements or takes longer than ``time_limit`` seconds leaves the share NULL
    and says so in ``error``."""

    def share(hook: Hook, some: list[str] | None, known: list[str] | None) -> dict:
        if not some:
            return {"share": None, "error": None}
        [found] = hook.outcomes([(some, known or [])])
        return {"share": found.value, "error": found.error}

    @F.arrow_udf("share double, error string")
    def run(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        decide = judge()

        def shares(rows: list) -> list[float]:
            [(some, known)] = rows
            verdicts = decide(some, known)
            if len(verdicts) != len(some):
                raise ValueError(f"{len(verdicts)} verdicts on {len(some)} statements")
            return [sum(map(bool, verdicts)) / len(some)]

        hook = Hook(shares, time_limit)
        for statements, contexts in batches:
            yield pa.array([share(hook, s, c) for s, c in zip(statements.to_pylist(), contexts.to_pylist())], VERDICT)

    return run.asNondeterministic()(sentences(answer), as_column(contexts))


def first_sentence(answer: Column | str) -> Column:
    return F.get(sentences(answer), F.lit(0))


def back_questions(
    answer: Column | str, generator: GeneratorFactory | None = None, n: int = 1,
    template: str = BACK_QUESTION_TEMPLATE, time_limit: float | None = None,
) -> Column:
    """``n`` questions that the answer would be an answer to, as an array, all asked in one call.

    The default is the answer's first sentence, once.  Failed calls give no question.
    """
    if generator is None:
        return F.array(first_sentence(answer))
    filled = fill_template(template, answer=as_column(answer))
    return F.array_compact(call_generator_times(filled, generator, n, time_limit=time_limit)["text"])


def with_relevancy(
    rows: DataFrame,
    question: str = "question",
    generated: Column | None = None,
    embedder: EmbedderFactory | None = None,
    n: int = 1,
    time_limit: float | None = None,
) -> DataFrame:
    """Add ``answer_relevancy``: the mean cosine between the question and the up to ``n``
    questions ``generated`` from the answer (default: the answer's first sentence).

    Row by row: nothing is shuffled, and the question and what was made of the answer are embedded
    in one call.  A question that cannot be compared is skipped, as is one on which the
    embedder fails.  The cosine divides by both lengths, so the model need not return unit vectors.
    """
    made = back_questions("answer") if generated is None else generated
    # With the question first; an answer without questions has an empty rest.
    texts = F.concat(F.array(F.col(question)), F.coalesce(F.slice(made, 1, n), F.array().cast("array<string>")))
    vectors = rows.withColumn("_v", embed_each(texts, embedder, time_limit)["vector"])
    cosines = vectors.withColumn("_c", F.array_compact(F.transform(
        F.slice("_v", F.lit(2), F.greatest(F.size("_v") - 1, F.lit(0))), lambda v: cosine(F.get("_v", F.lit(0)), v))))
    mean = F.aggregate("_c", F.lit(0.0), lambda acc, c: acc + c) / F.nullif(F.size("_c"), F.lit(0))
    return cosines.withColumn("answer_relevancy", mean).drop("_v", "_c")


def answer_relevancy(
    rows: DataFrame,
    question_id: str = "question_id",
    question: str = "question",
    answer: str = "answer",
    generated: Column | None = None,
    embedder: EmbedderFactory | None = None,
    n: int = 1,
) -> DataFrame:
    """``(question_id, answer_relevancy)``, see ``with_relevancy``."""
    made = back_questions(answer) if generated is None else generated
    return with_relevancy(rows.select(question_id, question, answer), question, made, embedder, n).select(
        question_id, "answer_relevancy")


def context_relevancy(question: Column | str, contexts: Column | str) -> Column:
    """Share of the question's distinct tokens that occur in the contexts."""

    def share(asked: Column) -> Column:
        shared = F.size(F.array_intersect(asked, context_tokens(contexts)))
        return F.when(F.size(asked) > 0, shared / F.size(asked))

    return bind(distinct_tokens(question), share)


def rounded(df: DataFrame, *metrics: str) -> DataFrame:
    return df.withColumns({m: round_score(m) for m in metrics})
