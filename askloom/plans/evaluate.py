"""Evaluate flow: question set -> language -> translation -> gate -> answers -> metrics ->
aggregates -> quality gate -> result CSV and run log."""

from __future__ import annotations

import time
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from askloom.config import METRIC_TIME_LIMIT, Settings
from askloom.operators import scoring
from askloom.operators.embedding import EmbedderFactory
from askloom.operators.generation import GeneratorFactory, answer, succeeded, translate
from askloom.operators.metrics import JudgeFactory, back_questions, faithfulness, judged, with_relevancy
from askloom.operators.hits import gather_hits, is_off_topic
from askloom.operators.prompts import default_contexts, prompt
from askloom.operators.retrieval import retrieve
from askloom.plans.ask import question_vectors
from askloom.session import cut_lineage
from askloom.sources.results import append_run, evaluation_report, run_record, write_report, write_results


def gated_answers(
    questions: DataFrame,
    index: DataFrame,
    settings: Settings = Settings(),
    embedder: EmbedderFactory | None = None,
    generator: GeneratorFactory | None = None,
    key: Sequence[str] | None = None,
) -> DataFrame:
    """All questions with ``language``, ``question_en``, ``off_topic`` and, for those on
    topic, ``contexts``, ``answer``, ``error`` and ``seconds``.

    Written once after the translation (retrieval must see the wording that is
    answered) and once after the answers, so that no model is asked twice.
    """
    asked = translate(questions, generator, time_limit=settings.time_limit)
    if generator is not None:
        asked = cut_lineage(asked)
    vectors = cut_lineage(question_vectors(asked, embedder, "question_en", settings.time_limit))
    hits = retrieve(vectors.drop("embed_error"), index, settings.top_k, key=key)
    gated = (
        asked.join(vectors.drop("embedding"), "question_id", "left")
        .join(gather_hits(hits).drop("sources"), "question_id", "left")
        .withColumn("off_topic", is_off_topic() & F.col("embed_error").isNull()).drop("best_chars")
        .withColumn("contexts", F.when(~F.col("off_topic"), default_contexts("contexts")))
        .withColumn("prompt", F.when(
            ~F.col("off_topic") & F.col("embed_error").isNull(), prompt("question_en", "contexts", None, settings.prompt_template)))
    )
    answered = answer(gated, generator, question="question_en", time_limit=settings.time_limit).drop("prompt")
    return cut_lineage(answered.withColumns({
        "answer": F.when(~F.col("off_topic") & F.col("embed_error").isNull(), F.col("answer")),
        "error": F.coalesce("embed_error", "error")}).drop("embed_error"))


def score_answers(
    gated: DataFrame,
    embedder: EmbedderFactory | None = None,
    judge: JudgeFactory | None = None,
    back_generator: GeneratorFactory | None = None,
    time_limit: float | None = METRIC_TIME_LIMIT,
) -> DataFrame:
    """Answered questions with both metrics.  Off-topic and failed ones are left out.

    Every call of a hook may take ``time_limit`` seconds.

    A judge that fails leaves ``faithfulness`` NULL and its message in ``judge_error``; means
    skip such rows.
    """
    rows = with_relevancy(
        succeeded(gated).where(~F.col("off_topic")), "question_en",
        back_questions("answer", back_generator, time_limit=time_limit), embedder,
        time_limit=None if embedder is None else time_limit)
    if judge is None:
        scored = rows.withColumn("faithfulness", faithfulness("answer", "contexts")).withColumn(
            "judge_error", F.lit(None).cast("string"))
    else:
        scored = rows.withColumn("_judged", judged("answer", "contexts", judge, time_limit)).withColumn(
            "faithfulness", F.col("_judged.share")).withColumn("judge_error", F.col("_judged.error")).drop("_judged")
    return scored


@dataclass(frozen=True)
class Evaluation:
    rows: DataFrame
    counts: DataFrame
    gate: DataFrame
    seconds: float  # from the questions to the written scores

    @property
    def passed(self) -> bool:
        return self.gate.head()["passed"]


def evaluate(
    questions: DataFrame,
    index: DataFrame,
    settings: Settings = Settings(),
    embedder: EmbedderFactory | None = None,
    generator: GeneratorFactory | None = None,
    judge: JudgeFactory | None = None,
    back_generator: GeneratorFactory | None = None,
    key: Sequence[str] | None = None,
) -> Evaluation:
    """The whole flow.  The scores are written once, as the gate, the result table and the
    run log all read them."""
    started = time.perf_counter()
    gated = gated_answers(questions, index, settings, embedder, generator, key)
    rows = cut_lineage(score_answers(gated, embedder, judge, back_generator, settings.metric_time_limit))
    gate = scoring.quality_gate(scoring.mean_scores(rows), settings.quality_threshold)
    return Evaluation(rows, scoring.question_counts(gated), gate, time.perf_counter() - started)


def record_evaluation(
    run: Evaluation,
    results_path: str,
    runs_path: str,
    settings: Settings = Settings(),
    tags: Mapping[str, str] | None = None,
    report_path: str | None = None,
) -> bool:
    """Write the result CSV, one run record and, if asked for, the report; True when the gate is passed.

    Raises ``NothingEvaluated`` when no question reached the metrics.
    """
    gate = run.gate.head().asDict()
    scoring.require_evaluated(gate)
    total = run.counts.where(F.col("language").isNull()).head()
    write_results(scoring.result_rows(run.rows), results_path)
    record = run_record(
        run.rows.sparkSession,
        f"eval_{settings.generator_model}",
        # The names of parameters, metrics and tags.
        params={
            "llm_model": settings.generator_model,
            "embedding_model": settings.embedding_model,
            "chunk_size": settings.chunk_size,
            "chunk_overlap": settings.chunk_overlap,
            "top_k": settings.top_k,
            "nb_questions_total": total["n_total"],
            "nb_questions_evaluees": total["n_evaluated"],
            "nb_questions_ignorees": total["n_ignored"],
            "seuil_qualite": settings.quality_threshold,
        },
        metrics={
            "faithfulness": gate["faithfulness"],
            "answer_relevancy": gate["answer_relevancy"],
            "score_global": gate["score_global"],
            "temps_moyen_reponse": round(gate["temps_moyen_reponse"], 2),
        },
        tags={
            "qualite": gate["qualite"], "llm": settings.generator_model,
            "evaluation": "faithfulness+answer_relevancy", **(tags or {}),
        },
        artifact=results_path,
    )
    append_run(record, runs_path)
    if report_path:
        write_report(evaluation_report(run.gate, run.seconds), report_path)
    return gate["passed"]
