import math

import pytest
from pyspark.sql import functions as F

from askloom.operators import scoring
from askloom.operators.metrics import answer_relevancy, back_questions, context_relevancy, faithfulness

NAN = float("nan")
SCHEMA = "faithfulness double, answer_relevancy double, seconds double"


def gate(spark, rows):
    return scoring.quality_gate(scoring.mean_scores(spark.createDataFrame(rows, SCHEMA))).head()


def test_gaps_are_skipped_and_the_global_score_is_a_mean_of_means(spark):
    got = gate(spark, [(1.0, 0.2, 1.0), (NAN, 0.4, 3.0), (0.5, None, 2.0)])
    assert got.faithfulness == pytest.approx(0.75) and got.answer_relevancy == pytest.approx(0.3)
    assert got.score_global == pytest.approx(0.525) and got.temps_moyen_reponse == pytest.approx(2.0)
    assert got.passed and got.qualite == "✅ ACCEPTABLE" and got.n_evaluated == 3


def test_exact_threshold_passes(spark):
    assert gate(spark, [(0.25, 0.75, 0.0)]).passed


@pytest.mark.parametrize("rows", [[(NAN, 0.9, 1.0)], [(None, None, 1.0)], []])
def test_unknown_scores_fail(spark, rows):
    got = gate(spark, rows)
    assert not got.passed and got.qualite == "❌ INSUFFISANT"


def test_nothing_evaluated(spark):
    means = scoring.mean_scores(spark.createDataFrame([], SCHEMA)).head().asDict()
    assert means["temps_moyen_reponse"] == 0
    with pytest.raises(scoring.NothingEvaluated):
        scoring.require_evaluated(means)


def test_summary_and_checks(spark):
    rows = spark.createDataFrame([(0.85, 0.92)], "f double, r double")
    values = scoring.unpivot_metrics(rows, "f", "r").agg(F.avg("value"), F.min("value"), F.max("value")).head()
    assert tuple(values) == (pytest.approx(0.885), 0.85, 0.92)
    df = spark.createDataFrame([(0.85, 1.5), (0.4, 0.92), (NAN, None)], "f double, r double")
    summary = {r.metric: r for r in scoring.metric_summary(df, "f", "r").collect()}
    assert summary["f"].avg_value == pytest.approx(0.625) and summary["f"].max_value == 0.85
    checks = {r.metric: r for r in scoring.metric_checks(df, "f", "r").collect()}
    assert (checks["r"].n_values, checks["r"].n_passed, checks["r"].in_range) == (2, 2, False)
    assert checks["f"].n_passed == 1


def test_counts_keep_failures_apart(spark):
    rows = [("fr", True, None), ("fr", False, None), ("en", False, "x"), ("en", False, None)]
    got = {r.language: (r.n_total, r.n_evaluated, r.n_failed, r.n_ignored)
           for r in scoring.question_counts(spark.createDataFrame(rows, "language string, off_topic boolean, error string")).collect()}
    assert got == {None: (4, 2, 1, 1), "fr": (2, 1, 0, 1), "en": (2, 1, 1, 0)}


@pytest.mark.parametrize("answer, contexts, share", [
    ("The fox is red. It flies at night.", ["the red fox is here"], 0.5),
    ("Red fox.", ["a red fox"], 1.0), ("Blue whale.", ["a red fox"], 0.0), ("", ["a"], None), ("...", ["a"], 0.0),
])
def test_faithfulness(evaluate, answer, contexts, share):
    got = evaluate(faithfulness("a", "c"), "a string, c array<string>", answer, contexts)
    assert got == share


def test_faithfulness_with_a_judge(evaluate):
    def factory():
        return lambda statements, contexts: [s in contexts for s in statements]

    got = evaluate(faithfulness("a", "c", factory), "a string, c array<string>", "One. Two. Three", ["Two"])
    assert got == pytest.approx(1 / 3)


def test_relevancy(spark):
    rows = spark.createDataFrame([(1, "red fox", "Red fox. More."), (2, "red fox", "Blue whale"), (3, "red fox", "")],
                                 "question_id int, question string, answer string")
    got = {r.question_id: r.answer_relevancy for r in answer_relevancy(rows).collect()}
    assert got[1] == pytest.approx(1) and got[2] == pytest.approx(0, abs=1e-9) and got[3] is None
    many = answer_relevancy(rows, generated=F.array(F.lit("red fox"), F.lit("blue whale")), n=2)
    assert all(math.isclose(r.answer_relevancy, 0.5, abs_tol=1e-6) for r in many.collect())


def test_back_questions_come_from_a_generator(evaluate):
    seen = lambda: (lambda prompts: [p.strip().splitlines()[-1].upper() for p in prompts])
    assert evaluate(back_questions("a", seen, n=3), "a string", "some answer") == ["SOME ANSWER"] * 3
    broken = lambda: (lambda prompts: 1 / 0)
    assert evaluate(back_questions("a", broken, n=2), "a string", "some answer") == []


def test_context_relevancy(evaluate):
    got = evaluate(context_relevancy("q", "c"), "q string, c array<string>", "what is a red fox", ["Red!", "a fox"])
    assert got == pytest.approx(3 / 5)


def test_result_columns(spark):
    df = spark.createDataFrame([("q", "e", "a", "g", 1)], "question string, question_en string, answer string, ground_truth string, x int")
    assert scoring.result_rows(df).columns == ["question_originale", "question_anglais", "reponse_rag", "ground_truth"]
