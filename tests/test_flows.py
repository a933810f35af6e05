import numpy as np
import pytest
from pyspark.sql import functions as F

from askloom import schemas
from askloom.config import Settings
from askloom.operators.scoring import NothingEvaluated
from askloom.plans.ask import ask, conversation_questions, search
from askloom.plans.evaluate import evaluate, record_evaluation
from askloom.plans.ingest import ingest_folder
from askloom.sources.index import STORED_KEY, read_index
from askloom.sources.results import read_results, read_runs

TEXTS = {
    "gardens.txt": "Tomatoes need sun and water every day. Roses are pruned in early spring. " * 20,
    "ships.txt": "The harbour master logs every ship. Sailing boats wait for the evening tide. " * 20,
    "tiny.txt": "Volcano!",
}


@pytest.fixture(scope="module")
def settings(tmp_path_factory):
    base = tmp_path_factory.mktemp("flow")
    docs = base / "documents"
    docs.mkdir()
    for name, text in TEXTS.items():
        (docs / name).write_text(text)
    return Settings(docs_folder=str(docs), index_path=str(base / "index"), top_k=3)


@pytest.fixture(scope="module")
def index(spark, settings):
    assert ingest_folder(spark, settings)
    return read_index(spark, settings.index_path)


def test_ingest(spark, settings, index, tmp_path):
    rows = index.collect()
    assert {r.source.rsplit("/", 1)[1] for r in rows} == set(TEXTS)
    assert all(len(r.text) <= 800 and len(r.embedding) == 384 for r in rows)
    assert not ingest_folder(spark, Settings(docs_folder=str(tmp_path), index_path=str(tmp_path / "i")))
    assert not (tmp_path / "i").exists()


def test_search_finds_the_right_file(spark, settings, index):
    asked = spark.createDataFrame([(1, "when are roses pruned"), (2, "who logs every ship")], "question_id int, question string")
    hits = search(asked, index, settings, key=STORED_KEY)
    best = {r.question_id: r.source.rsplit("/", 1)[1] for r in hits.where("rank = 1").collect()}
    assert best == {1: "gardens.txt", 2: "ships.txt"}
    assert hits.groupBy("question_id").count().where("count > 3").isEmpty()


def test_ask_with_history_and_a_generator(spark, settings, index):
    messages = spark.createDataFrame([
        (1, 0, "system", "be kind"), (1, 1, "user", "when are roses pruned"), (1, 2, "assistant", "In spring."),
        (1, 3, "user", "and watered"), (2, 0, "user", "who logs every ship"),
    ], "conv_id int, turn int, role string, text string")
    asked = conversation_questions(messages)
    echo = lambda: (lambda prompts: [f"[{p}]" for p in prompts])
    rows = {r.question_id: r for r in ask(asked, index, settings, generator=echo, key=STORED_KEY).collect()}
    second = rows["1/3"]
    assert second.question == "when are roses pruned and watered"
    assert "user: when are roses pruned\nassistant: In spring." in second.prompt and "be kind" not in second.prompt
    assert second.answer == f"[{second.prompt}]" and second.sources[0].source == "gardens.txt"
    assert rows.keys() == {"1/3", "2/0"} and "user:" not in rows["2/0"].prompt


def test_follow_ups_can_be_worded_by_a_generator(spark):
    messages = spark.createDataFrame([
        (1, 0, "user", "who is Ada"), (1, 1, "assistant", "A writer."), (1, 2, "user", "when"), (2, 0, "user", "first"),
    ], "conv_id int, turn int, role string, text string")

    def model():
        return lambda prompts: [f'"when did {p.splitlines()[1].split()[-1]} live"' for p in prompts]

    got = {r.question_id: (r.question, len(r.history)) for r in conversation_questions(messages, model).collect()}
    assert got == {"1/2": ("when did Ada live", 2), "2/0": ("first", 0)}
    after_reset = conversation_questions(messages, model, reset=F.col("turn") == 2).collect()
    assert {r.question for r in after_reset} == {"when", "first"}


def test_default_answer_comes_from_the_contexts(spark, settings, index):
    asked = spark.createDataFrame([(1, "when are roses pruned")], "question_id int, question string")
    row = ask(asked, index, settings, key=STORED_KEY).head()
    assert row.answer == "Roses are pruned in early spring" and row.error is None


QUESTIONS = [
    (1, "when are roses pruned", "spring"), (2, "Comment le quai des bateaux fonctionne la nuit", "tide"),
    (3, "volcano", "none"), (4, "crash on every ship", "x"), (5, "zzz qqq", "nothing"),
]


def test_evaluate_and_record(spark, settings, index, tmp_path):
    def model():
        def reply(prompts):
            if any("Question: crash" in p for p in prompts):
                raise RuntimeError("down")
            return ["sailing boats wait" if "quai" in p else "Roses are pruned in early spring." for p in prompts]
        return reply

    asked = spark.createDataFrame(QUESTIONS, "question_id int, question string, ground_truth string")
    run = evaluate(asked, index, settings, generator=model, key=STORED_KEY)
    total = run.counts.where(F.col("language").isNull()).head()
    # The best chunk for "volcano" is too short and "zzz qqq" has the zero cosine with all.
    assert total.n_total == 5 and total.n_failed == 1 and total.n_ignored >= 1
    rows = {r.question_id: r for r in run.rows.collect()}
    assert 3 not in rows and 4 not in rows
    assert rows[2].language == "fr" and rows[2].question_en == "sailing boats wait"
    assert rows[1].faithfulness == 1.0
    paths = str(tmp_path / "csv"), str(tmp_path / "runs")
    passed = record_evaluation(run, *paths, settings, tags={"commit": "abc"})
    assert passed == run.passed
    assert read_results(spark, paths[0]).count() == len(rows)
    record = read_runs(spark, paths[1]).head()
    assert len(record.params) == 9 and len(record.metrics) == 4 and len(record.tags) == 4
    assert record.params["nb_questions_evaluees"] == str(len(rows)) and record.tags["commit"] == "abc"


def test_metrics_with_models(spark, settings, index):
    judge = lambda: (lambda statements, contexts: [False] * len(statements))
    back = lambda: (lambda prompts: ["when are roses pruned"] * len(prompts))
    asked = spark.createDataFrame(QUESTIONS[:1], "question_id int, question string, ground_truth string")
    [row] = evaluate(asked, index, settings, judge=judge, back_generator=back, key=STORED_KEY).rows.collect()
    assert row.faithfulness == 0 and row.answer_relevancy == pytest.approx(1)


def test_nothing_evaluated(spark, settings, index, tmp_path):
    asked = spark.createDataFrame([(1, "volcano", "x")], "question_id int, question string, ground_truth string")
    run = evaluate(asked, index, settings, key=STORED_KEY)
    assert not run.passed
    with pytest.raises(NothingEvaluated):
        record_evaluation(run, str(tmp_path / "a"), str(tmp_path / "b"), settings)


def test_other_embedder(spark, settings, tmp_path):
    own = Settings(docs_folder=settings.docs_folder, index_path=str(tmp_path / "index"))
    factory = lambda: (lambda texts: np.array([[t.count("ship") + 1.0, t.count("rose") + t.count("Rose") + 1.0] for t in texts]))
    assert ingest_folder(spark, own, embedder=factory)
    stored = read_index(spark, own.index_path)
    assert stored.schema["embedding"].dataType == schemas.VECTOR and len(stored.head().embedding) == 2
    hits = search(spark.createDataFrame([(1, "ship ship ship")], "question_id int, question string"), stored, own, factory, key=STORED_KEY)
    assert hits.where("rank = 1").head().source.endswith("ships.txt")
