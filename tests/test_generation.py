import time

from pyspark.sql import functions as F

from askloom.operators.embedding import embed_or_error, hashing_embedder
from askloom.operators.hooks import Hook
from askloom.operators.metrics import back_questions, judged, with_relevancy
from askloom.operators.generation import answer, call_generator, extractive_answer, failed, generate, succeeded, translate


def shouting():
    return lambda prompts: [p.upper() for p in prompts]


def fragile():
    def reply(prompts):
        if any("bad" in p for p in prompts):
            raise RuntimeError("refused")
        return [p.upper() for p in prompts]
    return reply


def short():
    return lambda prompts: prompts[:1] if len(prompts) > 1 else ["only"]


def test_errors_stay_with_their_row(spark):
    df = spark.createDataFrame([(i, "bad" if i % 7 == 3 else f"p{i}") for i in range(40)], "id int, prompt string").coalesce(1)
    rows = generate(df, "prompt", fragile, call_size=8).collect()
    for r in rows:
        if r.prompt == "bad":
            assert r.answer is None and r.error == "RuntimeError: refused"
        else:
            assert r.answer == r.prompt.upper() and r.error is None
        assert r.seconds >= 0
    made = generate(df, "prompt", fragile)
    assert failed(made).count() == sum(r.prompt == "bad" for r in rows)
    assert succeeded(made).count() + failed(made).count() == 40


def test_wrong_number_of_replies_is_an_error_of_the_call(spark):
    df = spark.createDataFrame([("a",), ("b",)], "prompt string").coalesce(1)
    assert [r.answer for r in generate(df, "prompt", short).collect()] == ["only", "only"]


def test_null_prompts_are_not_sent(spark):
    df = spark.createDataFrame([(1, None), (2, "x")], "id int, prompt string")
    got = {r.id: r for r in generate(df, "prompt", shouting).collect()}
    assert got[1].answer is None and got[1].error is None and got[1].seconds is None
    assert got[2].answer == "X"


def test_factory_runs_once_per_partition_and_concurrency_bounds_partitions(spark):
    made = spark.sparkContext.accumulator(0)

    def counting():
        made.add(1)
        return lambda prompts: prompts

    df = spark.range(100).select(F.col("id").cast("string").alias("prompt")).repartition(10)
    out = generate(df, "prompt", counting, call_size=1, concurrency=3)
    assert out.rdd.getNumPartitions() == 3 and out.count() == 100
    assert out.where("answer = prompt").count() == 100
    assert made.value <= 6


def test_calls_are_not_duplicated(spark):
    df = spark.createDataFrame([("a",)], "prompt string").withColumn("r", call_generator("prompt", shouting))
    plan = df.select("r.text", "r.error", F.upper("r.text")).where("text = 'A'")
    assert plan._jdf.queryExecution().executedPlan().toString().count("ArrowEvalPython [") == 1


def test_translate_only_french_and_keep_the_question_on_error(spark):
    rows = [(1, "Comment fonctionne le modèle ?"), (2, "What is it?"), (3, "Comment bad fonctionne la chose ?")]
    df = spark.createDataFrame(rows, "id int, question string")

    def quoting():
        inner = fragile()
        return lambda prompts: [f'  "\'{p}\'" ' for p in inner(prompts)]

    got = {r.id: (r.language, r.question_en) for r in translate(df, quoting, template="{question}").collect()}
    assert got == {1: ("fr", rows[0][1].upper()), 2: ("en", rows[1][1]), 3: ("fr", rows[2][1])}
    assert {r.question_en for r in translate(df).collect()} == {q for _, q in rows}


def test_extractive_answer(spark):
    df = spark.createDataFrame([
        ("what is the red fox", ["A dog ran. The red fox slept.", "Is the fox red? yes the red fox is"]),
        ("unrelated", ["First here. Second there."]), ("x", []), ("x", None),
    ], "question string, contexts array<string>")
    got = [r.a for r in df.select(extractive_answer("question", "contexts").alias("a")).collect()]
    assert got == ["Is the fox red", "First here", "", ""]


def test_default_answer_has_the_generator_columns(spark):
    df = spark.createDataFrame([("q", ["c"], "p")], "question string, contexts array<string>, prompt string")
    a, b = answer(df), answer(df, shouting)
    assert a.columns == b.columns and [f.dataType for f in a.schema] == [f.dataType for f in b.schema]
    assert b.head().answer == "P"


def test_seconds_measure_the_call(spark):
    def slow():
        def reply(prompts):
            time.sleep(0.2)
            return prompts
        return reply

    df = spark.createDataFrame([("a",)], "prompt string")
    assert generate(df, "prompt", slow).head().seconds >= 0.2


def hanging():
    def reply(prompts):
        if any("slow" in p for p in prompts):
            time.sleep(30)
        return [p.upper() for p in prompts]
    return reply


def test_time_limit(spark):
    df = spark.createDataFrame([("a",), ("slow",), ("b",)], "prompt string").coalesce(1)
    started = time.perf_counter()
    rows = {r.prompt: r for r in generate(df, "prompt", hanging, time_limit=1.0).collect()}
    assert time.perf_counter() - started < 25
    assert rows["slow"].answer is None and rows["slow"].error.startswith("TimeoutError")
    assert rows["a"].answer == "A" and rows["b"].answer == "B"


def asleep(*_):
    time.sleep(30)


def test_one_item_that_hangs_does_not_take_the_others_time():
    def reply(items):
        if "slow" in items:
            time.sleep(30)
        return [i.upper() for i in items]

    hook = Hook(reply, 2.0)
    started = time.perf_counter()
    found = hook.outcomes(["a", "slow", "b", "c"])
    assert time.perf_counter() - started < 5
    assert [o.value for o in found] == ["A", None, "B", "C"] and found[1].error.startswith("TimeoutError")
    assert hook.silent == 0


def test_a_hook_that_never_replies_is_given_up():
    hook = Hook(asleep, 0.2)
    started = time.perf_counter()
    found = [hook.outcomes(list(range(10))) for _ in range(50)]
    assert time.perf_counter() - started < 5
    assert all(o.value is None and o.error.startswith("TimeoutError") for part in found for o in part)
    assert "not asked" in found[-1][0].error and "not asked" not in found[0][0].error


def test_a_failure_is_not_silence():
    def refuses(items):
        raise ValueError("no")

    hook = Hook(refuses, 1.0)
    assert {o.error for _ in range(9) for o in hook.outcomes([1, 2])} == {"ValueError: no"}
    assert hook.silent == 0 and hook.outcomes([]) == []


def test_all_hooks_have_a_limit(spark):
    df = spark.createDataFrame([(i, f"Comment fonctionne le mod\u00e8le {i} ?", "It runs. It stops.") for i in range(200)],
                               "id int, question string, answer string").coalesce(1)
    def generator():
        return asleep

    started = time.perf_counter()
    rows = translate(df, generator, template="{question}", time_limit=0.2)
    rows = rows.withColumn("j", judged("answer", F.array("question"), generator, 0.2))
    rows = with_relevancy(rows, generated=back_questions("answer", generator, n=3, time_limit=0.2))
    rows = rows.withColumn("e", embed_or_error("question", generator, 0.2)).collect()
    assert time.perf_counter() - started < 40
    for r in rows:
        assert r.question_en == r.question and r.j.share is None and r.j.error.startswith("TimeoutError")
        assert r.answer_relevancy is None and r.e.vector is None and r.e.error.startswith("TimeoutError")


def test_calls_of_a_model_are_as_many_as_batches(spark):
    """Three back-questions an answer, and their vectors with the question's."""
    asked, embedded = spark.sparkContext.accumulator(0), spark.sparkContext.accumulator(0)

    def generator():
        def reply(prompts):
            asked.add(1)
            return [f"{len(p)} words" for p in prompts]
        return reply

    def embedder():
        model = hashing_embedder()()

        def embed(texts):
            embedded.add(1)
            return model(texts)
        return embed

    df = spark.createDataFrame([(i, f"{i} words", "Some answer") for i in range(64)], "id int, question string, answer string").coalesce(1)
    rows = with_relevancy(df, generated=back_questions("answer", generator, n=3), embedder=embedder, n=3).collect()
    assert (asked.value, embedded.value) == (2, 1)
    assert all(0 < r.answer_relevancy <= 1 for r in rows)
