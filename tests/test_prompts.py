from pyspark.sql import functions as F

from askloom.operators.citations import attach_sources, distinct_sources
from askloom.operators.prompts import assemble_contexts, default_contexts, prompt

SCHEMA = "question_id int, rank int, source string, page int, text string"
HITS = [
    (1, 1, "/c/a.txt", 0, "first"), (1, 2, "/d/a.txt", 0, "same file name and page"), (1, 3, "/c/a.txt", 1, "other page"),
    (1, 4, None, None, "no source"), (1, 5, "/c/b.pdf", None, "x" * 401), (2, 1, "b", 2, "only"),
]


def test_sources_keep_the_first_hit_per_file_and_page(spark):
    rows = distinct_sources(spark.createDataFrame(HITS, SCHEMA)).orderBy("question_id", "rank").collect()
    assert [(r.question_id, r.file, r.page, r["rank"]) for r in rows] == [
        (1, "a.txt", "0", 1), (1, "a.txt", "1", 3), (1, "unknown", "—", 4), (1, "b.pdf", "—", 5), (2, "b", "2", 1)]
    assert rows[3].excerpt == "x" * 400 + "..."


def test_answers_carry_their_sources(spark):
    answers = spark.createDataFrame([(1, "a"), (3, "none")], "question_id int, answer string")
    got = {r.question_id: [s.source for s in r.sources] for r in attach_sources(answers, spark.createDataFrame(HITS, SCHEMA)).collect()}
    assert got == {1: ["a.txt", "a.txt", "unknown", "b.pdf"], 3: []}


def test_contexts_in_order_with_and_without_citation(spark):
    hits = spark.createDataFrame(HITS, SCHEMA).orderBy(F.desc("rank"))
    plain = {r.question_id: r.contexts for r in assemble_contexts(hits).collect()}
    assert plain[1][:2] == ["first", "same file name and page"] and len(plain[1]) == 5
    cited = {r.question_id: r.contexts for r in assemble_contexts(hits, cite=True).collect()}
    assert cited[2] == ["[b p.2] only"] and cited[1][3] == "[unknown p.—] no source"


def test_default_context(evaluate):
    assert evaluate(default_contexts("c"), "c array<string>", []) == [""]
    assert evaluate(default_contexts("c"), "c array<string>", None) == [""]
    assert evaluate(default_contexts("c"), "c array<string>", ["x"]) == ["x"]


def test_prompt(spark):
    df = spark.createDataFrame([("why {context}?", ["a {question}", "b"], [("user", "hi"), ("assistant", "yo")])],
                               "q string, c array<string>, h array<struct<role:string,text:string>>")
    template = "{context}|{chat_history}|{question}"
    row = df.select(prompt("q", "c", F.col("h"), template).alias("with"), prompt("q", "c", None, template).alias("without")).head()
    assert row["with"] == "a {question}\n\nb|user: hi\nassistant: yo|why {context}?"
    assert row["without"] == "a {question}\n\nb||why {context}?"
