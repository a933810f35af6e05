import json
import re

import pytest
from pyspark.sql import functions as F

from askloom import schemas
from askloom.sources.questions import read_questions
from askloom.sources.results import (
    append_run, evaluation_report, read_results, read_runs, run_record, write_report, write_results,
)


def test_csv_round_trip(spark, tmp_path):
    rows = [('say "hi", ok', "line\nbreak\r\nmore", "", None), ("a,b", '"', " lead", "plain"), ("é", "\\", "\\\"", "x\\")]
    path = str(tmp_path / "csv")
    write_results(spark.createDataFrame(rows, schemas.RESULTS).coalesce(1), path)
    got = {tuple(r) for r in read_results(spark, path).collect()}
    assert got == set(rows)
    head = next((tmp_path / "csv").glob("part-*.csv")).read_text(encoding="utf-8").split("\n")[0]
    assert head == ",".join(schemas.RESULTS.names)


def test_question_set(spark, tmp_path):
    data = [{"question": f"q{i}", "ground_truth": f"é {i}"} for i in range(5)]
    path = tmp_path / "set.json"
    path.write_text(json.dumps(data, indent=2, ensure_ascii=False), encoding="utf-8")
    got = [(r.question_id, r.question, r.ground_truth) for r in read_questions(spark, str(path)).orderBy("question_id").collect()]
    assert got == [(i + 1, f"q{i}", f"é {i}") for i in range(5)]
    lines = tmp_path / "lines.json"
    lines.write_text("\n".join(json.dumps(d) for d in data), encoding="utf-8")
    assert read_questions(spark, str(lines)).count() == 5
    with pytest.raises(FileNotFoundError):
        read_questions(spark, str(tmp_path / "none.json"))


def test_run_log_and_report(spark, tmp_path):
    path = str(tmp_path / "runs")
    for score in (0.8, None):
        append_run(run_record(spark, "eval", {"top_k": 6}, {"score_global": score}, {"llm": "x", "commit": "abc"}, "a.csv"), path)
    rows = sorted(read_runs(spark, path).collect(), key=lambda r: len(r.metrics))
    assert [r.metrics for r in rows] == [{}, {"score_global": 0.8}]
    assert rows[0].params == {"top_k": "6"} and rows[0].tags["commit"] == "abc" and rows[0].artifact == "a.csv"
    gate = spark.createDataFrame([(0.625, 0.4375, True)], "faithfulness double, answer_relevancy double, passed boolean")
    write_report(evaluation_report(gate, 2.5), str(tmp_path / "report"))
    [text] = [p.read_text() for p in (tmp_path / "report").glob("part-*.json") if p.stat().st_size]
    assert json.loads(text) == {"faithfulness": 0.625, "answer_relevancy": 0.4375, "execution_time": 2.5, "status": "completed"}
    assert re.match(r"\{", text) and gate.select(F.col("passed")).head()[0]
