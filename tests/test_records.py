import csv
import json
import random
from contextlib import contextmanager

import pytest
from pyspark.sql import functions as F

from askloom import schemas
from askloom.sources.questions import read_questions, write_questions
from askloom.sources.records import _pieces, csv_records, json_records
from askloom.sources.results import read_results, write_results

SIGNS = ['"', "\\", "{", "}", "[", "]", ",", "\n", "\r\n", " ", "é", "😀", "a", '\\"', "}\n{"]


@contextmanager
def splits_of(spark, size):
    keys = {"spark.sql.files.maxPartitionBytes": str(size), "spark.sql.files.openCostInBytes": "0"}
    before = {k: spark.conf.get(k) for k in keys}
    for k, v in keys.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def text(rng):
    return "".join(rng.choice(SIGNS) for _ in range(rng.randrange(12)))


@pytest.mark.parametrize("size", [7, 64, 1000])
@pytest.mark.parametrize("indent", [None, 2])
def test_json_array_of_any_layout_in_splits_of_any_size(spark, tmp_path, size, indent):
    rng = random.Random(size)
    data = [{"question": text(rng), "ground_truth": text(rng), "more": [{"x": {"y": text(rng)}}, {}]} for _ in range(size // 10 + 8)]
    (tmp_path / "set.json").write_text(json.dumps(data, indent=indent, ensure_ascii=size == 64), encoding="utf-8")
    with splits_of(spark, size):
        rows = json_records(spark, str(tmp_path)).orderBy("_record").collect()
        assert [json.loads(r.record) for r in rows] == data
        got = [tuple(r) for r in read_questions(spark, str(tmp_path / "set.json")).orderBy("question_id").collect()]
    assert got == [(i + 1, d["question"], d["ground_truth"]) for i, d in enumerate(data)]


@pytest.mark.parametrize("size", [7, 64, 1000])
def test_csv_with_line_breaks_in_splits_of_any_size(spark, tmp_path, size):
    rng = random.Random(size)
    data = [[text(rng), text(rng)] for _ in range(size // 10 + 8)]
    with open(tmp_path / "a.csv", "w", encoding="utf-8", newline="") as out:
        csv.writer(out, lineterminator="\n", quoting=csv.QUOTE_ALL).writerows([["x", "y"], *data])
    with splits_of(spark, size):
        rows = csv_records(spark, str(tmp_path)).orderBy("_record").collect()
    assert [next(csv.reader([r.record], strict=True)) if "\n" not in r.record and "\r" not in r.record
            else next(csv.reader(r.record.splitlines(keepends=True))) for r in rows] == [["x", "y"], *data]


def test_one_file_is_read_by_many_tasks(spark, tmp_path):
    data = [{"question": f"q{i}", "ground_truth": "}"} for i in range(500)]
    (tmp_path / "set.json").write_text(json.dumps(data))
    with splits_of(spark, 2000):
        pieces = _pieces(spark, str(tmp_path), "}")
        per_task = [r["count"] for r in pieces.groupBy(F.spark_partition_id()).count().collect()]
        assert len(per_task) > 5 and max(per_task) < 300
        assert json_records(spark, str(tmp_path)).count() == 500


def test_results_and_questions_round_trip_over_splits(spark, tmp_path):
    rng = random.Random(3)
    rows = [tuple(rng.choice([None, text(rng)]) for _ in range(4)) for _ in range(60)]
    rows = [r for r in rows if any(v is not None for v in r)]
    write_results(spark.createDataFrame(rows, schemas.RESULTS).repartition(3), str(tmp_path / "csv"))
    asked = [r[:2] for r in rows]
    write_questions(spark.createDataFrame(asked, schemas.QUESTIONS).repartition(3), str(tmp_path / "json"))
    for file in (tmp_path / "json").glob("part-*"):
        assert isinstance(json.loads(file.read_text(encoding="utf-8")), list)
    with splits_of(spark, 400):
        got = read_results(spark, str(tmp_path / "csv")).collect()
        read = read_questions(spark, str(tmp_path / "json")).collect()
    assert sorted(map(repr, map(tuple, got))) == sorted(map(repr, rows))
    assert sorted(repr((r.question, r.ground_truth)) for r in read) == sorted(map(repr, asked))
    assert sorted(r.question_id for r in read) == list(range(1, len(rows) + 1))


def test_edges(spark, tmp_path):
    def questions(name, content):
        (tmp_path / name).write_text(content, encoding="utf-8")
        return [tuple(r)[1:] for r in read_questions(spark, str(tmp_path / name)).orderBy("question_id").collect()]

    assert questions("empty.json", "") == questions("none.json", "[]") == questions("blank.json", " [ \n ] \n") == []
    assert questions("one.json", '{"question": "a"}') == [("a", None)]
    assert questions("bom.json", '\ufeff[{"question": "a", "ground_truth": "b"}]') == [("a", "b")]
    assert questions("marks.json", '[{"question": "a}\\ufeffb", "ground_truth": "}\ufeff"}]') == [("a}\ufeffb", "}\ufeff")]
    (tmp_path / "marks.csv").write_text('\ufeffx,y\n"a\n\ufeffb",c\n', encoding="utf-8")
    assert [r.record for r in csv_records(spark, str(tmp_path / "marks.csv")).orderBy("_record").collect()] == ["x,y", '"a\n\ufeffb",c']
    assert questions("odd.json", '[{"question": "a"}, null, 5, {"question": {"b": 1}}, {"ground_truth": "c"}]') == [
        ("a", None), ('{"b":1}', None), (None, "c")]
    assert questions("broken.json", '[{"question": "a"}, {"question": b}]') == [("a", None), (None, None)]
    assert questions("lines.json", '{"question": "a"}\n{"question": "b"}\n') == [("a", None), ("b", None)]
    write_questions(spark.createDataFrame([], schemas.QUESTIONS), str(tmp_path / "nothing"))
    assert read_questions(spark, str(tmp_path / "nothing")).count() == 0
    with pytest.raises(FileNotFoundError):
        read_results(spark, str(tmp_path / "absent"))
