import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from askloom.functions import batches
from askloom.operators.embedding import embed, embed_text, nonzero, token_buckets
from askloom.functions.text import tokens


def test_python_model_equals_column_expression(spark):
    rows = [(1, "Hello, hello WORLD"), (2, "l'été 2x_3 —"), (3, "Ünïcode ß 中文 42")]
    df = spark.createDataFrame(rows, "id int, text string")
    counts = embed(df, normalize=False)
    model = {(r.id, r.bucket): r.weight for r in nonzero(counts, "id").collect()}
    # Unit vectors come back to counts through the smallest component.
    expression = df.select("id", F.explode(token_buckets("text")).alias("bucket")).groupBy("id", "bucket").count()
    assert {(r.id, r.bucket): float(r["count"]) for r in expression.collect()} == model
    assert df.select(F.size(tokens("text")).alias("n")).agg(F.sum("n")).head()[0] == sum(model.values())


def test_null_and_zero_vectors(spark):
    df = spark.createDataFrame([(1, None), (2, ""), (3, "?!"), (4, "word")], "id int, text string")
    got = {r.id: r.embedding for r in embed(df).collect()}
    assert got[1] is None and got[2] is None and got[3] is None
    assert len(got[4]) == 384 and sum(x * x for x in got[4]) == pytest.approx(1)


def test_pluggable_model(spark):
    def factory():
        return lambda texts: np.array([[len(t), 1.0] for t in texts])

    df = spark.createDataFrame([("abc",), (None,), ("abcd",)], "text string")
    plain = [r.v for r in df.select(embed_text("text", factory, normalize=False).alias("v")).collect()]
    assert plain == [[3.0, 1.0], None, [4.0, 1.0]]
    unit = [r.v for r in df.select(embed_text("text", factory).alias("v")).collect()]
    assert unit[0] == pytest.approx([3 / 10 ** 0.5, 1 / 10 ** 0.5])


def test_model_runs_once_per_row(spark):
    plan = nonzero(embed(spark.createDataFrame([("a",)], "text string")), "text")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("ArrowEvalPython [") == 1


def test_texts_are_taken_in_parts(monkeypatch):
    """What a task holds as Python objects does not grow with the batch; nothing is lost at the borders."""
    texts = pa.array(["ab", None, "x" * 30, "", "c" * 9, "d", "e", None])
    for rows, size in ((1, 100), (3, 100), (100, 10), (100, 100)):
        monkeypatch.setattr(batches, "PART_ROWS", rows)
        monkeypatch.setattr(batches, "PART_BYTES", size)
        parts = list(batches.parts_of(texts))
        assert pa.concat_arrays(parts).equals(texts) and all(len(p) <= rows for p in parts)
        assert all(len(p) == 1 or sum(len(t or "") for t in p.to_pylist()) <= size for p in parts)
    assert len(list(batches.parts_of(texts.slice(0, 0)))) == 1


def test_model_is_called_with_bounded_parts(spark):
    def load():
        def model(some):
            assert len(some) <= batches.PART_ROWS and sum(map(len, some)) <= batches.PART_BYTES
            return np.ones((len(some), 2))

        return model

    docs = spark.range(0, 3000, 1, 1).select("id", F.repeat(F.lit("word "), 200).alias("text"))
    got = embed(docs, load).where("size(embedding) = 2").agg(F.count("*"), F.countDistinct("id")).head()
    assert tuple(got) == (3000, 3000)
