import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from askloom.operators import retrieval
from askloom.operators.retrieval import (
    best_hit, hydrate, index_key, off_topic_gate, retrieve, score_pairs, top_k,
)

SCHEMA_Q, SCHEMA_I = "question_id string, embedding array<float>", "source string, page int, chunk_no int, embedding array<float>"


def cosine6(a, b):
    import math
    na, nb = math.sqrt(sum(x * x for x in a)), math.sqrt(sum(x * x for x in b))
    return math.floor(sum(x * y for x, y in zip(a, b)) / (na * nb) * 1e6 + 0.5) / 1e6


def brute(questions, index, k):
    out = set()
    for q, v in questions:
        if not v or not any(v):
            continue
        ranked = sorted(((-cosine6(v, w), s, -1 if p is None else p, c) for s, p, c, w in index if w and any(w)))
        out |= {(q, s, None if p == -1 else p, c, -m, r) for r, (m, s, p, c) in enumerate(ranked[:k], 1)}
    return out


def rows(df):
    return {(r.question_id, r.source, r.page, r.chunk_no, r.score, r["rank"]) for r in df.collect()}


@pytest.fixture(scope="module")
def data():
    rng = random.Random(3)
    # Few distinct values: many exact ties, a third of the rows are copies of one vector.
    vector = lambda: [float(rng.randint(-1, 2)) for _ in range(5)]
    index = [(f"s{i % 4}", None if i % 3 == 0 else i % 5, i, [1.0, 1.0, 0.0, 0.0, 1.0] if i % 3 == 0 else vector()) for i in range(400)]
    index += [("s9", 0, 0, None), ("s9", 0, 1, [0.0] * 5)]
    index = [r for r in index if r[3] is None or any(r[3]) or r[0] == "s9"]
    questions = [(f"q{i}", vector()) for i in range(23)] + [("none", None)]
    questions = [q for q in questions if q[1] is None or any(q[1])]
    return questions, index


@pytest.mark.parametrize("k", [1, 6, 1000])
@pytest.mark.parametrize("parts", [1, 4, 16])
def test_top_k_equals_brute_force(spark, data, k, parts):
    questions, index = data
    q, i = spark.createDataFrame(questions, SCHEMA_Q), spark.createDataFrame(index, SCHEMA_I).repartition(parts)
    wanted = brute(questions, [r for r in index if r[3] and any(r[3])], k)
    found = rows(top_k(q, i.where("chunk_no <> 1 or source <> 's9'"), k))
    assert found == wanted


@pytest.mark.parametrize("per_block", [3, 1000])
def test_blocks_equal_one_block(spark, data, per_block):
    questions, index = data
    q, i = spark.createDataFrame(questions, SCHEMA_Q), spark.createDataFrame(index, SCHEMA_I)
    blocks = top_k(q, i, 6, questions_per_block=per_block)
    assert rows(blocks) == rows(top_k(q, i, 6)) == rows(top_k(q, i, 6, max_broadcast_bytes=0))


def test_small_batches_give_the_same(spark, data):
    questions, index = data
    q, i = spark.createDataFrame(questions, SCHEMA_Q), spark.createDataFrame(index, SCHEMA_I).coalesce(1)
    whole = rows(top_k(q, i, 6))
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        assert rows(top_k(q, i, 6)) == whole
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_few_cells_are_scored_in_double_precision(monkeypatch):
    """The hits are those of all cells, though most cells can't change them; ties and copies included."""
    rng = np.random.default_rng(5)
    asked, index = rng.poisson(.3, (50, 64)).astype(float), rng.poisson(.6, (6000, 64)).astype(np.float32)
    asked[:, 0] += 1
    index[:, 0] += 1
    index[3000:3300] = index[:300]
    asked /= np.sqrt((asked ** 2).sum(1))[:, None]
    cells, units = [], retrieval._units
    monkeypatch.setattr(retrieval, "_units", lambda scores: cells.append(scores.size) or units(scores))
    best = retrieval.RunningTopK(asked, ["chunk_no"], "embedding", 6)
    order = rng.permutation(6000)
    for at in range(0, 6000, 100):
        rows = order[at:at + 100]
        best.add(pa.table({"chunk_no": rows, "embedding": list(index[rows])}))
    got = best.result(pa.schema([("_q", pa.int32()), ("chunk_no", pa.int64()), ("score", pa.float64())])).to_pylist()
    exact = index.astype(float)
    exact = np.floor(asked @ (exact / np.sqrt((exact ** 2).sum(1))[:, None]).T * 1e6 + .5) / 1e6
    assert {(r["_q"], r["chunk_no"], r["score"]) for r in got} == {
        (q, c, exact[q, c]) for q in range(50) for c in sorted(range(6000), key=lambda c: (-exact[q, c], c))[:6]}
    assert sum(cells) < 50 * 6000 / 10


def test_empty_sides(spark):
    none = spark.createDataFrame([], SCHEMA_Q)
    index = spark.createDataFrame([("s", 1, 0, [1.0, 0.0])], SCHEMA_I)
    asked = spark.createDataFrame([("q", [1.0, 0.0])], SCHEMA_Q)
    assert top_k(none, index).count() == 0
    assert top_k(asked, index.limit(0)).count() == 0
    assert top_k(asked, index.limit(0), questions_per_block=1).count() == 0
    assert index_key(index) == ("source", "page", "chunk_no")
    assert rows(top_k(asked, index)) == {("q", "s", 1, 0, 1.0, 1)}


def test_retrieve_gives_text_and_best_hit(spark):
    index = spark.createDataFrame(
        [("s", None, 0, "first", [1.0, 0.0]), ("s", None, 1, "second", [0.0, 1.0])],
        "source string, page int, chunk_no int, text string, embedding array<float>")
    asked = spark.createDataFrame([("q", [1.0, 0.5])], SCHEMA_Q)
    for limit in (2**20, 0):
        found = retrieve(asked, index, k=2, max_broadcast_bytes=limit).orderBy("rank").collect()
        assert [(r.text, r["rank"]) for r in found] == [("first", 1), ("second", 2)]
        assert "embedding" not in found[0].asDict()
    hits = top_k(asked, index, 2)
    assert best_hit(hydrate(hits, index)).head().text == "first"


@pytest.mark.parametrize("text, off", [("x" * 49, True), ("x" * 50, False), ("x" * 51, False), (" " * 60, True)])
def test_off_topic_by_length(spark, text, off):
    questions = spark.createDataFrame([("a",), ("no hit",)], "question_id string")
    hits = spark.createDataFrame([("a", 1, text), ("a", 2, "y" * 99)], "question_id string, rank int, text string")
    got = {r.question_id: r.off_topic for r in off_topic_gate(questions, hits).collect()}
    assert got == {"a": off, "no hit": True}


def test_sql_cosine_agrees_with_kernel(spark, data):
    questions, index = data
    q = spark.createDataFrame(questions, SCHEMA_Q).withColumnRenamed("embedding", "qv")
    i = spark.createDataFrame(index, SCHEMA_I)
    found = top_k(q.withColumnRenamed("qv", "embedding"), i, 3)
    pairs = hydrate(found, i.withColumn("text", F.lit("")).withColumnRenamed("embedding", "iv")).join(q, "question_id")
    scored = score_pairs(pairs.withColumnRenamed("score", "kernel"), "qv", "iv")
    assert scored.where("abs(kernel - score) > 0.0000015 or score is null").count() == 0


def test_repeated_ids_have_hits_of_their_own(spark, data):
    questions, index = data
    q, i = spark.createDataFrame([*questions, *questions], SCHEMA_Q), spark.createDataFrame(index, SCHEMA_I)
    once = top_k(spark.createDataFrame(questions, SCHEMA_Q), i, 3).count()
    for rows_per_block in (4, 1000):
        assert top_k(q, i, 3, questions_per_block=rows_per_block).count() == 2 * once


def test_each_question_is_embedded_once(spark, data, tmp_path):
    from askloom.operators.embedding import embed_text

    log = str(tmp_path)

    def counting():
        import os
        import uuid

        import numpy as np

        def model(texts):
            with open(os.path.join(log, uuid.uuid4().hex), "w") as file:
                file.write("x" * len(texts))
            return np.ones((len(texts), 5))

        return model

    import os

    asked = spark.range(30).select(F.col("id").cast("string").alias("question_id"), F.lit("t").alias("text"))
    asked = asked.withColumn("embedding", embed_text("text", counting))
    index = spark.createDataFrame([r for r in data[1] if r[3] and any(r[3])], SCHEMA_I)
    for n, most in enumerate((2**20, 8 * 5 * 7), 1):
        assert top_k(asked, index, 2, questions_per_block=8, max_broadcast_bytes=most).count() == 60
        assert sum(os.path.getsize(os.path.join(log, f)) for f in os.listdir(log)) == 30 * n


def test_plan_of_questions_runs_once(spark, data):
    """Whatever makes the vectors, as many rows pass it as there are questions."""
    made = spark.sparkContext.accumulator(0)

    def vectors(batches):
        import pyarrow as pa

        for batch in batches:
            made.add(batch.num_rows)
            ids = [str(i) for i in batch.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids), pa.array([[1.0] * 5] * len(ids), pa.list_(pa.float32()))], ["question_id", "embedding"])

    asked = spark.range(40).repartition(5).mapInArrow(vectors, SCHEMA_Q)
    index = spark.createDataFrame([r for r in data[1] if r[3] and any(r[3])], SCHEMA_I)
    for n, most in enumerate((2**20, 8 * 5 * 9), 1):
        assert top_k(asked, index, 2, max_broadcast_bytes=most).count() == 80
        assert made.value == 40 * n


def test_one_portion_at_a_time(spark, data, monkeypatch):
    """A portion's matrices are given up before the next portion's are made."""
    from pyspark import Broadcast

    from askloom.operators import retrieval

    alive, most = [], []
    made, destroy = retrieval._Portion.__init__, Broadcast.destroy

    def counted(self, *args):
        made(self, *args)
        alive.append(self)
        most.append(len(alive))

    def given_up(self, *args, **kwargs):
        alive.pop()
        destroy(self, *args, **kwargs)

    monkeypatch.setattr(retrieval._Portion, "__init__", counted)
    monkeypatch.setattr(Broadcast, "destroy", given_up)
    questions, index = data
    q, i = spark.createDataFrame(questions, SCHEMA_Q), spark.createDataFrame([r for r in index if r[3] and any(r[3])], SCHEMA_I)
    found = top_k(q, i, 6, max_broadcast_bytes=8 * 5 * 4)
    assert max(most) == 1 and len(most) == -(-len(questions) // 4)
    assert rows(found) == brute(questions, [r for r in index if r[3] and any(r[3])], 6)
