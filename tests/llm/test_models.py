"""Quality ranking, toxicity and embedding links: held-out accuracy and brute force."""

import collections
import tracemalloc

import numpy as np
import pytest
from pyspark.sql import functions as F

from askloom.llm import grid_order, quality, toxicity
from askloom.llm.frames import fold, read
from askloom.llm.grid_order import link_vectors
from askloom.llm.quality import FEATURES, fit_ranking, score_quality, train_quality
from askloom.llm.queries import QUERIES
from askloom.llm.toxicity import score_toxicity, train_toxicity

FOLDER = "/root/testdata/sf0.1"


def test_fold(spark):
    import zlib

    got = spark.range(50).select("id", fold("id", 7).alias("f")).collect()
    assert all(r["f"] == zlib.crc32(str(r["id"]).encode()) % 7 for r in got)


@pytest.mark.parametrize("name, label, least", [("op7_quality_ranking", "quality", .98), ("op8_toxic_sentences", "toxic", .95)])
def test_held_out_accuracy(spark, name, label, least):
    got = QUERIES[name](spark, FOLDER)
    assert got.count() == read(spark, FOLDER, "documents").count()
    assert got.where("(score >= 0.7) <> (predicted = 1) OR score < 0 OR score > 1 OR score IS NULL").count() == 0
    right, n = got.where("held_out").join(read(spark, FOLDER, "labels"), "doc_id").agg(
        F.avg((F.col("predicted") == F.col(label)).cast("double")), F.count("*")).head()
    assert n > 500 and right >= least


ODD = [(None, "text here."), (1, None), (2, ""), (3, " \n\t"), (4, "?!"), (5, "a. b! c"), (5, "a. b! c"), (6, "word " * 30000)]


def odd(spark):
    return spark.createDataFrame(ODD, "doc_id long, text string").withColumn("label", F.lit("clash")).withColumn("score", F.lit(1))


def test_quality_odd_rows(spark):
    docs = odd(spark)
    none = spark.createDataFrame([], "doc_id long, label int")
    for labels in (none, spark.createDataFrame([(5, 1), (5, 0), (4, 0), (None, 1), (6, 7), (2, None)], "doc_id long, label int")):
        got = score_quality(docs, train_quality(docs, labels)).collect()
        assert len(got) == len(ODD) and all(0 <= r["score"] <= 1 for r in got)
    assert score_quality(docs.limit(0), train_quality(docs.limit(0), none)).count() == 0


def test_toxicity_fit_is_bounded(spark, monkeypatch):
    """The fit holds a few bytes a feature, and the model is the same whatever it looks at together."""
    rng = np.random.default_rng(2)
    stems = ["".join(rng.choice(list("abcdefghijklmnop"), 9)) for _ in range(300)]
    rows = [(i, ". ".join(" ".join(rng.choice(stems[100 * (i % 2):100 * (i % 2) + 200], 80)) for _ in range(30)) + ".", i % 2)
            for i in range(24)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, label int").repartition(2).localCheckpoint()
    fit, peaks, found = toxicity.fit, [], []

    def measured(known, bags):
        tracemalloc.start()
        model = fit(known, bags)
        peaks.append(tracemalloc.get_traced_memory()[1] / len(bags.feature))
        tracemalloc.stop()
        return model

    monkeypatch.setattr(toxicity, "fit", measured)
    monkeypatch.setattr(toxicity, "ROUNDS", 4)
    for at_once in (1, 1 << 12, 1 << 30):
        monkeypatch.setattr(toxicity, "AT_ONCE", at_once, raising=False)
        found.append(train_toxicity(docs.select("doc_id", "text"), docs.select("doc_id", "label")))
    assert peaks[1] < 12
    assert all((m.weights == found[0].weights).all() and (m.base, m.cut) == (found[0].base, found[0].cut) for m in found)
    assert found[0].weights.any()


def test_ranking_orders_pairs():
    rng = np.random.default_rng(1)
    features = rng.normal(size=(600, len(FEATURES)))
    labels = (features[:, 3] - features[:, 7] > 0.5).astype(int)
    model = fit_ranking(features, labels)
    assert ((model.score(features) >= .7) == labels).mean() > .95


def test_every_labelled_row_counts(spark, monkeypatch):
    """More rows than one block or a bounded sample holds; the cut is that of all of them, whichever label is scarce."""
    rng = np.random.default_rng(2)
    names = np.array(["ab", "abc", "abcdefg", "A1", "x?", "abcdefghijklmno", "Zed"])
    rows = [(i, " ".join(rng.choice(names, rng.integers(3, 30))) + "z" * int(rng.integers(1, 40)), int(rng.random() < .3)) for i in range(20_500)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, label int").repartition(4)
    for labels in (docs, docs.select("doc_id", (F.col("doc_id") % 5000 == 0).cast("int").alias("label"))):
        good = labels.where("label = 1").count()
        model = train_quality(docs, labels)
        with monkeypatch.context() as m:
            m.setattr(quality, "BROADCAST_LABELS", 0)
            again = train_quality(docs.repartition(3), labels)
        assert abs(score_quality(docs, model).where("predicted = 1").count() - good) <= 3
        assert np.allclose(model.weights, again.weights) and model.cut == pytest.approx(again.cut)


def test_toxic_sentence_is_found(spark):
    rows = [(i, f"Plain words here {i}. " * 3 + ("You zorgle fool. " if i % 3 == 0 else "You dear friend. ") + "More text é.") for i in range(90)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = docs.select("doc_id", (F.col("doc_id") % 3 == 0).cast("int").alias("label"))
    model = train_toxicity(docs, labels)
    for r in score_toxicity(docs, model).collect():
        text = dict(rows)[r["doc_id"]].encode()
        assert r["predicted"] == (r["doc_id"] % 3 == 0)
        if r["predicted"]:
            assert text[r["worst_start"]:r["worst_end"]] == b"You zorgle fool."
    more = score_toxicity(odd(spark), model).collect()
    assert len(more) == len(ODD)
    assert all((r["n_sentences"] == 0) == (r["worst_start"] is None) for r in more)
    assert [r["n_sentences"] for r in more if r["doc_id"] in (1, 2, 3)] == [0, 0, 0]
    none = spark.createDataFrame([], "doc_id long, label int")
    assert {r["predicted"] for r in score_toxicity(docs, train_toxicity(docs, none)).collect()} == {0}
    assert score_toxicity(docs.limit(0), model).count() == 0


# -- embeddings


def plain_links(rows, least=.98):
    usable = {}
    for i, (key, vec, label) in enumerate(rows):
        if key is not None and label is not None and vec and all(x is not None and np.isfinite(np.float32(x)) for x in vec) and any(vec):
            v = np.array(vec, np.float32).astype(float)
            usable[i] = (label, v / np.sqrt(v @ v))
    near = collections.defaultdict(set)
    for i, (li, vi) in usable.items():
        for j, (lj, vj) in usable.items():
            if i < j and li == lj and len(vi) == len(vj) and vi @ vj >= least:
                near[i].add(j)
                near[j].add(i)
    out = []
    for i, (key, _, _) in enumerate(rows):
        seen, todo = {i}, [i]
        while todo:
            for j in near[todo.pop()] - seen:
                seen.add(j)
                todo.append(j)
        c = min((rows[j][0] for j in seen), default=None) if key is not None else None
        out.append((key, len(near[i]), c, None if key is None else key == c))
    return sorted(out, key=str)


def test_links_of_the_tables(spark):
    table = read(spark, "/root/testdata/sf0.01", "embeddings")
    rows = [(r["vec_id"], r["embedding"], r["label"]) for r in table.collect()]
    got = sorted(map(tuple, link_vectors(table).collect()), key=str)
    assert got == plain_links(rows)


@pytest.mark.parametrize("interval, leaf", [(16, 4), (2048, 128)])
def test_links_equal_brute_force(spark, monkeypatch, interval, leaf):
    monkeypatch.setattr(grid_order, "INTERVAL", interval)
    monkeypatch.setattr(grid_order, "LEAF", leaf)
    rng = np.random.default_rng(4)
    base = rng.normal(size=(25, 6))
    vectors = np.repeat(base, 9, 0) + rng.normal(size=(225, 6)) * rng.choice([0, .05, .15, .4], (225, 1))
    rows = [(int(i), [float(x) for x in np.float32(v)], int(rng.integers(0, 2))) for i, v in enumerate(vectors)]
    rows += [(300, None, 1), (301, [0.0] * 6, 1), (302, [1.0, None, 0.0, 0.0, 0.0, 0.0], 1), (303, [float("nan")] * 6, 1),
             (304, [float("inf")] * 6, 0), (305, rows[0][1], None), (None, rows[0][1], 1), (306, [], 1), (307, [1.0, 2.0], 1),
             (308, [2.0, 4.0], 1), (0, rows[0][1], rows[0][2]), (309, [1e30] * 6, 1), (310, [1e-30] * 6, 1)]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int").withColumn("node", F.lit("clash"))
    assert sorted(map(tuple, link_vectors(table.repartition(3)).collect()), key=str) == plain_links(rows)
    assert link_vectors(table.limit(0)).count() == 0


def test_doubles_are_not_rounded(spark):
    """Components beyond the range of floats, and pairs a hair's breadth on either side of the least cosine."""
    def pair(cosine, scale):
        return [scale, 0.0, 0.0], [scale * cosine, scale * (1 - cosine * cosine) ** .5, 0.0]

    rows = []
    for k, (cosine, scale) in enumerate(((.98 + 1e-10, 1.0), (.98 - 1e-10, 1.0), (.98 + 1e-10, 1e200), (.98 - 1e-10, 1e-200), (1 - 1e-12, 1e39))):
        rows += [(10 * k + n, v, k) for n, v in enumerate(pair(cosine, scale))]
    rows += [(90, [1e39, 1e39, 0.0], 9), (91, [1e39, 1e39, 0.0], 9), (92, [1e308, 1e308, 1e308], 9), (93, [float("inf"), 1.0, 1.0], 9)]
    found = link_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")).collect()
    got = {r["vec_id"]: (r["n_links"], r["component_id"]) for r in found}
    assert got == {0: (1, 0), 1: (1, 0), 10: (0, 10), 11: (0, 11), 20: (1, 20), 21: (1, 20), 30: (0, 30), 31: (0, 31),
                   40: (1, 40), 41: (1, 40), 90: (1, 90), 91: (1, 90), 92: (0, 92), 93: (0, 93)}
