"""The pipeline's stages, each against plain Python on its own input."""

import re

from pyspark.sql import functions as F
from test_native import named, plain_spans
from test_shingles import plain_components, plain_pairs

import corpus_pipeline
from askloom.llm.frames import read, written

FOLDER = "/root/testdata/sf0.001"
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def rows(frame):
    return {r["doc_id"]: r for r in frame.collect()}


def test_stages(spark):
    docs = read(spark, FOLDER, "documents")
    kept = {}
    for name, stage in corpus_pipeline.STAGES:
        before = docs
        docs = written(stage(spark, docs, FOLDER), name)
        kept[name] = (rows(before), rows(docs))
        if name != corpus_pipeline.STAGES[-1][0]:
            assert docs.columns == COLUMNS and docs.schema.simpleString() == before.schema.simpleString()
    before, after = kept["toxicity"]
    toxic = {r["doc_id"] for r in read(spark, FOLDER, "labels").where("toxic = 1").collect()}
    clean = {r["doc_id"] for r in read(spark, FOLDER, "labels").where("toxic = 0").collect()}
    assert len(clean & set(after)) >= .97 * len(clean & set(before)) and len(toxic & set(after)) < len(toxic)
    before, after = kept["ngram_jaccard_join"]
    want = plain_components({i: r["text"] for i, r in before.items()})
    assert set(after) == {i for i, (_, c) in want.items() if i == c} and len(after) < len(before)
    before, after = kept["benchmark_decontamination"]
    items = {r["item_id"]: r["text"] for r in read(spark, FOLDER, "benchmark").collect()}
    bad = {p[0] for p in plain_pairs({i: r["text"] for i, r in before.items()}, items)}
    assert set(after) == set(before) - bad and bad
    before, after = kept["secret_scans"]
    assert set(after) == set(before)
    changed = {i for i in before if before[i]["text"] != after[i]["text"]}
    assert changed >= {i for i in before if plain_spans(before[i]["text"])} and changed
    assert all(after[i]["n_chars"] == len(after[i]["text"]) and "[secret]" in after[i]["text"] for i in changed)
    assert not any(named(plain_spans(after[i]["text"])) for i in after)
    before, after = kept["source_mixing"]
    assert set(after) <= set(before) and all(1 <= r["copies"] <= 3 for r in after.values())
    assert all(r["taken"] == r["copies"] * len(re.findall(r"[^\x20\x09-\x0D]+", before[i]["text"])) for i, r in after.items())


def test_run_and_registration(spark):
    import __spark_entry__

    assert __spark_entry__.queries()["pipeline"](spark, FOLDER).count() > 0
    assert "pipeline" not in __spark_entry__.oracle_sql()


def test_extra_columns_keep_their_values(spark):
    """Whatever names the operators use inside, the table's own columns come out as they went in."""
    names = ["_id", "_hash", "_spans", "_gone", "_text", "_row", "row", "key", "id", "hash", "spans", "clean", "gone", "base", "x"]
    near = " ".join(f"w{k}" for k in range(60))
    for repeated in (False, True):
        data = [(1, near, "s"), (2, near + " x", "s"), (3, "password=abcdefghijklmnop", "t"), (3 if repeated else 4, "other", None)]
        docs = spark.createDataFrame(data, "doc_id long, text string, source string")
        docs = docs.withColumn("lang", F.lit("en")).withColumn("n_chars", F.length("text").cast("long"))
        docs = docs.withColumns({c: F.concat(F.lit(f"{c} of "), "text") for c in names})
        for stage, left in ((corpus_pipeline.one_of_near_copies, 3), (corpus_pipeline.without_secrets, 4),
                            (corpus_pipeline.without_benchmark, 4), (corpus_pipeline.clean_of_toxicity, 4)):
            out = stage(spark, docs, FOLDER)
            assert out.columns == docs.columns
            got = out.collect()
            before = {r["x"]: r for r in docs.collect()}
            assert len(got) == left and all(r[c] == before[r["x"]][c] for r in got for c in names)


def test_odd_rows_through_all_stages(spark):
    near = " ".join(f"w{k}" for k in range(60))
    data = [(None, near, "en", "s", 9), (1, near, "en", "s", 9), (1, near, "en", "s", 9), (1, "other words " * 9, None, "s", 9), (2, near + " x", "en", None, 9),
            (3, None, "en", "s", 0), (4, "", None, None, None), (5, "password=abcdefghijklmnop é", "fr", "t", 26), (None, None, None, None, None)]
    docs = spark.createDataFrame(data, "doc_id long, text string, lang string, source string, n_chars long").withColumn("node", F.lit("clash"))
    out = docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = written(stage(spark, out, FOLDER), name)
        assert out.columns == docs.columns
        assert stage(spark, docs.limit(0), FOLDER).count() == 0
    got = sorted(((r["doc_id"], r["text"]) for r in out.collect()), key=str)
    assert got == sorted([(None, near), (1, near), (1, "other words " * 9), (3, None), (4, ""), (5, "[secret] é"), (None, None)], key=str)
    assert corpus_pipeline.STAGES[-1][1](spark, docs.limit(0), FOLDER).count() == 0
