import pytest
from pyspark.sql import functions as F

from askloom import schemas
from askloom.sources.index import append_index, load_or_create, read_index, write_index, write_sessions

ROWS = [("s", None, 0, "a", [1.0, 0.0]), ("s", 1, 1, "b", None)]


@pytest.fixture
def chunks(spark):
    return spark.createDataFrame(ROWS, schemas.INDEX)


def stored(df):
    return sorted((r.source, r.page or -1, r.chunk_no, r.text, r.embedding) for r in df.collect())


EXPECTED = sorted((s, p or -1, c, t, e) for s, p, c, t, e in ROWS)


def test_round_trip_and_overwrite(spark, chunks, tmp_path):
    path = str(tmp_path / "deep" / "index")
    write_index(chunks, path)
    append_index(chunks, path)
    write_index(chunks, path)
    assert stored(read_index(spark, path)) == EXPECTED


def test_missing_index(spark, tmp_path):
    with pytest.raises(FileNotFoundError, match="ingest"):
        read_index(spark, str(tmp_path / "none"))


def test_append_adds_repeats_but_a_repeated_load_replaces_itself(spark, chunks, tmp_path):
    path = str(tmp_path / "index")
    write_index(chunks, path)
    append_index(chunks, path)
    append_index(chunks.unionByName(chunks), path)
    assert read_index(spark, path).count() == 8
    for _ in range(2):
        append_index(chunks, path, load_id="x")
    assert read_index(spark, path).count() == 10


def test_load_or_create(spark, chunks, tmp_path):
    path = str(tmp_path / "index")
    assert stored(load_or_create(spark, path, chunks)) == EXPECTED
    assert load_or_create(spark, path, chunks.limit(0)).count() == 2
    assert load_or_create(spark, path, chunks, session="other").count() == 2


def test_sessions_are_separate_and_pruned(spark, chunks, tmp_path):
    path = str(tmp_path / "index")
    write_index(chunks, path, session="one")
    write_index(chunks.limit(1), path, session="two")
    append_index(chunks, path, session="two")
    assert read_index(spark, path, "one").count() == 2 and read_index(spark, path, "two").count() == 3
    assert read_index(spark, path, session=None).count() == 5
    write_index(chunks.limit(1), path, session="one")
    assert read_index(spark, path, "two").count() == 3
    assert all("session_id=two/" in f for f in read_index(spark, path, "two").inputFiles())
    assert read_index(spark, path, "three").count() == 0


def test_all_sessions_in_one_pass(spark, chunks, tmp_path):
    path = str(tmp_path / "index")
    write_index(chunks, path, session="kept")
    write_index(chunks.unionByName(chunks), path, session="a")
    both = chunks.withColumn("session_id", F.lit("a")).unionByName(chunks.limit(1).withColumn("session_id", F.lit("b")))
    write_sessions(both, path)
    assert [read_index(spark, path, s).count() for s in ("kept", "a", "b")] == [2, 2, 1]
    assert stored(read_index(spark, path, "a")) == EXPECTED


def test_rewritten_sessions_lose_appended_loads(spark, chunks, tmp_path):
    path = str(tmp_path / "index")
    both = chunks.withColumn("session_id", F.lit("one")).unionByName(chunks.withColumn("session_id", F.lit("t/o")))
    write_sessions(both, path)
    load = append_index(chunks, path, session="t/o")
    assert load.n_rows == 2 and read_index(spark, path, "t/o").count() == 4
    append_index(chunks, path, session="kept")
    write_sessions(both, path)
    assert {s: read_index(spark, path, s).count() for s in ("one", "t/o", "kept")} == {"one": 2, "t/o": 2, "kept": 2}


def test_very_many_sessions(spark, tmp_path, monkeypatch):
    """No call for a session of its own, one for each load that goes, and the rows are made once."""
    from askloom.sources import index

    path, made, deleted = str(tmp_path / "index"), spark.sparkContext.accumulator(0), []
    whole = index.delete_path
    monkeypatch.setattr(index, "delete_path", lambda s, load: deleted.append(load) or whole(s, load))
    monkeypatch.setattr(index, "_session_path", None)

    def counted(batches):
        for batch in batches:
            made.add(batch.num_rows)
            yield batch

    rows = spark.range(800).selectExpr("'x' AS source", "0 AS page", "0 AS chunk_no", "'t' AS text", "array(1f) AS embedding",
                                       "concat('s/', id % 400) AS session_id")
    rows = rows.mapInArrow(counted, rows.schema)
    assert write_sessions(rows, path) == 0 and made.value == 800
    assert write_sessions(rows.where("session_id < 's/2'"), path) == len(deleted) == 112
    assert read_index(spark, path, None).count() == 800
    assert read_index(spark, path, None).select("session_id", "load_id").distinct().count() == 400
    assert not any("s%2F2" in load for load in deleted)
