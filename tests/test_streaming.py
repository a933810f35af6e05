import os

import pytest

from askloom.config import Settings
from askloom.plans.ingest import errors_of, ingest_folder, read_errors
from askloom.sources.index import append_index, read_index
from askloom.streaming.incremental import ingest_new_files


def rows(df):
    return sorted((r.source, r.page or -1, r.chunk_no, r.text, tuple(r.embedding)) for r in df.collect())


def test_two_runs_equal_one_full_run(spark, tmp_path):
    docs = tmp_path / "documents"
    docs.mkdir()
    settings = Settings(docs_folder=str(docs), index_path=str(tmp_path / "stream"))
    checkpoint = str(tmp_path / "checkpoint")

    def write(name):
        (docs / name).write_text(f"{name} has words. " * 90)

    write("a.txt"), write("b.txt")
    (docs / "skip.jpg").write_bytes(b"x")
    ingest_new_files(spark, checkpoint, settings)
    first = read_index(spark, settings.index_path).count()
    ingest_new_files(spark, checkpoint, settings)
    assert read_index(spark, settings.index_path).count() == first
    write("c.txt")
    ingest_new_files(spark, checkpoint, settings)

    whole = Settings(docs_folder=str(docs), index_path=str(tmp_path / "whole"))
    ingest_folder(spark, whole)
    assert rows(read_index(spark, settings.index_path)) == rows(read_index(spark, whole.index_path))
    loads = {r.load_id for r in read_index(spark, settings.index_path).select("load_id").distinct().collect()}
    assert len(loads) == 2

    # Batch appends and streamed loads live side by side.
    append_index(read_index(spark, whole.index_path).drop("row_id", "session_id", "load_id"), settings.index_path)
    assert read_index(spark, settings.index_path).count() == 2 * read_index(spark, whole.index_path).count()


def test_streams_keep_each_others_rows(spark, tmp_path):
    index = str(tmp_path / "index")
    for name in ("a [1]", "b"):
        docs = tmp_path / name
        docs.mkdir()
        (docs / "x.txt").write_text(f"{name} has words. " * 20)
        settings = Settings(docs_folder=f"{docs}/", index_path=index)
        ingest_new_files(spark, str(tmp_path / f"checkpoint {name}"), settings)
        ingest_new_files(spark, str(tmp_path / f"checkpoint {name}"), settings)
    found = read_index(spark, index).collect()
    assert sorted(r.text.split(" has")[0] for r in found) == ["a [1]", "b"]
    assert len({r.load_id for r in found}) == 2


def test_folders_inside_the_folder(spark, tmp_path):
    """The stream reads what batch reads: direct files, beside folders that look like partitions."""
    docs = tmp_path / "documents"
    for inner in ("sub/k=2", "k=1", "k=2"):
        (docs / inner).mkdir(parents=True)
        (docs / inner / "inner.txt").write_text("not direct")
    (docs / "a.txt").write_text("direct one")
    (docs / "B.TXT").write_text("direct two")
    settings = Settings(docs_folder=str(docs), index_path=str(tmp_path / "stream"))
    whole = Settings(docs_folder=str(docs), index_path=str(tmp_path / "whole"))
    for name in (None, "late.txt"):
        if name:
            (docs / name).write_text("came later")
        ingest_new_files(spark, str(tmp_path / "checkpoint"), settings)
        ingest_folder(spark, whole)
        assert rows(read_index(spark, settings.index_path)) == rows(read_index(spark, whole.index_path))
    assert {r.text for r in read_index(spark, settings.index_path).collect()} == {"direct one", "direct two", "came later"}


def failures(spark, path):
    return sorted((r.source.rsplit("/", 1)[1], r.error) for r in read_errors(spark, path).collect())


def test_unreadable_files_are_error_rows(spark, tmp_path):
    docs = tmp_path / "documents"
    docs.mkdir()
    (docs / "good.txt").write_text("fine")
    (docs / "bad.txt").write_bytes(b"\xc3\x28")
    (docs / "large.txt").write_text("x" * 3000)
    (docs / "broken.docx").write_bytes(b"no zip")
    settings = Settings(docs_folder=str(docs), index_path=str(tmp_path / "stream"))
    spark.conf.set("spark.sql.sources.binaryFile.maxLength", "2000")
    try:
        ingest_new_files(spark, str(tmp_path / "checkpoint"), settings)
        (docs / "more.txt").write_bytes(b"\xff")
        ingest_new_files(spark, str(tmp_path / "checkpoint"), settings)
        ingest_new_files(spark, str(tmp_path / "checkpoint"), settings)
        whole = Settings(docs_folder=str(docs), index_path=str(tmp_path / "whole"))
        assert ingest_folder(spark, whole, errors_path=str(tmp_path / "failures"))
    finally:
        spark.conf.unset("spark.sql.sources.binaryFile.maxLength")
    assert [r.text for r in read_index(spark, settings.index_path).collect()] == ["fine"]
    found = failures(spark, errors_of(settings.index_path))
    assert [name for name, _ in found] == ["bad.txt", "broken.docx", "large.txt", "more.txt"]
    assert dict(found)["bad.txt"] == "not valid UTF-8" and dict(found)["large.txt"].startswith("larger than the limit")
    assert found == failures(spark, str(tmp_path / "failures"))
    loads = read_errors(spark, errors_of(settings.index_path)).select("load_id").distinct().count()
    assert loads == 2


def test_repeated_file_batch_replaces_rows_and_errors(spark, tmp_path, monkeypatch):
    """The process ends after both sinks are written and before the batch is committed."""
    from askloom.streaming import incremental

    docs = tmp_path / "documents"
    docs.mkdir()
    (docs / "good.txt").write_text("fine")
    (docs / "bad.txt").write_bytes(b"\xc3\x28")
    settings = Settings(docs_folder=str(docs), index_path=str(tmp_path / "stream"))
    kept, whole = [], incremental.index_parsed

    def fails_once(*sinks):
        kept.append(whole(*sinks))
        if len(kept) == 1:
            raise RuntimeError("lost")
        return kept[-1]

    monkeypatch.setattr(incremental, "index_parsed", fails_once)
    with pytest.raises(Exception, match="lost"):
        ingest_new_files(spark, str(tmp_path / "checkpoint"), settings)
    ingest_new_files(spark, str(tmp_path / "checkpoint"), settings)
    assert len(kept) == 2 and kept[0] == kept[1]
    assert read_index(spark, settings.index_path).count() == 1
    assert failures(spark, errors_of(settings.index_path)) == [("bad.txt", "not valid UTF-8")]


def test_repeated_batch_replaces_itself(spark, tmp_path):
    from askloom.streaming.incremental import load_name

    rows_ = spark.range(5).selectExpr("cast(id as string) AS source", "0 AS page", "0 AS chunk_no", "'t' AS text")
    for _ in range(2):
        load = append_index(rows_, str(tmp_path / "index"), load_id=load_name("q", 0))
        assert load == ("stream-q-0", 5)
    from askloom import schemas

    assert read_index(spark, str(tmp_path / "index"), schema=schemas.INDEX).count() == 5


def test_names_of_files_go_through_a_table(spark, tmp_path):
    """The stream's own log has a file a batch, however many files arrive; oldest files come first."""
    docs, checkpoint = tmp_path / "documents", tmp_path / "checkpoint"
    (docs / "sub").mkdir(parents=True)
    (docs / "sub" / "inner.txt").write_text("not direct")
    settings = Settings(docs_folder=str(docs), index_path=str(tmp_path / "stream"))
    ingest_new_files(spark, str(checkpoint), settings)  # nothing yet
    for k in range(5):
        (docs / f"{k}.txt").write_text(f"text {k}")
        os.utime(docs / f"{k}.txt", (1e9 - k, 1e9 - k))
    for _ in range(2):
        ingest_new_files(spark, str(checkpoint), settings, files_per_batch=2)
        by_load = {}
        for r in read_index(spark, settings.index_path).collect():
            by_load.setdefault(r.load_id.rsplit("-", 1)[1], set()).add(r.text)
        assert by_load == {"0": {"text 4", "text 3"}, "1": {"text 2", "text 1"}, "2": {"text 0"}}
    log = "".join(p.read_text() for p in (checkpoint / "sources" / "0").iterdir() if not p.name.startswith("."))
    assert log.count('"path"') == 3 and ".txt" not in log


def test_a_checkpoint_of_a_file_stream_goes_on(spark, tmp_path):
    from askloom.streaming.incremental import arriving_files, process_arrivals

    docs, checkpoint = tmp_path / "documents", str(tmp_path / "checkpoint")
    docs.mkdir()
    settings = Settings(docs_folder=str(docs), index_path=str(tmp_path / "stream"))
    (docs / "early.txt").write_text("came early")
    seen = []
    process_arrivals(arriving_files(spark, str(docs)), lambda batch, load: seen.extend(r.path for r in batch.collect()), checkpoint)
    assert len(seen) == 1
    (docs / "late.txt").write_text("came later")
    for _ in range(2):
        ingest_new_files(spark, checkpoint, settings)
        assert [r.text for r in read_index(spark, settings.index_path).collect()] == ["came later"]
