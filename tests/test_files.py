import io
import os
import zipfile

import pytest
from pyspark.sql import functions as F

from askloom import schemas
from askloom.sources.files import (
    concat_documents, folder_files, good_documents, in_order, list_folder, load_documents, load_summary, load_totals,
    parse_docx, parse_files, quarantine, write_texts,
)

W = 'xmlns:w="http://schemas.openxmlformats.org/wordprocessingml/2006/main"'


def docx(*paragraphs, header=None):
    def part(texts):
        body = "".join(f"<w:p><w:r><w:t>{t}</w:t><w:tab/><w:t>end</w:t><w:br/></w:r></w:p>" for t in texts)
        return f"<w:document {W}><w:body>{body}</w:body></w:document>"

    out = io.BytesIO()
    with zipfile.ZipFile(out, "w") as z:
        z.writestr("word/document.xml", part(paragraphs))
        if header:
            z.writestr("word/header1.xml", part([header]))
    return out.getvalue()


def pages(content):
    """Stands for a PDF library."""
    if content == b"broken":
        raise ValueError("not a PDF")
    return list(enumerate(content.decode().split("\f")))


@pytest.fixture
def folder(tmp_path):
    (tmp_path / "b.txt").write_bytes(b"This is test content.\r\nSecond line.\rThird.")
    (tmp_path / "A.TXT").write_text("﻿upper é", encoding="utf-8")
    (tmp_path / "bad.txt").write_bytes(b"\xc3\x28")
    (tmp_path / "c.docx").write_bytes(docx("one", "two", header="top"))
    (tmp_path / "broken.docx").write_bytes(b"no zip")
    (tmp_path / "d.pdf").write_bytes(b"page zero\fpage one")
    (tmp_path / "broken.pdf").write_bytes(b"broken")
    for name in ("test.jpg", "b.txt.bak", "noext"):
        (tmp_path / name).write_bytes(b"x")
    (tmp_path / "sub").mkdir()
    (tmp_path / "sub" / "inner.txt").write_text("not direct")
    (tmp_path / "key=1").mkdir()
    (tmp_path / "key=1" / "inner.txt").write_text("not direct")
    return str(tmp_path)


def test_folder(spark, folder):
    files = folder_files(spark, folder)
    parsed = parse_files(files, {".pdf": pages}).cache()
    rows = [(r.source.rsplit("/", 1)[1], r.page, r.text) for r in in_order(good_documents(parsed)).collect()]
    assert rows == [
        ("A.TXT", None, "﻿upper é"),
        ("b.txt", None, "This is test content.\nSecond line.\nThird."),
        ("c.docx", None, parse_docx(docx("one", "two", header="top"))[0][1]),
        ("d.pdf", 0, "page zero"), ("d.pdf", 1, "page one"),
    ]
    lost = {r.source.rsplit("/", 1)[1]: r.error for r in quarantine(parsed).collect()}
    assert lost.keys() == {"bad.txt", "broken.docx", "broken.pdf"}
    assert lost["bad.txt"] == "not valid UTF-8" and lost["broken.pdf"] == "ValueError: not a PDF"
    assert tuple(load_totals(parsed, files).head()) == (5, 3, 10)
    assert {r.source.rsplit("/", 1)[1]: r.n_sections for r in load_summary(good_documents(parsed)).collect()} == {
        "A.TXT": 1, "b.txt": 1, "c.docx": 1, "d.pdf": 2}


def test_other_files_are_dropped_while_listing(spark, folder):
    names = {r.path.rsplit("/", 1)[1] for r in folder_files(spark, folder, supported_only=True).select("path").collect()}
    assert names == {"A.TXT", "b.txt", "bad.txt", "c.docx", "broken.docx", "d.pdf", "broken.pdf"}


def test_docx_text():
    [(page, text)] = parse_docx(docx("one", "two", header="top"))
    assert page is None and text.split() == ["top", "end", "one", "end", "two", "end"]
    assert "\tend\n" in text and text == text.strip() and "\n\none" in text


def test_missing_library_is_an_error_row(spark, folder):
    lost = quarantine(parse_files(folder_files(spark, folder).where("path like '%d.pdf'"))).collect()
    try:
        import pypdf  # noqa: F401
    except ImportError:
        assert lost[0].error.startswith("missing dependency")


def test_folder_names_with_special_characters(spark, tmp_path):
    for name in ("with space", "é+%20", "a=b"):
        (tmp_path / name).mkdir()
        (tmp_path / name / "x y.txt").write_text("here")
        assert [r.text for r in load_documents(spark, str(tmp_path / name)).collect()] == ["here"]
        assert [r.text for r in load_documents(spark, str(tmp_path / name) + "/").collect()] == ["here"]


@pytest.mark.parametrize("name", ["", "absent"])
def test_empty_and_missing_folder(spark, tmp_path, name):
    docs = load_documents(spark, str(tmp_path / name))
    assert docs.schema == schemas.DOCUMENTS or docs.columns == schemas.DOCUMENTS.names
    assert docs.count() == 0


def test_concat_keeps_repeats(spark):
    df = spark.createDataFrame([("a", 1, "x")], schemas.DOCUMENTS)
    assert concat_documents(df, df, df).count() == 3
    assert concat_documents(df).agg(F.count("*")).head()[0] == 1


def test_too_large_and_nested_files(spark, folder, monkeypatch):
    import os

    nested = os.path.join(folder, "sub", "big.txt")
    open(nested, "w").write("x" * 5000)
    open(os.path.join(folder, "large.txt"), "w").write("x" * 3000)
    spark.conf.set("spark.sql.sources.binaryFile.maxLength", "2000")
    try:
        parsed = parse_files(folder_files(spark, folder, supported_only=True), {".pdf": pages}).collect()
    finally:
        spark.conf.unset("spark.sql.sources.binaryFile.maxLength")
    names = {r.source.rsplit("/", 1)[1]: r.error for r in parsed}
    assert names["large.txt"] == "larger than the limit for binary files"
    assert "big.txt" not in names and names["b.txt"] is None


def test_each_text_is_one_file_and_nothing_else_is_left(spark, tmp_path):
    texts = spark.createDataFrame([("a\r\nb",), ("",), (None,), ("é",), ("a\r\nb",)], "text string").repartition(3)
    write_texts(texts, str(tmp_path))
    write_texts(texts.limit(0), str(tmp_path))
    write_texts(texts, str(tmp_path), as_json=True)
    names = os.listdir(tmp_path)
    assert sorted({n[n.rindex("."):] for n in names}) == [".json", ".txt"] and len(names) == 10
    read = {end: sorted((tmp_path / n).read_bytes().decode() for n in names if n.endswith(end)) for end in (".txt", ".json")}
    assert read[".txt"] == ["\n", "\n", "a\r\nb\n", "a\r\nb\n", "é\n"]
    assert read[".json"] == ['{"text":""}\n', '{"text":"a\\r\\nb"}\n', '{"text":"a\\r\\nb"}\n', '{"text":"é"}\n', "{}\n"]
    write_texts(texts.limit(1), str(tmp_path))
    assert load_documents(spark, str(tmp_path)).count() == 6


def test_very_many_small_files_are_read_by_few_tasks(spark, tmp_path):
    write_texts(spark.range(1100).select(F.concat(F.lit("text "), "id").alias("text")), str(tmp_path))
    files = folder_files(spark, str(tmp_path), supported_only=True)
    assert files.rdd.getNumPartitions() <= 4 * spark.sparkContext.defaultParallelism
    assert sorted(r.text for r in parse_files(files).collect()) == sorted(f"text {i}\n" for i in range(1100))


def test_a_local_folder_is_listed_by_tasks_as_spark_lists_it(spark, tmp_path):
    """Spark's file source would hold every file of the folder in the driver."""
    names = ("a.txt", "B.TXT", "é +%20.txt", "x=1.pdf", "_k=1.txt", "_hidden.txt", ".hidden.txt", "c.txt._COPYING_", "empty.txt", "d.json")
    for name in names:
        (tmp_path / name).write_text("" if name == "empty.txt" else f"in {name}")
    (tmp_path / "sub.txt").mkdir()
    (tmp_path / "sub.txt" / "inner.txt").write_text("not direct")
    (tmp_path / "link.txt").symlink_to(tmp_path / "a.txt")
    (tmp_path / "broken.txt").symlink_to(tmp_path / "gone")
    listed = list_folder(spark, f"{tmp_path}/")
    want = {r.path: bytes(r.content) for r in spark.read.format("binaryFile").load(f"{tmp_path}/*[!d].*").collect()
            if "/sub.txt/" not in r.path}
    want |= {r.path: bytes(r.content) for r in spark.read.format("binaryFile").load(str(tmp_path / "d.json")).collect()}
    assert {r.path: bytes(r.content) for r in listed.files.collect()} == want and len(want) == 7
    assert {r.path for r in listed.paths.collect()} == want.keys()
    supported = folder_files(spark, str(tmp_path), supported_only=True)
    assert {r.path for r in supported.collect()} == {p for p in want if not p.endswith(".json")}
    os.remove(tmp_path / "B.TXT")
    assert {r.path for r in listed.files.collect()} == {p for p in want if not p.endswith("B.TXT")}
    assert "binaryFile" not in supported._jdf.queryExecution().toString()


def test_large_files_have_tasks_of_their_own(spark, tmp_path):
    for k in range(8):
        (tmp_path / f"{k}.txt").write_bytes(b"x" * 9000)
    spark.conf.set("spark.sql.files.maxPartitionBytes", "9000")
    try:
        files = folder_files(spark, str(tmp_path))
        assert files.rdd.getNumPartitions() == 8
        assert sorted(len(r.content) for r in files.collect()) == [9000] * 8
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
