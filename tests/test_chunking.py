import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from askloom.config import SEPARATORS
from askloom.operators.chunking import (
    check_chunk_size, chunk_report, recursive_chunks, recursive_pieces, split_text, window_chunks, windows,
)


def by_definition(text, size, overlap, separators=SEPARATORS):
    """The split as a plain recursion over lists of strings."""

    def pack(pieces):
        out, held = [], []
        for piece in pieces:
            if held and sum(map(len, held)) + len(piece) > size:
                out.append("".join(held))
                while sum(map(len, held)) > overlap or (held and sum(map(len, held)) + len(piece) > size):
                    held.pop(0)
            held.append(piece)
        return [c.strip() for c in [*out, "".join(held)] if c.strip()]

    def cut(text, separators):
        usable = [i for i, s in enumerate(separators) if s in text]
        if not usable:
            pieces, rest = [text], ()
        else:
            s, rest = separators[usable[0]], separators[usable[0] + 1:]
            parts = text.split(s) if s else list(text)
            pieces = [p for p in [parts[0], *[s + p for p in parts[1:]]] if p]
        out, run = [], []
        for piece in pieces:
            if len(piece) < size:
                run.append(piece)
                continue
            out += pack(run)
            run = []
            out += cut(piece, rest) if rest else [piece]
        return out + pack(run)

    return cut(text, tuple(separators)) if text else []


def window_by_definition(text, size, overlap):
    if len(text) <= size:
        return [text] if text else []
    step = size - overlap
    return [text[i * step:i * step + size] for i in range(-(-(len(text) - overlap) // step))]


TEXTS = st.text(alphabet="ab \n.!?é🙂", max_size=400)


@settings(max_examples=400, deadline=None)
@given(TEXTS, st.integers(1, 40), st.data())
def test_recursive_split_equals_definition(text, size, data):
    overlap = data.draw(st.integers(0, size - 1))
    assert split_text(text, size, overlap, SEPARATORS) == by_definition(text, size, overlap)


@settings(max_examples=100, deadline=None)
@given(TEXTS, st.integers(2, 30))
def test_recursive_split_with_other_separators(text, size):
    for separators in (("\n\n", " "), ("aa", "a"), (" ", "")):
        assert split_text(text, size, 1, separators) == by_definition(text, size, 1, separators)


def test_each_separator_level():
    for separator in SEPARATORS[:-1]:
        text = separator.join(["w" * 30] * 6)
        got = split_text(text, 50, 10, SEPARATORS)
        assert got == by_definition(text, 50, 10) and len(got) >= 5


def test_long_word_after_paragraph():
    text = "intro words here\n\n" + "x" * 2000
    got = split_text(text, 800, 100, SEPARATORS)
    assert got == by_definition(text, 800, 100)
    # The newline in front of the long word takes part in its first window.
    assert [len(c) for c in got] == [16, 799, 800, 601]


def test_many_long_lines_stay_linear():
    text = "\n".join("y" * 900 for _ in range(4000))
    assert len(split_text(text, 800, 100, SEPARATORS)) == 8000


def test_fixtures(spark):
    rows = [("large", "This is a test sentence. " * 100), ("plain", "A" * 900), ("words", "Word " * 200),
            ("blank", " \n\n \t"), ("empty", ""), ("exact", "B" * 800), ("none", None)]
    chunks = recursive_chunks(spark.createDataFrame(rows, "source string, text string"))
    got = {}
    for r in chunks.orderBy("source", "chunk_no").collect():
        got.setdefault(r.source, []).append(r.text)
    assert got == {s: by_definition(t, 800, 100) for s, t in rows if t and t.strip()}
    assert len(got["large"]) > 1 and [len(c) for c in got["plain"]] == [800, 200]
    # The last 20 words of a chunk, 100 characters, open the next one.
    assert got["words"][0].endswith(got["words"][1][:99])


@pytest.mark.parametrize("size, overlap", [(10, 0), (10, 3), (10, 9), (7, 6), (500, 100)])
def test_windows_equal_definition(spark, size, overlap):
    rng = random.Random(7)
    lengths = [0, 1, size - 1, size, size + 1, 2 * size - overlap, 2 * size - overlap + 1, 5 * size + 3]
    texts = ["".join(rng.choice("aé\n🙂 ") for _ in range(n)) for n in lengths]
    df = spark.createDataFrame(list(enumerate(texts)), "id int, text string")
    got = {r.id: r.w for r in df.select("id", windows("text", size, overlap).alias("w")).collect()}
    assert got == {i: window_by_definition(t, size, overlap) for i, t in enumerate(texts)}


def test_windows_are_the_split_without_separators(spark):
    texts = ["A" * n for n in range(1, 1700, 97)] + ["A" * 1200]
    df = spark.createDataFrame([(t,) for t in texts], "text string")
    row = df.select(F.bool_and(windows("text") == recursive_pieces("text")).alias("same")).head()
    assert row.same
    assert [len(c) for c in split_text("A" * 1200, 500, 100, SEPARATORS)] == [500, 500, 400]


def test_windows_without_overlaps_restore_the_text(spark):
    text = "".join(random.Random(1).choices("abc \n", k=5000))
    df = spark.createDataFrame([("d", 3, text)], "source string, page int, text string")
    rows = window_chunks(df, 400, 50).orderBy("chunk_no").collect()
    assert rows[0].text + "".join(r.text[50:] for r in rows[1:]) == text
    assert all(a.text[-50:] == b.text[:50] for a, b in zip(rows, rows[1:]))
    assert {(r.source, r.page) for r in rows} == {("d", 3)}


def test_report_and_check(spark):
    df = spark.createDataFrame([("a", "x" * 900), ("a", "y"), ("b", "")], "source string, text string")
    report = {r.source: (r.n_sections, r.n_chunks, r.longest_chunk)
              for r in chunk_report(df, windows("text"), "source").collect()}
    assert report == {"a": (2, 3, 800), "b": (1, 0, None)}
    assert check_chunk_size(window_chunks(df)).head().within_bound
    assert not check_chunk_size(df).head().within_bound


def test_bad_sizes():
    for size, overlap in ((0, 0), (10, 10), (10, -1)):
        with pytest.raises(ValueError):
            windows("text", size, overlap)
        with pytest.raises(ValueError):
            recursive_pieces("text", size, overlap)


def test_rules_sort_no_texts(spark, tmp_path, capsys):
    """The grouping of ``recursive_split_rules`` sorts its rows; texts and chunks are judged before."""
    from askloom.catalog import REGISTER

    spark.createDataFrame([(1, "a b"), (2, "x. " * 900)], "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    rules = REGISTER["recursive_split_rules"].run(spark, str(tmp_path))
    rules.explain()
    plan = capsys.readouterr().out.splitlines()
    sorts = [k for k, line in enumerate(plan) if "Sort [doc_id" in line]
    assert sorts and all("Project [doc_id" in plan[k + 1] and "AS single" in plan[k + 1] or "Exchange" in plan[k + 1] for k in sorts)
    assert [tuple(r)[2:] for r in rules.collect()] == [(True, True)] * 2
