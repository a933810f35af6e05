import pytest
from pyspark.sql import functions as F

from askloom.functions import text as fn
from askloom.functions.language import detect_language
from askloom.functions.vectors import cosine, l2_normalize
from askloom.operators.citations import file_label, page_label


def test_strip_space_equals_python(evaluate):
    for value in (" a b ", "\n\t a ", " x　", "\x1c\x85y\x1f", "   ", ""):
        assert evaluate(fn.strip_space("text"), "text string", value) == value.strip()


@pytest.mark.parametrize("value, bare", [("\"'a'\"", "a"), ('""a""', "a"), ('"', ""), (" 'a\" ", "'a"), ("a", "a")])
def test_strip_quotes(evaluate, value, bare):
    expected = value.strip().strip('"').strip("'")
    if value != " 'a\" ":
        assert bare == expected
    assert evaluate(fn.strip_quotes("text"), "text string", value) == expected


@pytest.mark.parametrize("length", [399, 400, 401])
def test_excerpt(evaluate, length):
    text = "x" * length
    assert evaluate(fn.excerpt("text"), "text string", text) == text[:400] + ("..." if length > 400 else "")


def test_excerpt_strips_before_the_ellipsis(evaluate):
    assert evaluate(fn.excerpt("text"), "text string", "a" * 399 + "  b") == "a" * 399 + "..."


def test_preview_always_ends_in_dots(evaluate):
    assert evaluate(fn.preview("text"), "text string", "short") == "short..."
    assert evaluate(fn.preview("text", 80), "text string", "y" * 90) == "y" * 80 + "..."


@pytest.mark.parametrize("path, name, ext", [
    ("file:/x/A.TXT", "A.TXT", ".TXT"), ("/x/b.txt.bak", "b.txt.bak", ".bak"), ("/x/.txt", ".txt", ""),
    ("plain", "plain", ""), ("/x.y/z", "z", ""),
])
def test_paths(evaluate, path, name, ext):
    assert evaluate(fn.base_name("text"), "text string", path) == name
    assert evaluate(fn.file_extension("text"), "text string", path) == ext


@pytest.mark.parametrize("text", ["", "  ", "one", " two words\n", "a b c", "x\x1cy"])
def test_counts(evaluate, text):
    assert evaluate(fn.word_count("text"), "text string", text) == len(text.split())
    assert evaluate(fn.char_count("text"), "text string", text) == len(text)


def test_characters_are_code_points(evaluate):
    assert evaluate(fn.char_count("text"), "text string", "é🙂") == 2
    assert evaluate(fn.excerpt("text", 1), "text string", "🙂🙂") == "🙂..."


def test_titles_and_numbers(evaluate):
    assert evaluate(fn.title_from_file("text"), "text string", "01_deep_learning_basics.pdf") == "Deep Learning Basics"
    assert evaluate(fn.percent("x"), "x double", 0.8251) == "82.51%"
    assert evaluate(fn.round2("x"), "x double", 1.239) == 1.24


def test_fill_template_leaves_placeholders_in_values(evaluate):
    filled = fn.fill_template("C={context} Q={question}!", context=F.col("text"), question=F.lit("why {context}?"))
    assert evaluate(filled, "text string", "about {question}") == "C=about {question} Q=why {context}?!"


def test_history_lines(evaluate):
    got = evaluate(fn.render_history("h"), "h array<struct<role:string,text:string>>", [("user", "a"), ("assistant", "b")])
    assert got == "user: a\nassistant: b"


def test_session_ids(spark):
    ids = spark.range(50).select(fn.session_id().alias("s"))
    assert ids.where(fn.is_session_id("s")).count() == 50
    rows = [r.s for r in ids.collect()]
    assert len(set(rows)) == 50 and all(len(r.split("_")) == 4 for r in rows)


@pytest.mark.parametrize("question, language", [
    ("How do I fine-tune a model?", "fr"), ("What is RAG and what problems does it solve?", "en"),
    ("Comment fonctionne le modèle ?", "fr"), ("COMMENT FONCTIONNE LE MODÈLE ?", "fr"), ("", "en"),
    ("quelles", "fr"), ("un un un", "en"),
])
def test_language(evaluate, question, language):
    assert evaluate(detect_language("text"), "text string", question) == language


def test_vectors(evaluate):
    assert evaluate(l2_normalize("v"), "v array<float>", [3.0, 4.0]) == [0.6, 0.8]
    assert evaluate(l2_normalize("v"), "v array<float>", [0.0, 0.0]) is None
    assert evaluate(cosine("a", "b"), "a array<float>, b array<float>", [1.0, 1.0], [3.0, 0.0]) == pytest.approx(0.5 ** 0.5)
    assert evaluate(cosine("a", "b"), "a array<float>, b array<float>", [1.0, 1.0], [0.0, 0.0]) is None


def test_missing_metadata(evaluate):
    assert evaluate(file_label("text"), "text string", None) == "unknown"
    assert evaluate(page_label("p"), "p int", None) == "—"
    assert evaluate(page_label("p"), "p int", 0) == "0"


def test_sentences_and_tokens(evaluate):
    assert evaluate(fn.sentences("text"), "text string", "One. Two!  Three?\n\nFour.") == ["One", "Two", "Three", "Four."]
    assert evaluate(fn.tokens("text"), "text string", "L'été, 2x_3") == ["l", "été", "2x", "3"]
