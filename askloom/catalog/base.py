"""What the registered queries share: inputs, SQL fragments and the register itself."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from askloom.config import CHUNK_OVERLAP, CHUNK_SIZE, EMBEDDING_DIM, SEPARATORS, TOP_K
from askloom.functions.text import SENTENCE_BREAK, TOKEN, WHITESPACE
from askloom.operators.chunking import window_chunks
from askloom.operators.embedding import embed
from askloom.operators.retrieval import retrieve
from askloom.session import read_table

Run = Callable[[SparkSession, str], DataFrame]
KEY = ("doc_id", "chunk_no")


@dataclass(frozen=True)
class Query:
    run: Run
    sql: str | None


REGISTER: dict[str, Query] = {}


def query(sql: str | None = None) -> Callable[[Run], Run]:
    """Register a query under its function name, with the SQL that must give the same."""

    def add(run: Run) -> Run:
        REGISTER[run.__name__] = Query(run, sql)
        return run

    return add


# -- inputs ---------------------------------------------------------------------------


def documents(spark: SparkSession, folder: str, *columns: str) -> DataFrame:
    return read_table(spark, folder, "documents", *columns)


def messages(spark: SparkSession, folder: str) -> DataFrame:
    return read_table(spark, folder, "conversations")


def questions(spark: SparkSession, folder: str) -> DataFrame:
    return read_table(spark, folder, "benchmark").select(
        F.col("item_id").alias("question_id"), F.col("text").alias("question"))


def corpus_index(spark: SparkSession, folder: str) -> DataFrame:
    """Window chunks of all documents with vectors; no page in this corpus."""
    pieces = window_chunks(documents(spark, folder, "doc_id", "source", "text"))
    return embed(pieces).withColumn("page", F.lit(None).cast("int"))


def embedded_questions(spark: SparkSession, folder: str) -> DataFrame:
    return embed(questions(spark, folder), text="question").drop("question")


def search_hits(spark: SparkSession, folder: str) -> DataFrame:
    """Hits of all benchmark questions in all documents, with text and source."""
    return retrieve(embedded_questions(spark, folder), corpus_index(spark, folder), key=KEY)


# -- SQL fragments --------------------------------------------------------------------


def sql_text(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def sql_strip(x: str) -> str:
    return f"trim({x}, {sql_text(WHITESPACE)})"


def sql_tokens(x: str) -> str:
    return f"regexp_extract_all(lower({x}), '{TOKEN}')"


def sql_distinct_tokens(x: str) -> str:
    return f"list_distinct({sql_tokens(x)})"


def sql_sentences(x: str) -> str:
    parts = f"string_split_regex({x}, {sql_text(SENTENCE_BREAK)})"
    return f"list_filter(list_transform({parts}, lambda s: {sql_strip('s')}), lambda s: s <> '')"


def sql_round(x: str) -> str:
    return f"(floor(({x}) * 1000000 + 0.5) / 1000000.0)"


def sql_chunks(size: int = CHUNK_SIZE, overlap: int = CHUNK_OVERLAP) -> str:
    step = size - overlap
    count = (f"CASE WHEN length(text) = 0 THEN 0 WHEN length(text) <= {size} THEN 1 "
             f"ELSE CAST(ceil((length(text) - {overlap}) / {step}.0) AS BIGINT) END")
    return f"""
    SELECT doc_id, source, lang, n_chars, CAST(i AS INTEGER) AS chunk_no,
           substr(text, i * {step} + 1, {size}) AS text
    FROM (SELECT *, unnest(range({count})) AS i FROM documents)"""


def sql_recursive_chunks(size: int = CHUNK_SIZE, overlap: int = CHUNK_OVERLAP) -> str:
    """The recursive split, stated on sets: every level cuts the ranges that the level
    before left too long, runs of short pieces are islands, and islands are packed."""
    levels, islands = [], []
    longer = "SELECT doc_id, CAST(0 AS BIGINT) AS lo, text FROM documents WHERE text <> ''"
    for n, separator in enumerate(SEPARATORS):
        s = sql_text(separator)
        parts = (f"list_filter(list_transform(string_split(text, {s}), lambda x, i: "
                 f"CASE WHEN i > 1 THEN {s} || x ELSE x END), lambda x: x <> '')"
                 if separator else "regexp_extract_all(text, '(?s).')")
        levels.append(f"""
    piece{n} AS (SELECT doc_id, lo AS parent, lo + sum(length(p)) OVER w - length(p) AS lo, p AS text
                 FROM (SELECT doc_id, lo, unnest({parts}) AS p, generate_subscripts({parts}, 1) AS pos
                       FROM ({longer}))
                 WINDOW w AS (PARTITION BY doc_id, lo ORDER BY pos)),
    run{n} AS (SELECT *, sum(CASE WHEN length(text) >= {size} THEN 1 ELSE 0 END) OVER (
                   PARTITION BY doc_id, parent ORDER BY lo) AS run FROM piece{n})""")
        islands.append(f"""SELECT doc_id, min(lo) AS lo, list_append(list(lo ORDER BY lo), max(lo + length(text))) AS bounds
                 FROM run{n} WHERE length(text) < {size} GROUP BY doc_id, parent, run""")
        longer = f"SELECT doc_id, lo, text FROM piece{n} WHERE length(text) >= {size}"
    return f"""
    WITH RECURSIVE {','.join(levels)},
    islands AS ({' UNION ALL '.join(islands)}),
    packed AS (
        SELECT doc_id, lo, CAST(1 AS BIGINT) AS a, len(list_filter(bounds, lambda x: x <= bounds[1] + {size})) AS b
        FROM islands
        UNION ALL
        SELECT doc_id, lo, next_a, len(list_filter(bounds, lambda x: x <= bounds[next_a] + {size}))
        FROM (SELECT doc_id, lo, bounds, least(b, 1 + len(list_filter(bounds, lambda x:
                         x < greatest(bounds[b] - {overlap}, bounds[b + 1] - {size})))) AS next_a
              FROM packed JOIN islands USING (doc_id, lo) WHERE b < len(bounds))),
    cut AS (SELECT doc_id, source, lo, a, {sql_strip('substr(text, CAST(bounds[a] AS BIGINT) + 1, CAST(bounds[b] - bounds[a] AS BIGINT))')} AS text
            FROM packed JOIN islands USING (doc_id, lo) JOIN documents USING (doc_id))
    SELECT doc_id, source, CAST(row_number() OVER (PARTITION BY doc_id ORDER BY lo, a) - 1 AS INTEGER) AS chunk_no, text
    FROM cut WHERE text <> ''"""


def sql_vectors(rows: str, ids: str, text: str) -> str:
    """Long form of the default embedding: (ids, b, w) with w the stored FLOAT."""
    return f"""
    SELECT {ids}, b, CAST(n / sqrt(sum(n * n) OVER (PARTITION BY {ids})) AS FLOAT)::DOUBLE AS w
    FROM (SELECT {ids}, b, CAST(count(*) AS DOUBLE) AS n
          FROM (SELECT {ids}, ('0x' || substr(md5(t), 1, 8))::UBIGINT % {EMBEDDING_DIM} AS b
                FROM (SELECT {ids}, unnest({sql_tokens(text)}) AS t FROM {rows}))
          GROUP BY {ids}, b)"""


def sql_search(asked: str = "SELECT item_id AS question_id, text AS question FROM benchmark") -> str:
    """CTEs ``asked``, ``chunks`` and ``hits`` of the text search."""
    return f"""
    asked AS ({asked}),
    chunks AS ({sql_chunks()}),
    cvec AS ({sql_vectors('chunks', 'doc_id, chunk_no', 'text')}),
    qvec AS ({sql_vectors('asked', 'question_id', 'question')}),
    cnorm AS (SELECT doc_id, chunk_no, sqrt(sum(w * w)) AS norm FROM cvec GROUP BY ALL),
    qnorm AS (SELECT question_id, sqrt(sum(w * w)) AS norm FROM qvec GROUP BY ALL),
    dots AS (SELECT question_id, doc_id, chunk_no, sum(q.w * c.w) AS d
             FROM qvec q JOIN cvec c USING (b) GROUP BY ALL),
    pairs AS (SELECT q.question_id, c.doc_id, c.chunk_no,
                     {sql_round('coalesce(d, 0) / (q.norm * c.norm)')} AS score
              FROM qnorm q CROSS JOIN cnorm c LEFT JOIN dots USING (question_id, doc_id, chunk_no)),
    hits AS (SELECT question_id, doc_id, chunk_no, score, CAST(row_number() OVER (
                 PARTITION BY question_id ORDER BY score DESC, doc_id, chunk_no) AS INTEGER) AS rank
             FROM pairs QUALIFY rank <= {TOP_K}),
    texts AS (SELECT h.*, c.source, c.text FROM hits h JOIN chunks c USING (doc_id, chunk_no)),
    contexts AS (SELECT question_id, list(text ORDER BY rank) AS contexts FROM texts GROUP BY ALL)"""


def sql_answers() -> str:
    """CTEs ``statements`` and ``answers`` of the default answer; needs ``sql_search``."""
    shared = f"len(list_intersect({sql_distinct_tokens('s')}, {sql_distinct_tokens('question')}))"
    return f"""
    statements AS (SELECT question_id, question, rank, unnest({sql_sentences('text')}) AS s,
                          generate_subscripts({sql_sentences('text')}, 1) AS pos
                   FROM texts JOIN asked USING (question_id)),
    best AS (SELECT question_id, s FROM statements QUALIFY row_number() OVER (
                 PARTITION BY question_id ORDER BY {shared} DESC, rank, pos) = 1),
    answers AS (SELECT question_id, question, coalesce(s, '') AS answer
                FROM asked LEFT JOIN best USING (question_id))"""
