"""Scalar text functions and markdown."""

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from askloom.catalog.base import documents, messages, query, sql_sentences, sql_strip, sql_text, sql_tokens
from askloom.functions import text as fn
from askloom.functions.text import WHITESPACE
from askloom.operators.markdown import (
    FENCE, fence_state, length_report, line_kind, markdown_blocks,
)


def _md5(value: Column, name: str) -> Column:
    return F.md5(value).alias(name)


@query(f"""SELECT doc_id, md5(lower(text)) AS lowered, md5({sql_strip('text')}) AS stripped,
                  md5({sql_strip('substr(text, 1, 400)')} || CASE WHEN length(text) > 400 THEN '...' ELSE '' END) AS excerpt,
                  substr(text, 1, 60) || '...' AS preview,
                  CAST(length(text) AS INTEGER) AS n_chars,
                  CAST(len(regexp_extract_all(text, {sql_text(f'[^{WHITESPACE}]+')})) AS INTEGER) AS n_words
           FROM documents""")
def text_functions(spark: SparkSession, folder: str) -> DataFrame:
    return documents(spark, folder, "doc_id", "text").select(
        "doc_id", _md5(F.lower("text"), "lowered"), _md5(fn.strip_space("text"), "stripped"),
        _md5(fn.excerpt("text"), "excerpt"), fn.preview("text").alias("preview"),
        fn.char_count("text").alias("n_chars"), fn.word_count("text").alias("n_words"))


@query(f"""SELECT conv_id, turn, md5(trim(trim({sql_strip("chr(34) || chr(39) || text || chr(39) || chr(34)")}, '"'), '''')) AS bare
           FROM conversations""")
def unquoted_turns(spark: SparkSession, folder: str) -> DataFrame:
    quoted = F.concat(F.lit("\"'"), "text", F.lit("'\""))
    return messages(spark, folder).select("conv_id", "turn", _md5(fn.strip_quotes(quoted), "bare"))


@query("""SELECT doc_id, f AS file, CASE lang WHEN 'en' THEN '.TXT' WHEN 'de' THEN '.gz' WHEN 'fr' THEN '' ELSE '.v' || doc_id END AS extension,
                 CASE WHEN lang = 'en' THEN '.v' || doc_id ELSE '' END AS hidden_extension
          FROM (SELECT doc_id, lang, source || CASE lang WHEN 'en' THEN '.v' || doc_id || '.TXT' WHEN 'de' THEN '.tar.gz'
                       WHEN 'fr' THEN '' ELSE '.v' || doc_id END AS f FROM documents)""")
def path_functions(spark: SparkSession, folder: str) -> DataFrame:
    """Names with one suffix, with two, with none, and hidden ones."""
    version = F.concat(F.lit(".v"), "doc_id")
    tail = F.when(F.col("lang") == "en", F.concat(version, F.lit(".TXT"))).when(F.col("lang") == "de", ".tar.gz").when(
        F.col("lang") == "fr", "").otherwise(version)
    path = F.concat(F.lit("/corpus.d/"), "lang", F.lit("/"), "source", tail)
    hidden = F.concat(F.lit("/corpus/."), "source", F.when(F.col("lang") == "en", version).otherwise(""))
    return documents(spark, folder, "doc_id", "lang", "source").select(
        "doc_id", fn.base_name(path).alias("file"), fn.file_extension(path).alias("extension"),
        fn.file_extension(hidden).alias("hidden_extension"))


@query("""SELECT doc_id, upper(lang[1]) || lang[2:] || ' ' || upper(source[1]) || source[2:] || ' Report' AS title
          FROM documents""")
def file_titles(spark: SparkSession, folder: str) -> DataFrame:
    name = F.concat("doc_id", F.lit("_"), "lang", F.lit("_"), "source", F.lit("_report.pdf"))
    return documents(spark, folder, "doc_id", "lang", "source").select("doc_id", fn.title_from_file(name).alias("title"))


@query(f"""SELECT doc_id, CAST(len({sql_tokens('text')}) AS INTEGER) AS n_tokens,
                  CAST(len(list_distinct({sql_tokens('text')})) AS INTEGER) AS n_distinct,
                  CAST(len({sql_sentences('text')}) AS INTEGER) AS n_sentences,
                  md5(array_to_string({sql_sentences('text')}, '|')) AS sentences
           FROM documents""")
def tokens_and_sentences(spark: SparkSession, folder: str) -> DataFrame:
    return documents(spark, folder, "doc_id", "text").select(
        "doc_id", F.size(fn.tokens("text")).alias("n_tokens"), F.size(fn.distinct_tokens("text")).alias("n_distinct"),
        F.size(fn.sentences("text")).alias("n_sentences"), _md5(F.array_join(fn.sentences("text"), "|"), "sentences"))


@query(f"""SELECT doc_id, CAST(length(text) AS INTEGER) AS n_chars,
                  CAST(len(regexp_extract_all(text, {sql_text(f'[^{WHITESPACE}]+')})) AS INTEGER) AS n_words
           FROM documents""")
def document_lengths(spark: SparkSession, folder: str) -> DataFrame:
    return length_report(documents(spark, folder, "doc_id", "text"))


# -- markdown: documents dressed up with headings, bullets and a fence around one line ---

_MARKDOWN = """replace(replace(replace(replace(replace('# ' || source || chr(10) || text || chr(10) || '```' || chr(10) || text,
    '. ', chr(10) || '- '), '! ', chr(10) || '```sh' || chr(10)), ' is ', chr(10) || '### '),
    ' der ', chr(10) || '12. '), ' la ', chr(10) || chr(10) || 'Note: ')"""


def _markdown(spark: SparkSession, folder: str) -> DataFrame:
    text = F.concat(F.lit("# "), "source", F.lit("\n"), "text", F.lit("\n```\n"), "text")
    for old, new in ((". ", "\n- "), ("! ", "\n```sh\n"), (" is ", "\n### "), (" der ", "\n12. "), (" la ", "\n\nNote: ")):
        text = F.replace(text, F.lit(old), F.lit(new))
    return documents(spark, folder, "doc_id", "source", "text").select("doc_id", text.alias("text"))


_LINES = f"""
    lines AS (SELECT doc_id, pos, line, {sql_strip('line')} AS s FROM (
        SELECT doc_id, unnest(string_split(md, chr(10))) AS line, generate_subscripts(string_split(md, chr(10)), 1) AS pos
        FROM (SELECT doc_id, {_MARKDOWN} AS md FROM documents))),
    fenced AS (SELECT *, starts_with(s, '{FENCE}') AS is_fence,
                      CAST(sum(CASE WHEN starts_with(s, '{FENCE}') THEN 1 ELSE 0 END) OVER (
                          PARTITION BY doc_id ORDER BY pos) AS BIGINT) AS n_fences FROM lines)"""


@query(f"""WITH {_LINES} SELECT doc_id, n_fences % 2 = 1 AS in_code, count(*) AS n_lines,
                  CAST(sum(length(line)) AS BIGINT) AS n_chars
           FROM fenced WHERE NOT is_fence GROUP BY ALL""")
def code_fences(spark: SparkSession, folder: str) -> DataFrame:
    """Lines inside and outside of fences."""
    return fence_state(_markdown(spark, folder)).groupBy("doc_id", "in_code").agg(
        F.count(F.lit(1)).alias("n_lines"), F.sum(F.char_length("line")).alias("n_chars"))


_KIND = f"""CASE WHEN s = '' THEN 'blank' WHEN starts_with(s, '### ') THEN 'h3' WHEN starts_with(s, '## ') THEN 'h2'
    WHEN starts_with(s, '# ') THEN 'h1'
    WHEN starts_with(s, '- ') OR starts_with(s, '* ') OR starts_with(s, '• ') THEN 'bullet'
    WHEN regexp_matches(s, {sql_text(r'^\p{Nd}+\.[' + WHITESPACE + ']')}) AND length(s) < 300 THEN 'numbered'
    WHEN regexp_matches(lower(s), '^(note|tip|important|warning):') THEN 'note' ELSE 'body' END"""


@query(f"""WITH {_LINES},
    outside AS (SELECT doc_id, pos, {_KIND} AS kind,
                       CASE {_KIND} WHEN 'h3' THEN substr(s, 5) WHEN 'h2' THEN substr(s, 4) WHEN 'h1' THEN substr(s, 3)
                            WHEN 'bullet' THEN substr(s, 3) ELSE s END AS text
                FROM fenced WHERE NOT is_fence AND n_fences % 2 = 0),
    opened AS (SELECT doc_id, n_fences, pos FROM fenced WHERE is_fence AND n_fences % 2 = 1),
    closed AS (SELECT doc_id, n_fences - 1 AS n_fences FROM fenced WHERE is_fence AND n_fences % 2 = 0),
    inner_lines AS (SELECT doc_id, n_fences, string_agg(line, chr(10) ORDER BY pos) AS text
                    FROM fenced WHERE NOT is_fence AND n_fences % 2 = 1 GROUP BY ALL),
    code AS (SELECT o.doc_id, o.pos, 'code' AS kind, coalesce(text, '') AS text
             FROM opened o JOIN closed USING (doc_id, n_fences) LEFT JOIN inner_lines USING (doc_id, n_fences))
    SELECT doc_id, CAST(row_number() OVER (PARTITION BY doc_id ORDER BY pos) - 1 AS INTEGER) AS block_no, kind,
           md5(text) AS digest
    FROM (SELECT * FROM outside UNION ALL SELECT * FROM code)""")
def document_blocks(spark: SparkSession, folder: str) -> DataFrame:
    return markdown_blocks(_markdown(spark, folder)).select("doc_id", "block_no", "kind", _md5(F.col("text"), "digest"))


@query(f"""SELECT kind, count(*) AS n FROM (SELECT {_KIND} AS kind FROM (
               SELECT {sql_strip('line')} AS s FROM (SELECT unnest(string_split(text, chr(10))) AS line FROM documents)))
           GROUP BY kind""")
def line_kinds(spark: SparkSession, folder: str) -> DataFrame:
    lines = documents(spark, folder, "text").select(F.explode(F.split("text", "\n")).alias("line"))
    return lines.groupBy(line_kind(fn.strip_space("line")).alias("kind")).agg(F.count(F.lit(1)).alias("n"))
