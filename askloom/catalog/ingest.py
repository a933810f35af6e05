"""Loading, chunking, embedding and the stored index."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from askloom import schemas
from askloom.catalog.base import (
    documents, messages, query, questions, sql_chunks, sql_recursive_chunks, sql_round,
    sql_strip, sql_vectors,
)
from askloom.functions.text import is_session_id, session_id, strip_space
from askloom.functions.vectors import l2_normalize, round_score
from askloom.operators.chunking import (
    check_chunk_size, chunk_report, recursive_chunks, window_chunks, windows,
)
from askloom.operators.embedding import embed, nonzero
from askloom.operators.windows import running_number
from askloom.session import read_table, scratch_path
from askloom.sources.files import concat_documents, decode_text, load_summary as summarize
from askloom.sources.index import (
    append_index, load_or_create, read_index, write_index, write_sessions,
)
from askloom.sources.questions import read_questions, write_questions
from askloom.sources.results import read_results, write_results
from askloom.streaming.incremental import ingest_new_documents


@query("SELECT source, count(*) AS n_sections FROM documents GROUP BY source")
def load_summary(spark: SparkSession, folder: str) -> DataFrame:
    return summarize(documents(spark, folder, "source"))


@query("""SELECT source, doc_id, row_number() OVER (ORDER BY source, doc_id) AS row_no
          FROM documents""")
def document_order(spark: SparkSession, folder: str) -> DataFrame:
    return running_number(documents(spark, folder, "source", "doc_id"), "source", "doc_id")


@query(r"""SELECT doc_id, CAST(length(t) AS INTEGER) AS n_chars, md5(t) AS digest
           FROM (SELECT doc_id, regexp_replace(replace(text, chr(10), chr(13) || chr(10)),
                                               '\r\n?', chr(10), 'g') AS t FROM documents)""")
def text_decoding(spark: SparkSession, folder: str) -> DataFrame:
    """The text reader on documents stored as bytes with other line ends."""
    stored = documents(spark, folder, "doc_id", "text").select(
        "doc_id", F.encode(F.replace("text", F.lit("\n"), F.lit("\r\n")), "UTF-8").alias("content"))
    text = stored.select("doc_id", decode_text("content").alias("t"))
    return text.select("doc_id", F.char_length("t").alias("n_chars"), F.md5("t").alias("digest"))


@query("""SELECT source, count(*) AS n_sections FROM (
              SELECT source FROM documents UNION ALL SELECT source FROM documents) GROUP BY source""")
def concatenated_documents(spark: SparkSession, folder: str) -> DataFrame:
    docs = documents(spark, folder, "source")
    return summarize(concat_documents(docs, docs))


def _digests(chunks: DataFrame, *columns: str) -> DataFrame:
    return chunks.select(
        "doc_id", "chunk_no", *columns, F.char_length("text").alias("n"), F.md5("text").alias("digest"))


@query(f"""SELECT doc_id, chunk_no, source, lang, n_chars, CAST(length(text) AS INTEGER) AS n,
                  md5(text) AS digest FROM ({sql_chunks()})""")
def character_windows(spark: SparkSession, folder: str) -> DataFrame:
    """Window chunks with the metadata of their documents."""
    return _digests(window_chunks(documents(spark, folder)), "source", "lang", "n_chars")


@query(f"""SELECT doc_id, chunk_no, CAST(length(text) AS INTEGER) AS n, md5(text) AS digest
           FROM ({sql_chunks(500, 100)})""")
def character_windows_500(spark: SparkSession, folder: str) -> DataFrame:
    return _digests(window_chunks(documents(spark, folder, "doc_id", "text"), 500, 100))


@query(f"""SELECT doc_id, chunk_no, source, CAST(length(text) AS INTEGER) AS n, md5(text) AS digest
           FROM ({sql_recursive_chunks()})""")
def recursive_split(spark: SparkSession, folder: str) -> DataFrame:
    return _digests(recursive_chunks(documents(spark, folder, "doc_id", "source", "text")), "source")


@query(f"""SELECT doc_id, chunk_no, CAST(length(text) AS INTEGER) AS n, md5(text) AS digest
           FROM ({sql_recursive_chunks(500, 100)})""")
def recursive_split_500(spark: SparkSession, folder: str) -> DataFrame:
    return _digests(recursive_chunks(documents(spark, folder, "doc_id", "text"), 500, 100))


@query(f"""SELECT doc_id, CAST(CASE WHEN length(text) <= 800 THEN md5({sql_strip('text')}) END AS VARCHAR)
                  AS single, true AS bounded, true AS found_in_text
           FROM documents WHERE {sql_strip('text')} <> ''""")
def recursive_split_rules(spark: SparkSession, folder: str) -> DataFrame:
    """What must hold for every document: a text that fits is one stripped chunk, no chunk
    is longer than the size, every chunk is a piece of the text."""
    docs = documents(spark, folder, "doc_id", "text").withColumn("whole", F.col("text"))
    # Judged before the grouping, which sorts its rows: texts take no part in it.
    judged = recursive_chunks(docs).select(
        "doc_id", F.when(F.char_length("whole") <= 800, F.md5("text")).alias("single"),
        (F.char_length("text") <= 800).alias("bounded"), F.contains("whole", "text").alias("found_in_text"))
    return judged.groupBy("doc_id").agg(
        F.max("single").alias("single"), F.bool_and("bounded").alias("bounded"), F.bool_and("found_in_text").alias("found_in_text"))


@query(f"""SELECT source, count(DISTINCT doc_id) AS n_sections, count(*) AS n_chunks,
                  CAST(max(length(text)) AS INTEGER) AS longest_chunk FROM ({sql_chunks()}) GROUP BY source""")
def chunk_counts(spark: SparkSession, folder: str) -> DataFrame:
    return chunk_report(documents(spark, folder, "source", "text"), windows("text"), "source")


@query(f"""SELECT count(*) AS n_chunks, CAST(count_if(length(text) > 800) AS BIGINT) AS n_over,
                  CAST(max(length(text)) AS INTEGER) AS longest_chunk, bool_and(length(text) <= 800) AS within_bound
           FROM ({sql_chunks()})""")
def chunk_size_check(spark: SparkSession, folder: str) -> DataFrame:
    return check_chunk_size(window_chunks(documents(spark, folder, "text")))


@query(f"""SELECT doc_id, CAST(b AS INTEGER) AS bucket, {sql_round('w')} AS weight
           FROM ({sql_vectors('documents', 'doc_id', 'text')})""")
def embedded_documents(spark: SparkSession, folder: str) -> DataFrame:
    vectors = embed(documents(spark, folder, "doc_id", "text"))
    return nonzero(vectors, "doc_id").withColumn("weight", round_score(F.col("weight").cast("double")))


@query(f"""SELECT item_id AS question_id, CAST(b AS INTEGER) AS bucket, {sql_round('w')} AS weight
           FROM ({sql_vectors('benchmark', 'item_id', 'text')})""")
def embedded_benchmark(spark: SparkSession, folder: str) -> DataFrame:
    vectors = embed(questions(spark, folder), text="question")
    return nonzero(vectors, "question_id").withColumn("weight", round_score(F.col("weight").cast("double")))


@query(f"""SELECT vec_id, CAST(pos - 1 AS INTEGER) AS position, {sql_round('x / norm')} AS value
           FROM (SELECT vec_id, unnest(v) AS x, generate_subscripts(v, 1) AS pos,
                        sqrt(list_sum(list_transform(v, lambda y: y * y))) AS norm
                 FROM (SELECT vec_id, list_transform(embedding, lambda x: x::DOUBLE * (label + 1)) AS v
                       FROM embeddings))""")
def normalized_vectors(spark: SparkSession, folder: str) -> DataFrame:
    """Unit vectors again after every vector was stretched by its label."""
    rows = read_table(spark, folder, "embeddings").select(
        "vec_id", F.transform("embedding", lambda x: x.cast("double") * (F.col("label") + 1)).alias("v"))
    unit = rows.select("vec_id", F.posexplode(l2_normalize("v")).alias("position", "value"))
    return unit.withColumn("value", round_score("value"))


_VECTORS = T.StructType([
    T.StructField("vec_id", T.LongType()), T.StructField("label", T.IntegerType()),
    T.StructField("embedding", schemas.VECTOR),
])


@query(f"""SELECT vec_id, label, CAST(len(embedding) AS INTEGER) AS dim,
                  {sql_round('list_sum(list_transform(embedding, lambda x: x::DOUBLE))')} AS total
           FROM embeddings""")
def index_round_trip(spark: SparkSession, folder: str) -> DataFrame:
    path = scratch_path(spark, "index")
    write_index(read_table(spark, folder, "embeddings").select(_VECTORS.names), path)
    total = F.aggregate("embedding", F.lit(0.0), lambda acc, x: acc + x.cast("double"))
    return read_index(spark, path, schema=_VECTORS).select(
        "vec_id", "label", F.size("embedding").alias("dim"), round_score(total).alias("total"))


_TEXTS = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("source", T.StringType()),
    T.StructField("text", T.StringType()),
])


@query("""SELECT source, 2 * count(*) AS n_rows, CAST(2 * sum(length(text)) AS BIGINT) AS n_chars
          FROM documents GROUP BY source""")
def index_append(spark: SparkSession, folder: str) -> DataFrame:
    """Documents added to an index that holds them already are there twice."""
    path = scratch_path(spark, "index")
    docs = documents(spark, folder, *_TEXTS.names)
    write_index(docs, path)
    append_index(docs, path)
    return read_index(spark, path, schema=_TEXTS).groupBy("source").agg(
        F.count(F.lit(1)).alias("n_rows"), F.sum(F.char_length("text")).alias("n_chars"))


@query("""SELECT source, count(*) AS n_rows, CAST(sum(length(text)) AS BIGINT) AS n_chars
          FROM documents GROUP BY source""")
def loaded_or_created_index(spark: SparkSession, folder: str) -> DataFrame:
    """Created by the first call, loaded by the second."""
    path = scratch_path(spark, "index")
    docs = documents(spark, folder, *_TEXTS.names)
    load_or_create(spark, path, docs, schema=_TEXTS)
    return load_or_create(spark, path, docs.unionByName(docs), schema=_TEXTS).groupBy("source").agg(
        F.count(F.lit(1)).alias("n_rows"), F.sum(F.char_length("text")).alias("n_chars"))


_TURNS = T.StructType([
    T.StructField("conv_id", T.LongType()), T.StructField("turn", T.LongType()),
    T.StructField("text", T.StringType()),
])
_SESSIONS = """SELECT role AS session_id, count(*) AS n_rows, CAST(sum(length(text)) AS BIGINT) AS n_chars
               FROM conversations GROUP BY role"""


def _by_session(index: DataFrame) -> DataFrame:
    return index.groupBy("session_id").agg(
        F.count(F.lit(1)).alias("n_rows"), F.sum(F.char_length("text")).alias("n_chars"))


@query(_SESSIONS)
def session_indexes(spark: SparkSession, folder: str) -> DataFrame:
    """One session per role, written together."""
    path = scratch_path(spark, "index")
    write_sessions(messages(spark, folder).select(F.col("role").alias("session_id"), *_TURNS.names), path)
    return _by_session(read_index(spark, path, None, _TURNS))


@query(f"SELECT * FROM ({_SESSIONS}) WHERE session_id = 'user'")
def rewritten_session(spark: SparkSession, folder: str) -> DataFrame:
    """Sessions written again after an append hold what was written last; one is read alone."""
    path = scratch_path(spark, "index")
    turns = messages(spark, folder).select(F.col("role").alias("session_id"), *_TURNS.names)
    write_sessions(turns, path)
    append_index(turns.drop("session_id"), path, session="user")
    write_sessions(turns, path)
    return _by_session(read_index(spark, path, "user", _TURNS))


@query(f"""SELECT source, 2 * count(*) AS n_chunks, CAST(2 * sum(length(text)) AS BIGINT) AS n_chars
           FROM ({sql_chunks()}) GROUP BY source""")
def two_streams(spark: SparkSession, folder: str) -> DataFrame:
    """Two streams with checkpoints of their own into one index keep each other's rows."""
    path = scratch_path(spark, "index")
    for _ in range(2):
        ingest_new_documents(spark, f"{folder}/documents.parquet/", _TEXTS, path, scratch_path(spark, "stream"),
                             to_rows=window_chunks)
    return read_index(spark, path, schema=_TEXTS).groupBy("source").agg(
        F.count(F.lit(1)).alias("n_chunks"), F.sum(F.char_length("text")).alias("n_chars"))


@query(f"""SELECT source, count(*) AS n_chunks, CAST(sum(length(text)) AS BIGINT) AS n_chars
           FROM ({sql_chunks()}) GROUP BY source""")
def incremental_ingest(spark: SparkSession, folder: str) -> DataFrame:
    """The documents table as a stream, cut and appended to an index; the second run finds
    nothing new."""
    path, checkpoint = scratch_path(spark, "index"), scratch_path(spark, "stream")
    for _ in range(2):
        ingest_new_documents(
            spark, f"{folder}/documents.parquet", _TEXTS, path, checkpoint, to_rows=window_chunks)
    return read_index(spark, path, schema=_TEXTS).groupBy("source").agg(
        F.count(F.lit(1)).alias("n_chunks"), F.sum(F.char_length("text")).alias("n_chars"))


@query(f"SELECT doc_id, md5({sql_strip('text')}) AS digest FROM documents")
def stripped_documents(spark: SparkSession, folder: str) -> DataFrame:
    return documents(spark, folder, "doc_id", "text").select("doc_id", F.md5(strip_space("text")).alias("digest"))


@query("""SELECT item_id AS place, CAST(length(text) AS INTEGER) AS n, md5(text) AS digest FROM benchmark""")
def question_set(spark: SparkSession, folder: str) -> DataFrame:
    """The benchmark written as JSON and read back as a question set; the truth carries
    the item's number."""
    path = scratch_path(spark, "questions")
    items = questions(spark, folder)
    items.select("question", F.col("question_id").cast("string").alias("ground_truth")).write.json(path)
    return read_questions(spark, path).select(
        F.col("ground_truth").cast("bigint").alias("place"), F.char_length("question").alias("n"),
        F.md5("question").alias("digest"))


@query("""SELECT doc_id, CAST(length(text) AS INTEGER) AS n, md5(text) AS digest, lang FROM documents""")
def question_arrays(spark: SparkSession, folder: str) -> DataFrame:
    """All documents as questions of JSON arrays, which hold any character, and back."""
    path = scratch_path(spark, "arrays")
    rows = documents(spark, folder, "doc_id", "lang", "text")
    write_questions(rows.select(
        F.col("text").alias("question"), F.concat_ws("/", "doc_id", "lang").alias("ground_truth")), path)
    named = F.split("ground_truth", "/")
    return read_questions(spark, path).select(
        named[0].cast("bigint").alias("doc_id"), F.char_length("question").alias("n"), F.md5("question").alias("digest"),
        named[1].alias("lang"))


@query("""SELECT conv_id, turn, md5(text) AS answer, CASE WHEN role = 'user' THEN '' ELSE role END AS truth,
                 CASE WHEN role = 'system' THEN NULL ELSE md5(role || ', "' || text || '"') END AS quoted
          FROM conversations""")
def result_csv(spark: SparkSession, folder: str) -> DataFrame:
    """All messages through the result CSV: newlines, quotes, empty strings and NULL."""
    path = scratch_path(spark, "results")
    rows = messages(spark, folder).select(
        F.concat_ws("/", "conv_id", "turn").alias("question_originale"),
        F.when(F.col("role") != "system", F.concat("role", F.lit(', "'), "text", F.lit('"'))).alias("question_anglais"),
        F.col("text").alias("reponse_rag"),
        F.when(F.col("role") == "user", "").otherwise(F.col("role")).alias("ground_truth"))
    write_results(rows, path)
    ids = F.split("question_originale", "/").cast("array<bigint>")
    return read_results(spark, path).select(
        ids[0].alias("conv_id"), ids[1].alias("turn"), F.md5("reponse_rag").alias("answer"),
        F.col("ground_truth").alias("truth"), F.md5("question_anglais").alias("quoted"))


@query("SELECT conv_id, true AS valid, count(*) AS n_ids, count(DISTINCT turn) AS n_distinct FROM conversations GROUP BY conv_id")
def new_session_ids(spark: SparkSession, folder: str) -> DataFrame:
    """A new session id for every message, all well formed and no two alike."""
    ids = messages(spark, folder).select("conv_id", session_id().alias("s"))
    return ids.groupBy("conv_id").agg(
        F.bool_and(is_session_id("s")).alias("valid"), F.count("s").alias("n_ids"), F.countDistinct("s").alias("n_distinct"))
