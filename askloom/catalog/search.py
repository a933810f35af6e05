"""Similarity search and everything built on its hits."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from askloom.catalog.base import (
    KEY, corpus_index, documents, embedded_questions, query, questions, search_hits, sql_answers,
    sql_distinct_tokens, sql_round, sql_search, sql_strip, sql_text,
)
from askloom.config import EMBEDDING_DIM, PROMPT_TEMPLATE
from askloom.functions.vectors import round_score
from askloom.operators.citations import distinct_sources, file_label, page_label
from askloom.operators.generation import extractive_answer
from askloom.operators.hits import gather_hits, or_no_sources
from askloom.operators.metrics import context_relevancy
from askloom.operators.prompts import assemble_contexts, default_contexts, prompt
from askloom.operators.retrieval import best_hit, off_topic_gate, top_k
from askloom.session import cut_lineage, read_table, scratch_path
from askloom.sources.index import append_index, read_index, write_index

_CENTROID_HITS = f"""
    WITH parts AS (SELECT vec_id, label, unnest(embedding)::DOUBLE AS x,
                          generate_subscripts(embedding, 1) AS pos FROM embeddings),
    centroids AS (SELECT label, pos, avg(x) AS c FROM parts GROUP BY label, pos),
    cnorm AS (SELECT label, sqrt(sum(c * c)) AS norm FROM centroids GROUP BY label),
    vnorm AS (SELECT vec_id, sqrt(sum(x * x)) AS norm FROM parts GROUP BY vec_id),
    scored AS (SELECT q.label, v.vec_id, {sql_round('sum(q.c * v.x) / (any_value(cn.norm) * any_value(vn.norm))')} AS score
               FROM centroids q JOIN parts v USING (pos) JOIN cnorm cn ON cn.label = q.label
               JOIN vnorm vn ON vn.vec_id = v.vec_id GROUP BY q.label, v.vec_id)
    SELECT label AS question_id, vec_id, score, CAST(row_number() OVER (
               PARTITION BY label ORDER BY score DESC, vec_id) AS INTEGER) AS rank
    FROM scored QUALIFY rank <= 6"""


def _centroids(spark: SparkSession, folder: str) -> DataFrame:
    """Mean vector per label.  The means are partial aggregates per (label, position); what
    is collected per label has the length of a vector."""
    parts = read_table(spark, folder, "embeddings").select(
        "label", F.posexplode("embedding").alias("at", "x"))
    means = parts.groupBy("label", "at").agg(F.avg("x").alias("c"))
    return means.groupBy(F.col("label").alias("question_id")).agg(
        F.transform(F.sort_array(F.collect_list(F.struct("at", "c"))), lambda p: p["c"]).alias("embedding"))


@query(_CENTROID_HITS)
def top_vectors(spark: SparkSession, folder: str) -> DataFrame:
    """The six vectors nearest to the mean vector of every label."""
    index = read_table(spark, folder, "embeddings", "vec_id", "embedding")
    return top_k(_centroids(spark, folder), index, key=["vec_id"])


@query(f"SELECT question_id, vec_id, score FROM ({_CENTROID_HITS}) WHERE rank = 1")
def best_vector(spark: SparkSession, folder: str) -> DataFrame:
    return best_hit(top_vectors(spark, folder))


_HITS = f"WITH {sql_search()} SELECT question_id, doc_id, chunk_no, score, rank FROM hits"


@query(_HITS)
def text_search(spark: SparkSession, folder: str) -> DataFrame:
    return top_k(embedded_questions(spark, folder), corpus_index(spark, folder), key=KEY)


@query(_HITS)
def text_search_in_blocks(spark: SparkSession, folder: str) -> DataFrame:
    """Three portions of questions, a scan of the written index for each, several blocks in each."""
    asked = embedded_questions(spark, folder)
    third = -(-asked.select("question_id").count() // 3)
    return top_k(asked, cut_lineage(corpus_index(spark, folder)), key=KEY,
                 max_broadcast_bytes=8 * EMBEDDING_DIM * third, questions_per_block=16)


@query(f"""WITH {sql_search()} SELECT question_id, doc_id, chunk_no, score, CAST(4 AS BIGINT) AS n FROM hits""")
def repeated_questions(spark: SparkSession, folder: str) -> DataFrame:
    """Every question asked twice, in one block and in several: each row has its own hits."""
    asked = embedded_questions(spark, folder)
    asked, index = asked.unionByName(asked), cut_lineage(corpus_index(spark, folder))
    hits = [top_k(asked, index, key=KEY, questions_per_block=rows) for rows in (10**6, 16)]
    return hits[0].unionByName(hits[1]).groupBy("question_id", "doc_id", "chunk_no", "score").agg(
        F.count(F.lit(1)).alias("n"))


@query(f"""WITH {sql_search()} SELECT question_id, score, CAST(2 * rank - twice AS INTEGER) AS rank
           FROM hits, (SELECT unnest([0, 1]) AS twice) WHERE rank <= 3""")
def stored_search(spark: SparkSession, folder: str) -> DataFrame:
    """Written, appended once more, read and searched: every chunk is there twice, and both are hits."""
    path, rows = scratch_path(spark, "index"), corpus_index(spark, folder)
    write_index(rows, path)
    append_index(rows, path)
    index = read_index(spark, path, schema=rows.schema)
    return top_k(embedded_questions(spark, folder), index).select("question_id", "score", "rank")


@query(f"""WITH {sql_search()} SELECT question_id, rank, doc_id, chunk_no, source, md5(text) AS digest
           FROM texts""")
def hydrated_hits(spark: SparkSession, folder: str) -> DataFrame:
    return search_hits(spark, folder).select(
        "question_id", "rank", "doc_id", "chunk_no", "source", F.md5("text").alias("digest"))


@query(f"""WITH {sql_search()} SELECT question_id, coalesce(length({sql_strip('text')}) < 50, true) AS off_topic
           FROM asked LEFT JOIN (SELECT * FROM texts WHERE rank = 1) USING (question_id)""")
def off_topic_questions(spark: SparkSession, folder: str) -> DataFrame:
    gated = off_topic_gate(questions(spark, folder), search_hits(spark, folder))
    return gated.select("question_id", "off_topic")


@query(f"""WITH {sql_search()} SELECT question_id, CAST(len(contexts) AS INTEGER) AS n_contexts,
                  md5(array_to_string(contexts, chr(10) || chr(10))) AS digest FROM contexts""")
def assembled_contexts(spark: SparkSession, folder: str) -> DataFrame:
    contexts = assemble_contexts(search_hits(spark, folder))
    return contexts.select(
        "question_id", F.size("contexts").alias("n_contexts"),
        F.md5(F.array_join("contexts", "\n\n")).alias("digest"))


@query("""SELECT doc_id, CASE WHEN length(text) >= 500 THEN md5(text) ELSE md5('') END AS digest
          FROM documents""")
def defaulted_contexts(spark: SparkSession, folder: str) -> DataFrame:
    """Documents under 500 characters have no context here and get the empty one."""
    docs = documents(spark, folder, "doc_id", "text")
    found = F.filter(F.array("text"), lambda t: F.char_length(t) >= 500)
    return docs.select("doc_id", F.md5(F.array_join(default_contexts(found), "|")).alias("digest"))


@query(f"""WITH {sql_search()} SELECT question_id, source AS file, '—' AS page, CAST(min(rank) AS INTEGER) AS rank
           FROM texts GROUP BY question_id, source""")
def source_list(spark: SparkSession, folder: str) -> DataFrame:
    return distinct_sources(search_hits(spark, folder)).select("question_id", "file", "page", "rank")


@query(f"""WITH {sql_search()}, {sql_answers()} SELECT question_id, md5(answer) AS digest FROM answers""")
def extractive_answers(spark: SparkSession, folder: str) -> DataFrame:
    asked = questions(spark, folder).join(
        assemble_contexts(search_hits(spark, folder)), "question_id", "left")
    answers = asked.withColumn("answer", extractive_answer("question", default_contexts("contexts")))
    return answers.select("question_id", F.md5("answer").alias("digest"))


@query(f"""
    WITH {sql_search()}, {sql_answers()},
    shown AS (SELECT question_id, source, rank, {sql_strip('substr(text, 1, 400)')}
                     || CASE WHEN length(text) > 400 THEN '...' ELSE '' END AS excerpt
              FROM texts QUALIFY row_number() OVER (PARTITION BY question_id, source ORDER BY rank) = 1),
    listed AS (SELECT question_id, count(*) AS n, string_agg(source || ' — ' || excerpt, '|' ORDER BY rank) AS s
               FROM shown GROUP BY question_id)
    SELECT question_id, md5(answer) AS answer, CAST(coalesce(n, 0) AS INTEGER) AS n_sources,
           md5(coalesce(s, '')) AS sources
    FROM answers LEFT JOIN listed USING (question_id)""")
def answers_with_sources(spark: SparkSession, folder: str) -> DataFrame:
    asked = questions(spark, folder).join(gather_hits(search_hits(spark, folder)), "question_id", "left")
    answers = asked.withColumn("answer", extractive_answer("question", default_contexts("contexts")))
    shown = F.transform(or_no_sources(), lambda s: F.concat_ws(" ", s["source"], s["page"], s["excerpt"]))
    return answers.select(
        "question_id", F.md5("answer").alias("answer"), F.size(or_no_sources()).alias("n_sources"),
        F.md5(F.array_join(shown, "|")).alias("sources"))


def _sql_prompt() -> str:
    parts = {"context": "coalesce(array_to_string(contexts, chr(10) || chr(10)), '')",
             "chat_history": "''", "question": "question"}
    out, rest = [], PROMPT_TEMPLATE
    for name in ("context", "chat_history", "question"):
        head, rest = rest.split("{%s}" % name, 1)
        out += [sql_text(head), parts[name]]
    return " || ".join([*out, sql_text(rest)])


@query(f"""WITH {sql_search()} SELECT question_id, CAST(length({_sql_prompt()}) AS INTEGER) AS n_chars,
                  md5({_sql_prompt()}) AS digest FROM asked LEFT JOIN contexts USING (question_id)""")
def filled_prompts(spark: SparkSession, folder: str) -> DataFrame:
    asked = questions(spark, folder).join(
        assemble_contexts(search_hits(spark, folder)), "question_id", "left")
    filled = asked.select("question_id", prompt("question", default_contexts("contexts")).alias("p"))
    return filled.select("question_id", F.char_length("p").alias("n_chars"), F.md5("p").alias("digest"))


@query(f"""WITH {sql_search()}
    SELECT question_id, {sql_round(
        f"len(list_intersect({sql_distinct_tokens('question')}, "
        f"{sql_distinct_tokens('array_to_string(contexts, chr(10))')})) "
        f"/ len({sql_distinct_tokens('question')})")} AS relevancy
    FROM (SELECT question_id, question, coalesce(contexts, ['']) AS contexts
          FROM asked LEFT JOIN contexts USING (question_id))""")
def context_relevancies(spark: SparkSession, folder: str) -> DataFrame:
    asked = questions(spark, folder).join(assemble_contexts(search_hits(spark, folder)), "question_id", "left")
    return asked.select("question_id", round_score(
        context_relevancy("question", default_contexts("contexts"))).alias("relevancy"))


@query(f"""WITH {sql_search()}, {sql_answers()}
    SELECT question_id, md5(a.question) AS question, md5(a.answer) AS answer,
           md5(array_to_string(coalesce(contexts, ['']), '|')) AS contexts, md5(d.text) AS ground_truth
    FROM answers a LEFT JOIN contexts USING (question_id) LEFT JOIN documents d ON d.doc_id = a.question_id""")
def aligned_results(spark: SparkSession, folder: str) -> DataFrame:
    """Question, answer, contexts and truth joined by id; here the truth is the document of
    the same number."""
    asked = questions(spark, folder)
    truth = documents(spark, folder, "doc_id", "text").withColumnsRenamed(
        {"doc_id": "question_id", "text": "ground_truth"})
    rows = asked.join(assemble_contexts(search_hits(spark, folder)), "question_id", "left").join(
        truth, "question_id", "left").withColumn("contexts", default_contexts("contexts"))
    rows = rows.withColumn("answer", extractive_answer("question", "contexts"))
    return rows.select(
        "question_id", F.md5("question").alias("question"), F.md5("answer").alias("answer"),
        F.md5(F.array_join("contexts", "|")).alias("contexts"), F.md5("ground_truth").alias("ground_truth"))


@query("""SELECT doc_id, CASE WHEN lang = 'de' THEN 'unknown' ELSE source || '.txt' END AS file,
                 CASE WHEN lang = 'fr' THEN '—' ELSE CAST(n_chars % 100 AS VARCHAR) END AS page
          FROM documents""")
def defaulted_metadata(spark: SparkSession, folder: str) -> DataFrame:
    """Source missing for German documents, page missing for French ones."""
    docs = documents(spark, folder, "doc_id", "lang", "source", "n_chars").select(
        "doc_id",
        F.when(F.col("lang") != "de", F.concat(F.lit("/corpus/"), "lang", F.lit("/"), "source", F.lit(".txt"))).alias("source"),
        F.when(F.col("lang") != "fr", F.col("n_chars") % 100).alias("page"))
    return docs.select("doc_id", file_label().alias("file"), page_label().alias("page"))
