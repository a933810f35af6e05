"""Language, translation, model calls, metrics, aggregates and the gate."""

import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from askloom.catalog.base import (
    KEY, corpus_index, documents, messages, query, questions, sql_answers, sql_distinct_tokens,
    sql_round, sql_search, sql_sentences, sql_strip, sql_text, sql_vectors,
)
from askloom.config import LABEL_FAIL, LABEL_PASS
from askloom.functions.language import FRENCH_MARKERS, MIN_MARKERS, detect_language, french_markers
from askloom.functions.text import percent, round2
from askloom.functions.vectors import round_score
from askloom.operators import scoring
from askloom.operators.chat import question_answer_pairs
from askloom.operators.generation import failed, generate, succeeded, translate
from askloom.operators.embedding import hashing_embedder
from askloom.operators.metrics import (
    answer_relevancy, back_questions, faithfulness, judged, rounded, with_relevancy,
)
from askloom.plans.evaluate import gated_answers, score_answers
from askloom.session import cut_lineage, read_table, scratch_path
from askloom.sources.results import append_run, read_runs, run_record, write_report
from askloom.sources.results import evaluation_report as report


def _sql_markers(x: str) -> str:
    return " + ".join(f"CAST(contains(lower({x}), {sql_text(m)}) AS INTEGER)" for m in FRENCH_MARKERS)


def _sql_language(x: str) -> str:
    return f"CASE WHEN {_sql_markers(x)} >= {MIN_MARKERS} THEN 'fr' ELSE 'en' END"


@query(f"""SELECT doc_id, CAST({_sql_markers('text')} AS INTEGER) AS n_markers, {_sql_language('text')} AS language
           FROM documents""")
def document_languages(spark: SparkSession, folder: str) -> DataFrame:
    return documents(spark, folder, "doc_id", "text").select(
        "doc_id", french_markers("text").alias("n_markers"), detect_language("text").alias("language"))


@query(f"""SELECT item_id AS question_id, {_sql_language('text')} AS language FROM benchmark""")
def question_languages(spark: SparkSession, folder: str) -> DataFrame:
    return questions(spark, folder).select("question_id", detect_language("question").alias("language"))


def _quoting_translator():
    """Stands for a model: gives the question back in quotes and blanks."""
    return lambda prompts: [f' "{p}" ' for p in prompts]


def _quoted(x: str) -> str:
    stripped = sql_strip(f"(' \"' || {x} || '\" ')")
    return f"""trim(trim({stripped}, '"'), '''')"""


@query(f"""SELECT conv_id, turn, language, md5(CASE WHEN language = 'fr' THEN {_quoted('text')} ELSE text END) AS question_en
           FROM (SELECT *, {_sql_language('text')} AS language FROM conversations)""")
def translated_turns(spark: SparkSession, folder: str) -> DataFrame:
    done = translate(messages(spark, folder), _quoting_translator, question="text", template="{question}")
    return done.select("conv_id", "turn", "language", F.md5("question_en").alias("question_en"))


def _fragile_model():
    """Stands for a model: answers with the length, fails on exclamation marks."""

    def reply(prompts: list[str]) -> list[str]:
        if any("!" in p for p in prompts):
            raise ValueError("no reply")
        return [str(len(p)) for p in prompts]

    return reply


@query("""SELECT conv_id, turn, contains(text, '!') AS failed,
                 CASE WHEN contains(text, '!') THEN NULL ELSE CAST(length(text) AS VARCHAR) END AS answer,
                 CASE WHEN contains(text, '!') THEN 'ValueError: no reply' END AS error
          FROM conversations""")
def generated_answers(spark: SparkSession, folder: str) -> DataFrame:
    rows = generate(messages(spark, folder), "text", _fragile_model)
    return rows.select("conv_id", "turn", F.col("error").isNotNull().alias("failed"), "answer", "error")


@query("""SELECT role, CAST(count_if(NOT contains(text, '!')) AS BIGINT) AS n_kept, CAST(count_if(contains(text, '!')) AS BIGINT) AS n_failed
          FROM conversations GROUP BY role""")
def dropped_failures(spark: SparkSession, folder: str) -> DataFrame:
    rows = generate(messages(spark, folder), "text", _fragile_model)
    kept = succeeded(rows).select("role", F.lit(1).alias("k"), F.lit(0).alias("f"))
    lost = failed(rows).select("role", F.lit(0).alias("k"), F.lit(1).alias("f"))
    return kept.unionByName(lost).groupBy("role").agg(
        F.sum("k").cast("bigint").alias("n_kept"), F.sum("f").cast("bigint").alias("n_failed"))


_PAIRS = """SELECT conv_id, turn, question, answer FROM (
    SELECT conv_id, turn, role, text AS question, lead(role) OVER w AS next_role, lead(text) OVER w AS answer
    FROM conversations WHERE role <> 'system' WINDOW w AS (PARTITION BY conv_id ORDER BY turn))
    WHERE role = 'user' AND next_role = 'assistant'"""

_SUPPORTED = (f"len({sql_distinct_tokens('s')}) > 0 AND 2 * len(list_intersect({sql_distinct_tokens('s')}, known)) "
              f">= len({sql_distinct_tokens('s')})")


@query(f"""WITH pairs AS ({_PAIRS}),
    rows AS (SELECT conv_id, turn, {sql_distinct_tokens('question')} AS known,
                    {sql_sentences('answer')} AS st FROM pairs),
    judged AS (SELECT conv_id, turn, avg(CASE WHEN {_SUPPORTED} THEN 1.0 ELSE 0.0 END) AS f
               FROM (SELECT conv_id, turn, known, unnest(st) AS s FROM rows) GROUP BY conv_id, turn)
    SELECT conv_id, turn, {sql_round('f')} AS faithfulness
    FROM pairs LEFT JOIN judged USING (conv_id, turn)""")
def answer_faithfulness(spark: SparkSession, folder: str) -> DataFrame:
    """Replies judged against the question they answer."""
    pairs = question_answer_pairs(messages(spark, folder))
    return pairs.select(
        "conv_id", "turn", round_score(faithfulness("answer", F.array("question"))).alias("faithfulness"))


@query(f"""WITH pairs AS (SELECT conv_id || '/' || turn AS question_id, question,
                                 {sql_sentences('answer')}[1] AS made FROM ({_PAIRS})),
    q AS ({sql_vectors('pairs', 'question_id', 'question')}),
    a AS ({sql_vectors('pairs', 'question_id', 'made')}),
    qn AS (SELECT question_id, sqrt(sum(w * w)) AS norm FROM q GROUP BY 1),
    an AS (SELECT question_id, sqrt(sum(w * w)) AS norm FROM a GROUP BY 1),
    d AS (SELECT question_id, sum(q.w * a.w) AS dot FROM q JOIN a USING (question_id, b) GROUP BY 1)
    SELECT question_id, {sql_round('coalesce(dot, 0) / (qn.norm * an.norm)')} AS answer_relevancy
    FROM pairs LEFT JOIN qn USING (question_id) LEFT JOIN an USING (question_id) LEFT JOIN d USING (question_id)""")
def answer_relevancies(spark: SparkSession, folder: str) -> DataFrame:
    pairs = question_answer_pairs(messages(spark, folder)).withColumn(
        "question_id", F.concat_ws("/", "conv_id", "turn"))
    return rounded(answer_relevancy(pairs), "answer_relevancy")


# -- aggregates: labels stand for metric values ---------------------------------------

_SCORES = """SELECT doc_id, CASE WHEN quality = 1 THEN 1.0 - 0.25 * toxic END::DOUBLE AS f,
                    CASE WHEN toxic = 0 THEN 0.25 + 0.5 * quality END::DOUBLE AS r, n_chars / 1000.0 AS s
             FROM labels JOIN documents USING (doc_id)"""


def _label_scores(spark: SparkSession, folder: str) -> DataFrame:
    """Metric values with gaps, written as NaN in one metric and NULL in the other."""
    chars = documents(spark, folder, "doc_id", "n_chars")
    return read_table(spark, folder, "labels").join(chars, "doc_id").select(
        "doc_id",
        F.when(F.col("quality") == 1, 1.0 - 0.25 * F.col("toxic")).otherwise(F.lit("NaN").cast("double")).alias("faithfulness"),
        F.when(F.col("toxic") == 0, 0.25 + 0.5 * F.col("quality")).alias("answer_relevancy"),
        (F.col("n_chars") / 1000.0).alias("seconds"),
    )


_MEANS = f"""SELECT avg(f) AS f, avg(r) AS r, coalesce(avg(s), 0) AS s, count(*) AS n FROM ({_SCORES})"""


@query(f"""SELECT {sql_round('f')} AS faithfulness, {sql_round('r')} AS answer_relevancy,
                  {sql_round('s')} AS temps_moyen_reponse, n AS n_evaluated, {sql_round('(f + r) / 2')} AS score_global
           FROM ({_MEANS})""")
def mean_scores(spark: SparkSession, folder: str) -> DataFrame:
    means = scoring.mean_scores(_label_scores(spark, folder))
    return rounded(means, "faithfulness", "answer_relevancy", "temps_moyen_reponse", "score_global")


@query(f"""SELECT {sql_round('(f + r) / 2')} AS score_global, CAST(0.5 AS DOUBLE) AS threshold,
                  (f + r) / 2 >= 0.5 AS passed, CASE WHEN (f + r) / 2 >= 0.5 THEN '{LABEL_PASS}' ELSE '{LABEL_FAIL}' END AS qualite
           FROM ({_MEANS})""")
def quality_gate(spark: SparkSession, folder: str) -> DataFrame:
    gate = scoring.quality_gate(scoring.mean_scores(_label_scores(spark, folder)))
    return rounded(gate, "score_global").select("score_global", "threshold", "passed", "qualite")


@query(f"""SELECT 'eval_labels' AS run_name, unnest(['faithfulness', 'answer_relevancy', 'score_global', 'temps_moyen_reponse']) AS metric,
                  unnest([{sql_round('f')}, {sql_round('r')}, {sql_round('(f + r) / 2')}, {sql_round('s')}]) AS value,
                  CAST(n AS VARCHAR) AS n_evaluated, CASE WHEN (f + r) / 2 >= 0.5 THEN '{LABEL_PASS}' ELSE '{LABEL_FAIL}' END AS qualite
           FROM ({_MEANS})""")
def run_log(spark: SparkSession, folder: str) -> DataFrame:
    """A run record written, read back and laid out by metric."""
    path = scratch_path(spark, "runs")
    gate = scoring.quality_gate(scoring.mean_scores(_label_scores(spark, folder))).head().asDict()
    metrics = ("faithfulness", "answer_relevancy", "score_global", "temps_moyen_reponse")
    append_run(run_record(
        spark, "eval_labels", {"nb_questions_evaluees": gate["n_evaluated"]}, {m: gate[m] for m in metrics},
        {"qualite": gate["qualite"]}, "none"), path)
    return read_runs(spark, path).select(
        "run_name", F.explode("metrics").alias("metric", "value"),
        F.col("params")["nb_questions_evaluees"].alias("n_evaluated"), F.col("tags")["qualite"].alias("qualite"),
    ).withColumn("value", round_score("value"))


@query(f"""SELECT {sql_round('f')} AS faithfulness, {sql_round('r')} AS answer_relevancy,
                  {sql_round('t')} AS execution_time, 'completed' AS status
           FROM ({_MEANS}), (SELECT sum(s) AS t FROM ({_SCORES}))""")
def evaluation_report(spark: SparkSession, folder: str) -> DataFrame:
    """The seconds of all rows together stand for the time of the run."""
    scores = _label_scores(spark, folder)
    gate = scoring.quality_gate(scoring.mean_scores(scores))
    path = scratch_path(spark, "report")
    write_report(report(gate, scores.agg(F.sum("seconds")).head()[0]), path)
    stored = spark.read.schema("faithfulness double, answer_relevancy double, execution_time double, status string").json(path)
    return rounded(stored, "faithfulness", "answer_relevancy", "execution_time")


@query(f"""SELECT doc_id, coalesce(f >= 0.8, false) AS passed FROM ({_SCORES})""")
def threshold_check(spark: SparkSession, folder: str) -> DataFrame:
    scores = _label_scores(spark, folder)
    return scores.select("doc_id", scoring.meets("faithfulness", 0.8).alias("passed"))


_UNPIVOTED = f"""SELECT 'faithfulness' AS metric, f AS v FROM ({_SCORES})
                 UNION ALL SELECT 'answer_relevancy', r FROM ({_SCORES})
                 UNION ALL SELECT 'seconds', s FROM ({_SCORES})"""


@query(f"""SELECT metric, {sql_round('avg(v)')} AS avg_value, {sql_round('min(v)')} AS min_value,
                  {sql_round('max(v)')} AS max_value FROM ({_UNPIVOTED}) GROUP BY metric""")
def metric_summary(spark: SparkSession, folder: str) -> DataFrame:
    summary = scoring.metric_summary(
        _label_scores(spark, folder), "faithfulness", "answer_relevancy", "seconds")
    return rounded(summary, "avg_value", "min_value", "max_value")


@query(f"""SELECT metric, count(v) AS n_values, CAST(count_if(v >= 0.5) AS BIGINT) AS n_passed,
                  bool_and(v BETWEEN 0 AND 1) AS in_range FROM ({_UNPIVOTED}) GROUP BY metric""")
def metric_checks(spark: SparkSession, folder: str) -> DataFrame:
    known = _label_scores(spark, folder).withColumn(
        "faithfulness", F.nanvl("faithfulness", F.lit(None).cast("double")))
    return scoring.metric_checks(known, "faithfulness", "answer_relevancy", "seconds")


@query(f"""SELECT language, count(*) AS n_total, CAST(count_if(NOT off_topic AND NOT failed) AS BIGINT) AS n_evaluated,
                  CAST(count_if(NOT off_topic AND failed) AS BIGINT) AS n_failed, CAST(count_if(off_topic) AS BIGINT) AS n_ignored
           FROM (SELECT {_sql_language('text')} AS language, length({sql_strip('text')}) < 50 AS off_topic,
                        contains(text, '!') AS failed FROM documents)
           GROUP BY ROLLUP (language)""")
def question_counts(spark: SparkSession, folder: str) -> DataFrame:
    """Documents stand for questions; short ones are off topic, exclamations failed."""
    rows = documents(spark, folder, "text").select(
        detect_language("text").alias("language"),
        (F.char_length(F.btrim("text")) < 50).alias("off_topic"),
        F.when(F.contains("text", F.lit("!")), "failed").alias("error"))
    return scoring.question_counts(rows)


@query("""SELECT doc_id, printf('%.2f%%', 100 * n_chars / 32768.0) AS share, round(n_chars / 1024.0, 2) AS kb
          FROM documents""")
def formatted_shares(spark: SparkSession, folder: str) -> DataFrame:
    return documents(spark, folder, "doc_id", "n_chars").select(
        "doc_id", percent(F.col("n_chars") / 32768.0).alias("share"), round2(F.col("n_chars") / 1024.0).alias("kb"))


@query(f"""WITH {sql_search()}, {sql_answers()} SELECT md5(question) AS question_originale,
                  md5(question) AS question_anglais, md5('') AS ground_truth,
                  md5(CASE WHEN length({sql_strip('t.text')}) >= 50 THEN answer ELSE '' END) AS reponse_rag
           FROM answers LEFT JOIN (SELECT question_id, text FROM texts WHERE rank = 1) t USING (question_id)""")
def result_table(spark: SparkSession, folder: str) -> DataFrame:
    """The result table of the evaluate flow without a translator."""
    asked = questions(spark, folder).withColumn("ground_truth", F.lit(""))
    gated = gated_answers(asked, corpus_index(spark, folder), key=KEY)
    rows = scoring.result_rows(gated.withColumn("answer", F.coalesce("answer", F.lit(""))))
    return rows.select([F.md5(c).alias(c) for c in rows.columns])


_ASKED = "CASE WHEN role = 'user' THEN 'quel est le sens de la phrase ' || text ELSE text END"


@query(f"""SELECT md5(q) AS question_originale, md5(CASE WHEN {_sql_language('q')} = 'fr' THEN '« ' || q || ' »' ELSE q END) AS question_anglais,
                  role AS reponse_rag, conv_id || '/' || turn AS ground_truth
           FROM (SELECT *, {_ASKED} AS q FROM conversations)""")
def translated_results(spark: SparkSession, folder: str) -> DataFrame:
    """The result table of translated questions, each with a truth of its own."""
    asked = messages(spark, folder).select(
        F.expr(_ASKED).alias("question"), F.col("role").alias("answer"), F.concat_ws("/", "conv_id", "turn").alias("ground_truth"))
    rows = scoring.result_rows(translate(asked, _quoting_translator, template="« {question} »"))
    return rows.withColumns({c: F.md5(c) for c in ("question_originale", "question_anglais")})


_KNOWN = f"{sql_distinct_tokens('array_to_string(contexts, chr(10))')}"


@query(f"""WITH {sql_search()}, {sql_answers()},
    gated AS (SELECT a.*, contexts, t.text IS NULL OR length({sql_strip('t.text')}) < 50 AS off_topic
              FROM answers a LEFT JOIN contexts USING (question_id)
              LEFT JOIN (SELECT question_id, text FROM texts WHERE rank = 1) t USING (question_id)),
    rows AS (SELECT * FROM gated WHERE NOT off_topic),
    judged AS (SELECT question_id, avg(CASE WHEN {_SUPPORTED} THEN 1.0 ELSE 0.0 END) AS f
               FROM (SELECT question_id, {_KNOWN} AS known, unnest({sql_sentences('answer')}) AS s FROM rows)
               GROUP BY question_id),
    made AS (SELECT question_id, {sql_sentences('answer')}[1] AS made FROM rows),
    a AS ({sql_vectors('made', 'question_id', 'made')}),
    an AS (SELECT question_id, sqrt(sum(w * w)) AS norm FROM a GROUP BY 1),
    d AS (SELECT question_id, sum(q.w * a.w) AS dot FROM qvec q JOIN a USING (question_id, b) GROUP BY 1),
    rel AS (SELECT question_id, coalesce(dot, 0) / (qnorm.norm * an.norm) AS r
            FROM rows JOIN qnorm USING (question_id) JOIN an USING (question_id) LEFT JOIN d USING (question_id)),
    means AS (SELECT avg(f) AS f, avg(r) AS r, count(*) AS n
              FROM rows LEFT JOIN judged USING (question_id) LEFT JOIN rel USING (question_id))
    SELECT {sql_round('f')} AS faithfulness, {sql_round('r')} AS answer_relevancy, n AS n_evaluated,
           {sql_round('(f + r) / 2')} AS score_global, coalesce((f + r) / 2 >= 0.5, false) AS passed FROM means""")
def evaluated_benchmark(spark: SparkSession, folder: str) -> DataFrame:
    """The whole evaluate flow with its defaults: all benchmark questions, all documents."""
    asked = questions(spark, folder).withColumn("ground_truth", F.lit(""))
    rows = score_answers(gated_answers(asked, corpus_index(spark, folder), key=KEY))
    gate = scoring.quality_gate(scoring.mean_scores(rows))
    return rounded(gate, "faithfulness", "answer_relevancy", "score_global").select(
        "faithfulness", "answer_relevancy", "n_evaluated", "score_global", "passed")


def _failing_judge():
    """Stands for a judge that fails on answers with an odd number of statements."""

    def decide(statements, contexts):
        if len(statements) % 2:
            raise RuntimeError("odd")
        return [True] * len(statements)

    return decide


@query(f"""SELECT doc_id, CASE WHEN len(st) > 0 AND len(st) % 2 = 0 THEN 1.0 END AS share,
                  CASE WHEN len(st) % 2 = 1 THEN 'RuntimeError: odd' END AS error
           FROM (SELECT doc_id, {sql_sentences('text')} AS st FROM documents)""")
def failed_judgements(spark: SparkSession, folder: str) -> DataFrame:
    """A judge that fails leaves NULL and its message, and the other rows their shares."""
    rows = documents(spark, folder, "doc_id", "text")
    return rows.select("doc_id", judged("text", F.array("text"), _failing_judge).alias("j")).select("doc_id", "j.share", "j.error")


def _hanging(*_):
    """Stands for a model that never replies in time."""
    time.sleep(60)


@query(f"""SELECT conv_id, turn, question AS worded, len({sql_sentences('answer')}) > 0 AS stopped,
                  CAST(NULL AS DOUBLE) AS share, CAST(NULL AS DOUBLE) AS answer_relevancy, true AS in_time FROM ({_PAIRS})""")
def hanging_hooks(spark: SparkSession, folder: str) -> DataFrame:
    """A translator, a judge and a maker of back-questions that all hang: rows without their
    results, in a time that does not grow with the rows."""
    pairs = question_answer_pairs(messages(spark, folder)).repartition(spark.sparkContext.defaultParallelism)
    worded = translate(pairs, lambda: _hanging, out="worded", template="{question}", time_limit=0.25)
    scored = with_relevancy(worded, generated=back_questions("answer", lambda: _hanging, n=2, time_limit=0.25))
    started = time.perf_counter()
    rows = cut_lineage(scored.withColumn("_j", judged("answer", F.array("question"), lambda: _hanging, 0.25)))
    # Three hooks, three calls each before they are given up, twice the limit a call, two rounds of tasks.
    in_time = time.perf_counter() - started < 120
    return rows.select("conv_id", "turn", "worded", F.col("_j.error").isNotNull().alias("stopped"), "_j.share",
                       "answer_relevancy", F.lit(in_time).alias("in_time"))


def _failing_embedder():
    """Stands for a model that fails on texts whose length five divides."""
    model = hashing_embedder()()

    def embed(texts):
        if any(len(t) % 5 == 0 for t in texts):
            raise RuntimeError("five")
        return model(texts)

    return embed


@query(f"""WITH {sql_search()},
    gated AS (SELECT question_id, length(question) % 5 = 0 AS failed,
                     t.text IS NULL OR length({sql_strip('t.text')}) < 50 AS off
              FROM asked LEFT JOIN (SELECT question_id, text FROM texts WHERE rank = 1) t USING (question_id))
    SELECT question_id, NOT failed AND off AS off_topic, CASE WHEN failed THEN 'RuntimeError: five' END AS error,
           NOT failed AND NOT off AS answered FROM gated""")
def failed_retrievals(spark: SparkSession, folder: str) -> DataFrame:
    """A question that cannot be embedded counts as on topic and as failed; the others are answered."""
    gated = gated_answers(questions(spark, folder), corpus_index(spark, folder), embedder=_failing_embedder, key=KEY)
    return gated.select("question_id", "off_topic", "error", F.col("answer").isNotNull().alias("answered"))
