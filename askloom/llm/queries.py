"""The registered queries of the operators, with the SQL that gives the same rows where SQL can."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from askloom.llm import oracles
from askloom.llm.decontamination import contaminated
from askloom.llm.filter_audit import audit_filters
from askloom.llm.frames import held_out, read
from askloom.llm.grid_order import link_vectors
from askloom.llm.jaccard import jaccard_components
from askloom.llm.mixing import mix_sources
from askloom.llm.prefix_trie import prefix_trie
from askloom.llm.quality import score_quality, train_quality
from askloom.llm.secrets import names, scan_secrets
from askloom.llm.suffix_dedup import remove_repeats
from askloom.llm.suffix_tree_lm import learn, score_texts
from askloom.llm.toxicity import score_toxicity, train_toxicity
from askloom.llm.url_reputation import Rule, judge_pages
from askloom.llm.window_sketch import remove_repeated_words

#: Fixed values of the contract: rules for URLs, weights of sources.
RULES = (Rule("allow", "com/"), Rule("block", "example.com/en/"), Rule("allow", "www.example.com/en/"),
         Rule("block", "net/es/"), Rule("block", "net/fr/"))
WEIGHTS = (5, 2, 1)


def op1_suffix_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return remove_repeats(read(spark, folder, "documents"))


def op2_url_reputation(spark: SparkSession, folder: str) -> DataFrame:
    """Pages have no outcomes of their own: the quality label of the same number is taken for it."""
    labels = read(spark, folder, "labels").select(
        F.col("doc_id").alias("page_id"), (F.col("quality") == 1).alias("good"))
    judged = judge_pages(read(spark, folder, "pages"), labels, RULES)
    return judged.select("page_id", "host", "path", "rule", "verdict")


def op3_jaccard_join(spark: SparkSession, folder: str) -> DataFrame:
    return jaccard_components(read(spark, folder, "documents")).select("doc_id", "n_shingles", "component_id")


def op4_source_mix(spark: SparkSession, folder: str) -> DataFrame:
    return mix_sources(read(spark, folder, "documents"), WEIGHTS)


def op5_suffix_tree_lm(spark: SparkSession, folder: str) -> DataFrame:
    documents = read(spark, folder, "documents")
    tree, vocabulary = learn(documents.where(~held_out("doc_id", 10, 0)))
    return score_texts(documents, tree, vocabulary).select(
        "doc_id", held_out("doc_id", 10, 0).alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")


def op6_secret_scan(spark: SparkSession, folder: str) -> DataFrame:
    """The source is the owner; its documents in one language are a repository."""
    found = scan_secrets(read(spark, folder, "documents").select(
        "doc_id", F.col("source").alias("owner"), F.concat_ws("/", "source", "lang").alias("repo"), "text"))

    def number(rank: int):
        return F.size(F.filter("base", lambda s: s["rank"] == rank)).cast("long")

    return found.select(
        "doc_id", number(0).alias("n_assign"), number(1).alias("n_access"), number(2).alias("n_hex"),
        F.sha2(names(F.col("base")), 256).alias("base_sha256"),
        names(F.sort_array(F.concat("base", "added"))).alias("spans"), "n_shared", "most_owners", "most_repos",
        F.size("added").cast("long").alias("n_added"))


def training_labels(spark: SparkSession, folder: str, name: str, folds: int, part: int) -> DataFrame:
    """doc_id and label of the rows that learning may see."""
    return read(spark, folder, "labels").where(~held_out("doc_id", folds, part)).select("doc_id", F.col(name).alias("label"))


def op7_quality_ranking(spark: SparkSession, folder: str) -> DataFrame:
    documents = read(spark, folder, "documents")
    model = train_quality(documents, training_labels(spark, folder, "quality", 4, 2))
    return score_quality(documents, model).select("doc_id", held_out("doc_id", 4, 2).alias("held_out"), "score", "predicted")


def op8_toxic_sentences(spark: SparkSession, folder: str) -> DataFrame:
    documents = read(spark, folder, "documents")
    model = train_toxicity(documents, training_labels(spark, folder, "toxic", 3, 1))
    scored = score_toxicity(documents, model)
    return scored.withColumn("held_out", held_out("doc_id", 3, 1)).select(
        "doc_id", "held_out", "score", "predicted", "n_sentences", "worst_start", "worst_end", "worst_score")


def op9_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    return contaminated(read(spark, folder, "documents"), read(spark, folder, "benchmark"))


def op10_embedding_links(spark: SparkSession, folder: str) -> DataFrame:
    return link_vectors(read(spark, folder, "embeddings"))


def op11_filter_audit(spark: SparkSession, folder: str) -> DataFrame:
    return audit_filters(read(spark, folder, "documents"), read(spark, folder, "labels"))


def op12_prefix_trie(spark: SparkSession, folder: str) -> DataFrame:
    return prefix_trie(read(spark, folder, "conversations"))


def op13_window_sketch(spark: SparkSession, folder: str) -> DataFrame:
    return remove_repeated_words(read(spark, folder, "documents"))


QUERIES = {f.__name__: f for f in (
    op1_suffix_dedup, op2_url_reputation, op3_jaccard_join, op4_source_mix, op5_suffix_tree_lm,
    op6_secret_scan, op7_quality_ranking,
    op8_toxic_sentences, op9_decontamination, op10_embedding_links, op11_filter_audit, op12_prefix_trie,
    op13_window_sketch)}
ORACLE_SQL: dict[str, str] = {
    "op2_url_reputation": oracles.url_rules(RULES),
    "op3_jaccard_join": oracles.JACCARD,
    "op6_secret_scan": oracles.secret_spans(),
    "op9_decontamination": oracles.CONTAINMENT,
    "op10_embedding_links": oracles.EMBEDDINGS,
    "op11_filter_audit": oracles.FILTER_AUDIT,
    "op12_prefix_trie": oracles.PREFIX_TRIE,
    "op13_window_sketch": oracles.WINDOWS,
}
