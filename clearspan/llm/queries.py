"""One registered query per operator, over its whole table, and SQL where SQL can express it."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clearspan.llm import bpe, classifier, conversations, extraction, fptree, langid, minhash, mixing, ordered_minhash, ppm, rules, sharding, sql, urls
from clearspan.llm.common import prepare

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

#: Rules of the URL query.
URL_RULES = [
    ("net", "/", "block"),
    ("example.net", "/en/", "allow"),
    ("example.com", "/de/", "block"),
    ("org", "/fr/", "allow"),
]
SHARD_WEIGHTS = [1.0] * 8
VOCABULARY = "byte_bpe_50k.json"


def vocabulary_path() -> str:
    import public_tokenizers

    return public_tokenizers.path(VOCABULARY)


def query(fn: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    @wraps(fn)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        prepare(spark)
        return fn(spark, sf_dir)

    QUERIES[fn.__name__] = run
    if fn.__name__ in sql.ORACLES:
        ORACLES[fn.__name__] = sql.ORACLES[fn.__name__]
    return run


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query
def op1_minhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(table(spark, sf_dir, "documents"))


@query
def op2_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return classifier.score_documents(docs, classifier.train(docs, table(spark, sf_dir, "labels")))


@query
def op3_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = rules.judge_documents(table(spark, sf_dir, "documents"))
    return judged.drop("quality")


@query
def op4_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = extraction.extract_pages(table(spark, sf_dir, "pages"))
    return text.select("page_id", "url", "text", F.length("text").cast("bigint").alias("n_chars"))


@query
def op5_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix(table(spark, sf_dir, "documents"))
    first = F.get("passes", F.lit(0))["position"]
    ordered = mixed.withColumn("__first", first).repartitionByRange("__first", "doc_id").sortWithinPartitions("__first", "doc_id")
    return ordered.select("doc_id", "size", "source_size", "target", "taken")


@query
def op6_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.place(table(spark, sf_dir, "documents"), SHARD_WEIGHTS)


@query
def op7_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urls.judge_urls(table(spark, sf_dir, "pages"), urls.rules_table(spark, URL_RULES))


@query
def op8_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    both = bpe.round_trip(table(spark, sf_dir, "documents"), vocabulary_path())
    ids = F.array_join(F.col("ids").cast("array<string>"), ",")
    return both.select(
        "doc_id",
        F.size("ids").cast("bigint").alias("n_tokens"),
        F.sha2(ids, 256).alias("ids_sha256"),
        F.sha2(F.encode("text", "UTF-8"), 256).alias("decoded_sha256"),
    )


@query
def op9_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    counts = ppm.trained(docs.where(~ppm.held_out(F.col("doc_id"))))
    scored = ppm.score_texts(docs, counts)
    return scored.select("doc_id", ppm.held_out(F.col("doc_id")).alias("held_out"), *scored.columns[1:])


@query
def op10_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ordered_minhash.edited_fingerprints(table(spark, sf_dir, "documents"))


@query
def op11_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fptree.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query
def op12_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversations.repair(conversations.damaged(table(spark, sf_dir, "conversations")))


@query
def op13_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return langid.predict_languages(docs, langid.train(docs.where(~langid.held_out(F.col("doc_id")))))
