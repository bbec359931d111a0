"""From raw documents to token ids: quality, near duplicates, mixture and encoding.

Each stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame; all but the last return the columns of
``documents``, further ones included. Between stages the rows are written as Parquet and read again. An empty table
stays empty in every stage.
"""

from __future__ import annotations

from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clearspan.llm import bpe, classifier, minhash, mixing, rules
from clearspan.llm.common import prepare
from clearspan.llm.queries import vocabulary_path
from clearspan.session import scratch_path

#: No SQL states the classifier, the links or the token ids; the stages are tested against brute force instead.
ORACLE_SQL = None


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier, trained on the labels, does not reject.

    Rows are judged each: repeated ones alike, null and empty texts by features that are 0. Ids may be null or repeated.
    """
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return classifier.accepted(docs, classifier.train(docs, labels))


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and are good by the votes of the rules.

    Rows are judged each; null and empty texts have no words and go.
    """
    return rules.accepted(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates: the one of the smallest id, null last, ties by the digest of the text.

    Of rows alike in id and text one stays; unlike texts of one id are told apart; rows without words all stay.
    """
    return minhash.deduplicated(docs)


def source_mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them, in training order.

    A null source is a source; rows without words are never taken; rows alike in id, source and text are taken in any order.
    """
    return mixing.mixed_documents(docs)


def bpe_encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """``doc_id, n_tokens, ids, text``: the token ids and the text they decode to, row by row; a null text is empty."""
    both = bpe.round_trip(docs, vocabulary_path())
    return both.select("doc_id", F.size("ids").cast("bigint").alias("n_tokens"), "ids", "text")


def _prepared(stage):
    """The stage, in a session that is ready for it."""

    @wraps(stage)
    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        prepare(spark)
        return stage(spark, docs, sf_dir)

    return run_stage


STAGES = [
    ("quality classifier", _prepared(quality_classifier)),
    ("quality rules", _prepared(quality_rules)),
    ("near duplicates", _prepared(near_duplicates)),
    ("source mixing", _prepared(source_mixing)),
    ("bpe encoding", _prepared(bpe_encoding)),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        path = scratch_path(spark, name.replace(" ", "-"))
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)
