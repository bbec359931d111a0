"""Shards by rendezvous hashing of a stable record key.

Every key has a score for every shard that depends on the key, the shard and the shard's weight alone;
the shard with the least score takes the key. One more shard therefore takes keys only into itself.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clearspan.llm.common import HASH_RANGE, buckets_for, kept_once, key_hash, prefix_sums, text_of


def _score(key: Column, shard: int, weight: float) -> Column:
    """An exponential variate with the weight as its rate, from a hash of key and shard."""
    unit = (key_hash(key, shard).cast("double") + F.lit(0.5)) / F.lit(HASH_RANGE)
    return -F.ln(unit) / F.lit(float(weight))


def shard_of(key: Column, weights: list[float]) -> Column:
    """Number of the shard of a key. A null key counts as the text ``null``; weights must be above 0."""
    if not weights or min(weights) <= 0:
        raise ValueError("every shard needs a weight above 0")
    scores = F.array(*[F.struct(_score(key, i, w).alias("score"), F.lit(i).alias("shard")) for i, w in enumerate(weights)])
    return F.array_min(scores)["shard"]


def place(docs: DataFrame, weights: list[float], grown: list[float] | None = None) -> DataFrame:
    """One row per document: ``doc_id, size, text_crc32, law, shard, slot, grown_shard``.

    ``size`` is the UTF-8 bytes of the text plus 1 and a null text has none. Rows with equal
    ``doc_id`` (null included) share a shard. ``slot`` numbers the rows of a shard from 0 without gaps, in
    the order of a hash of the key; rows alike in key, checksum and size may swap slots. ``grown_shard`` is
    the shard under ``grown``, by default one more shard of the last weight. Other columns of ``docs`` are
    neither read nor returned; an empty table gives none.
    """
    grown = grown or [*weights, weights[-1]]
    text = text_of()
    rows = docs.select(
        F.col("doc_id"),
        (F.octet_length(text) + 1).cast("bigint").alias("size"),
        F.crc32(F.encode(text, "UTF-8")).alias("text_crc32"),
    )
    # Kept, so that counting the buckets of a shard and numbering inside them read the text once.
    rows = kept_once(rows.withColumn("shard", shard_of(F.col("doc_id"), weights)))
    counts = rows.groupBy("shard").agg(buckets_for(F.count("*")).alias("__buckets"))
    dealt = rows.join(F.broadcast(counts), "shard").withColumn("__order", key_hash(F.col("doc_id")))
    dealt = dealt.withColumn("__bucket", F.floor(F.col("__order") / F.lit(HASH_RANGE) * F.col("__buckets")))
    numbered = prefix_sums(
        dealt, ["shard"], "__bucket", [F.col("__order"), F.col("doc_id"), F.col("text_crc32"), F.col("size")], F.lit(1), "slot"
    )
    return numbered.select(
        "doc_id", "size", "text_crc32", F.lit("key").alias("law"), F.col("shard"), F.col("slot").cast("bigint").alias("slot"),
        shard_of(F.col("doc_id"), grown).alias("grown_shard"),
    )
