"""Left lookups for any size of the looked-up side and any key skew.

The join is left to Spark: a side is broadcast if it is small in bytes, by the statistics of its files or by
what its shuffle turned out to hold; otherwise both sides are shuffled, and a key with a third of the rows is
split over many tasks by adaptive execution. Nothing is counted or written before the query runs.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clearspan.session import shared_dir


def materialised(df: DataFrame) -> DataFrame:
    """``df`` computed once and kept in the shared folder, for tables that several parts of a job are computed from."""
    shared_dir(df.sparkSession)
    return df.checkpoint()


def spread(df: DataFrame, keys: list[str]) -> DataFrame:
    """Rows over all shuffle partitions: few and small rows that each cause much work.

    Adaptive execution would merge them into few tasks by their size alone.
    """
    spark = df.sparkSession
    tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), 2 * spark.sparkContext.defaultParallelism)
    return df.repartition(tasks, *keys)


def lookup_join(
    facts: DataFrame,
    dim: DataFrame,
    keys: dict[str, str] | list[str],
    take: dict[str, str] | list[str],
    *,
    how: str = "left",
    null_safe: bool = False,
) -> DataFrame:
    """Join ``dim`` to ``facts`` on equality of ``keys`` (fact column -> dim column).

    ``take`` names the dim columns to add (dim column -> output column). With ``how``
    "left_semi" or "left_anti" nothing is added.
    """
    keys = {k: k for k in keys} if isinstance(keys, list) else keys
    take = {c: c for c in take} if isinstance(take, list) else take
    side = dim.select(
        *[F.col(d).alias(f"__k{i}") for i, d in enumerate(keys.values())],
        *[F.col(c).alias(f"__v_{name}") for c, name in take.items()],
    )
    cond = F.lit(True)
    for i, fact_key in enumerate(keys):
        left, right = F.col(fact_key), F.col(f"__k{i}")
        cond = cond & (left.eqNullSafe(right) if null_safe else left == right)
    joined = facts.join(side, cond, how)
    kept = [F.col(f"`{c}`") for c in facts.columns if c not in take.values()]
    if how in ("left_semi", "left_anti"):
        return joined.select(*kept)
    return joined.select(*kept, *[F.col(f"__v_{name}").alias(name) for name in take.values()])
