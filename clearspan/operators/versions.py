"""Versioned reference tables."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from clearspan.operators.chunked import next_after
from clearspan.operators.lookup import lookup_join
from clearspan.sources.readers import path_exists
from clearspan.sources.sinks import write_touched_partitions


def close_versions(df: DataFrame, keys: list[str], start: str, name: str, unit: str = "second") -> DataFrame:
    """Validity end: one unit before the key's next version; the newest stays open.

    Rows of one key that share a start follow each other in ``start`` order only, so their
    distinct starts are linked: a key has one row per start, cut by year.
    """
    step = F.expr(f"INTERVAL 1 {unit.upper()}")
    starts = df.select(*keys, start).where(F.col(start).isNotNull()).distinct()
    linked = next_after(starts, keys, start, "__next", F.year(start).cast("bigint"))
    ends = linked.where("__next IS NOT NULL").withColumn(name, F.col("__next") - step)
    if unit == "day":
        ends = ends.withColumn(name, F.date_sub("__next", 1))
    return lookup_join(df, ends, [*keys, start], [name], null_safe=True)


def keep_last_version(df: DataFrame, keys: list[str], best_first: list[Column]) -> DataFrame:
    order = Window.partitionBy(*keys).orderBy(*best_first)
    return df.withColumn("__n", F.row_number().over(order)).where("__n = 1").drop("__n")


def unseen_lines(incoming: DataFrame, master: DataFrame, line: str) -> DataFrame:
    """Incoming lines the master does not hold yet, compared without trailing blanks."""
    seen = master.select(F.rtrim(line).alias("__seen")).where("__seen IS NOT NULL").distinct()
    marked = incoming.withColumn("__line", F.rtrim(line))
    return marked.join(seen, F.col("__line") == F.col("__seen"), "left_anti").drop("__line")


def merge_versions(master: DataFrame, incoming: DataFrame, keys: list[str], effective: str, until: str, line: str) -> DataFrame:
    """Master after a delivery: unseen rows are added and every row ends before its successor.

    Old rows may end earlier than before, and a late older version ends at the newer one
    already there. The result does not depend on the order of deliveries.
    """
    fresh = unseen_lines(incoming, master, line).withColumn(until, F.lit(None).cast("date"))
    both = master.unionByName(fresh, allowMissingColumns=True)
    # Only keys that get a new version have new neighbours.
    touched = fresh.select(*[F.col(k).alias(f"__touched_{i}") for i, k in enumerate(keys)]).distinct()
    same = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"__touched_{i}")) for i, k in enumerate(keys)])
    starts = both.select(*keys, effective).where(F.col(effective).isNotNull()).distinct().join(touched, same, "left_semi")
    linked = next_after(starts, keys, effective, "__next", F.year(effective).cast("bigint"))
    joined = lookup_join(both, linked, [*keys, effective], ["__next"], null_safe=True)
    return joined.withColumn(until, F.least(F.col(until), F.date_sub("__next", 1))).drop("__next")


#: Partitions of a stored master.
PARTS = 64


def merge_into_store(spark: SparkSession, path: str, incoming: DataFrame, keys: list[str], effective: str, until: str, line: str, parts: int = PARTS) -> None:
    """A delivery merged into the master at ``path``, which is partitioned by a hash of its keys (``part``).

    Only partitions that the delivery has keys in are read and written; the others are not touched. The first delivery
    fixes the number of partitions, which must stay the same.
    """
    dealt = incoming.withColumn("part", F.pmod(F.xxhash64(*keys), F.lit(parts)).cast("int"))
    touched = sorted(r["part"] for r in dealt.select("part").distinct().collect())
    if not touched:
        return
    if path_exists(spark, path):
        schema = dealt.withColumn(until, F.lit(None).cast("date")).schema
        master = spark.read.schema(schema).parquet(path).where(F.col("part").isin(touched))
    else:
        master = dealt.withColumn(until, F.lit(None).cast("date")).where(F.lit(False))
    write_touched_partitions(merge_versions(master, dealt, keys, effective, until, line), path, ["part"])
