"""Unions, role duplication and key differences."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def union_positional(frames: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.union, frames)


def union_by_name(frames: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


def union_allow_missing(frames: list[DataFrame]) -> DataFrame:
    if not frames:
        raise ValueError("nothing to union")
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def duplicate_on_us(df: DataFrame, is_acquiring_on_us: Column, mode: str, issuing: str, changes: dict | None = None, enabled: bool = True) -> DataFrame:
    """Own-bank acquiring rows a second time as issuing rows, in one pass over the data."""
    if not enabled:
        return df
    roles = F.when(is_acquiring_on_us, F.array(F.lit(False), F.lit(True))).otherwise(F.array(F.lit(False)))
    copied = df.withColumn("__copy", F.explode(roles))
    for name, value in {mode: issuing, **(changes or {})}.items():
        copied = copied.withColumn(name, F.when(F.col("__copy"), F.lit(value)).otherwise(F.col(name)))
    return copied.drop("__copy")


def key_differences(new: DataFrame, current: DataFrame, keys: list[str]) -> DataFrame:
    """Distinct keys with the side they occur on: new, current or both."""
    sides = new.select(*keys, F.lit(1).alias("n"), F.lit(0).alias("c")).unionByName(
        current.select(*keys, F.lit(0).alias("n"), F.lit(1).alias("c"))
    )
    seen = sides.groupBy(*keys).agg(F.max("n").alias("n"), F.max("c").alias("c"))
    side = F.when(F.col("n") + F.col("c") == 2, "both").when(F.col("n") == 1, "new").otherwise("current")
    return seen.select(*keys, side.alias("side"))


def concat_chunks(spark, folder: str) -> DataFrame:
    """All chunk files of a folder as one dataset."""
    return spark.read.option("recursiveFileLookup", "true").parquet(folder)
