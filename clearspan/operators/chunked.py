"""Ordered work inside groups of any size.

A window over a whole file would put the file into one task. Here each group is cut into
chunks of its order column; windows run inside a chunk, and what a chunk needs from the
ones before it travels through one summary row per chunk.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

CHUNK = 100_000


def with_chunk(df: DataFrame, order: str, size: int = CHUNK) -> DataFrame:
    return df.withColumn("__chunk", F.call_function("div", F.col(order).cast("bigint"), F.lit(size).cast("bigint")))


def last_before(df: DataFrame, group: list[str], order: str, value: Column, name: str, size: int = CHUNK, inclusive: bool = False) -> DataFrame:
    """Add the last non-null ``value`` of earlier rows of the group (with ``inclusive``, also of the row).

    Window, summary and join back all use the same partitioning by (group, chunk), so the
    rows are shuffled once. Group columns must not be null.
    """
    inside = Window.partitionBy(*group, "__chunk").orderBy(order).rowsBetween(
        Window.unboundedPreceding, Window.currentRow if inclusive else -1
    )
    local = with_chunk(df.withColumn("__v", value), order, size).withColumn(
        "__local", F.last("__v", ignorenulls=True).over(inside)
    )
    newest = F.max_by("__v", F.when(F.col("__v").isNotNull(), F.col(order)))
    summary = local.groupBy(*group, "__chunk").agg(newest.alias("__chunk_last"))
    earlier = Window.partitionBy(*group).orderBy("__chunk").rowsBetween(Window.unboundedPreceding, -1)
    carried = summary.select(*group, "__chunk", F.last("__chunk_last", ignorenulls=True).over(earlier).alias("__carried"))
    joined = local.join(carried, [*group, "__chunk"])
    return joined.withColumn(name, F.coalesce("__local", "__carried")).select(*df.columns, name)


def next_after(df: DataFrame, group: list[str], order: str, name: str, chunk: Column) -> DataFrame:
    """Add the following row's ``order`` value; ``chunk`` must not fall as the order rises."""
    inside = Window.partitionBy(*group, "__chunk").orderBy(order)
    local = df.withColumn("__chunk", chunk).withColumn("__n", F.lead(order).over(inside))
    firsts = local.groupBy(*group, "__chunk").agg(F.min(order).alias("__first"))
    later = Window.partitionBy(*group).orderBy("__chunk")
    following = firsts.select(*group, "__chunk", F.lead("__first").over(later).alias("__following"))
    joined = local.join(following, [*group, "__chunk"])
    return joined.withColumn(name, F.coalesce("__n", "__following")).select(*df.columns, name)
