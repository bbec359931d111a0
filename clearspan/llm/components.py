"""Connected components of links, by rounds of joins that make every component a star."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clearspan.llm.common import in_fewer_parts, kept_and_counted


def _closer(edges: DataFrame) -> DataFrame:
    """One round over edges from larger to smaller nodes: ``a, b, changed``; no edge is changed if all components are stars.

    First the larger neighbours of a node go to the least node around it, then the smaller neighbours of a
    node, and the node, to the least of them.
    """
    both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    around = both.groupBy(F.col("a").alias("__a")).agg(F.min("b").alias("m"))
    least = F.least("b", "m")
    moved = edges.join(around, F.col("b") == F.col("__a")).select("a", least.alias("b"), (least < F.col("b")).cast("int").alias("changed"))
    below = moved.groupBy(F.col("a").alias("__a")).agg(F.min("b").alias("m"), F.max("changed").alias("__changed"))
    others = moved.join(below, F.col("a") == F.col("__a")).where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"), F.lit(1).alias("changed"))
    return others.union(below.select(F.col("__a").alias("a"), F.col("m").alias("b"), F.col("__changed").alias("changed")))


def stars(links: DataFrame, rows: int | None = None) -> DataFrame:
    """``node, component`` for every node with a link but the smallest of its component, which is the component.

    ``links`` has two columns of one type and is read several times. Links of a node to itself and null ends are left
    out. Rounds end when no edge changes, which takes about the square of the logarithm of the nodes at most; the
    changes are counted while a round is written. ``rows``, if known, says how many links there are at most, and a round
    never has more edges than the one before: both bound the parts that a round is written in.
    """
    x, y = links.columns[:2]
    ends = links.select(F.greatest(x, y).alias("a"), F.least(x, y).alias("b")).where(F.col(x).isNotNull() & F.col(y).isNotNull())
    edges, changed = ends.where("a <> b"), True
    while changed:
        closer = _closer(edges) if rows is None else in_fewer_parts(_closer(edges), rows)
        edges, seen = kept_and_counted(closer, changed=F.sum("changed"), rows=F.count("*"))
        edges, changed, rows = edges.select("a", "b"), seen["changed"], seen["rows"]
    return edges.select(F.col("a").alias("node"), F.col("b").alias("component"))


def components(links: DataFrame) -> DataFrame:
    """``node, component`` for every node that has a link; the component is its smallest node."""
    found = stars(links)
    return found.union(found.select(F.col("component").alias("node"), "component").distinct())
