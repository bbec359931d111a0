"""Main text of web pages by wrappers that are inferred per host."""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterator
from functools import lru_cache

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clearspan.llm import wrappers
from clearspan.llm.common import kept_once, partitions
from clearspan.llm.urls import host_of

#: Wrappers that are aligned in one task; those of a host with more are aligned in rounds.
TOGETHER = 64


def page_streams(pages: DataFrame) -> DataFrame:
    """``host, key, learned`` for each different folded stream of tags of a host, from all its pages."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found: dict[tuple[str | None, str], wrappers.Learned] = {}
            for host, html in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                one = wrappers.page_of(html)
                key = (host, json.dumps(one.nodes, ensure_ascii=False))
                found[key] = found[key].joined(one) if key in found else one
            keys = [hashlib.blake2b(nodes.encode(), digest_size=16).hexdigest() for _, nodes in found]
            yield pa.RecordBatch.from_arrays(
                [pa.array([h for h, _ in found], pa.string()), pa.array(keys, pa.string()), pa.array([json.dumps([x.dump()]) for x in found.values()], pa.string())],
                ["host", "key", "learned"],
            )

    seen = pages.select("host", "html").mapInArrow(run, "host string, key string, learned string")
    # A stream that a third of all pages have is dealt over all tasks first.
    part = F.pmod(F.xxhash64("learned"), F.lit(partitions(pages.sparkSession))).cast("int")
    return _together(seen.withColumn("part", part), ["host", "key", "part"]).drop("part")


def _together(learned: DataFrame, group: list[str]) -> DataFrame:
    """The wrappers of each group, aligned in the order of their keys; the first key stays."""

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["key", "learned"])
        held = wrappers.together([wrappers.Learned.load(x) for text in rows["learned"] for x in json.loads(text)])
        return rows.head(1).assign(learned=json.dumps([x.dump() for x in held]))[columns]

    columns = [c for c in ("host", "key", "part", "learned") if c in learned.columns]
    schema = ", ".join(f"{c} {'int' if c == 'part' else 'string'}" for c in columns)
    return learned.groupBy(*group).applyInPandas(run, schema)


def host_wrappers(pages: DataFrame) -> DataFrame:
    """``host, wrapper``: the wrappers of all pages of each host as a JSON list.

    Pages become the different folded streams of each host where they are read. These are aligned as a tree, at most
    about ``TOGETHER`` in one task, until no host has more.
    """
    level = kept_once(_together(page_streams(pages), ["host", "key"]))
    while True:
        sizes = level.groupBy(F.col("host").alias("__host")).agg(F.count("*").alias("__n"))
        if (sizes.agg(F.max("__n")).first()[0] or 0) <= TOGETHER:
            break
        dealt = level.join(sizes, F.col("host").eqNullSafe(F.col("__host")))
        part = F.pmod(F.xxhash64("key"), F.ceil(F.col("__n") / F.lit(TOGETHER))).cast("int")
        level = kept_once(_together(dealt.select("host", "key", part.alias("part"), "learned"), ["host", "part"]).drop("part"))

    @F.pandas_udf("string")
    def dumped(learned: pd.Series) -> pd.Series:
        return learned.map(lambda text: json.dumps([wrappers.Learned.load(x).wrapper().dump() for x in json.loads(text)]))

    return _together(level, ["host"]).select("host", dumped("learned").alias("wrapper"))


@lru_cache(maxsize=256)
def _wrappers(text: str) -> list[wrappers.Wrapper]:
    return [wrappers.Wrapper.load(x) for x in json.loads(text)]


def extracted(pages: DataFrame) -> DataFrame:
    """``page_id, url, text, matched`` for each page: its main text, and whether a wrapper of its host holds for it."""
    plain = pages.select("page_id", "url", F.coalesce(F.col("html").cast("string"), F.lit("")).alias("html"))
    hosted = plain.withColumn("host", host_of(F.col("url").cast("string")))
    found = kept_once(host_wrappers(hosted)).withColumnRenamed("host", "__host")
    # One row per host; adaptive execution splits the pages of a host that has many.
    joined = hosted.join(found, F.col("host") == F.col("__host")).select("page_id", "url", "html", "wrapper")
    ends = [T.StructField("text", T.StringType(), False), T.StructField("matched", T.BooleanType(), False)]
    schema = T.StructType([plain.schema["page_id"], plain.schema["url"], *ends])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            html, held = batch.column(2), batch.column(3)
            out = [wrappers.extract(_wrappers(held[i].as_py()), html[i].as_py()) for i in range(len(batch))]
            told = [pa.array([text for text, _ in out], pa.string()), pa.array([matched for _, matched in out], pa.bool_())]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *told], ["page_id", "url", "text", "matched"])

    return joined.mapInArrow(run, schema)


def extract_pages(pages: DataFrame) -> DataFrame:
    """One row per page: ``page_id, url, text`` (empty if there is none).

    The text is that of the article without menus, headers, footers, sidebars, notices, adverts, forms, scripts,
    styles and comments; without an article that of the main part, else of the page. Which of several article elements is
    the main one is decided by the host's wrappers. Lines that all pages of a host have in a block that holds nothing else
    are left out. Character references are decoded, white space in a block becomes one space, blocks are lines.
    Null and empty html give empty text, pages without a host are one host, repeated rows are extracted each, nulls in
    ``page_id`` and ``url`` stay. Pages of any length are read whole; an empty table gives no rows. Other columns are
    neither read nor returned.
    """
    return extracted(pages).drop("matched")
