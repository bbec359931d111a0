"""Classifying file names by the patterns of clients, with an index of the literals that patterns require.

Patterns are kept as one row per client: buckets by one three-character run of a literal that every match must
contain, and the patterns without such a literal. A name looks up the buckets of its own runs, tests the literals found there
with ``contains`` and only then the patterns. The plan has no pattern in it.
"""

from __future__ import annotations

from collections import Counter
from zlib import crc32

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clearspan.operators.lookup import lookup_join
from clearspan.session import scratch_path

RUN = 3
#: Patterns per bucket of a client, about.
BUCKET = 4
#: Copies of the patterns of everyone, for the join that every file takes part in.
PARTS = 16

_LOWER, _UPPER = "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
_TO_UPPER = str.maketrans(_LOWER, _UPPER)
#: Escapes that stand for one character or place and nothing after them.
_PLAIN_ESCAPES = set("dDsSwWbBAzZtnrfaeGRXhHvV")

C = F.col


def required_literal(pattern: str) -> str:
    """The longest run of characters, in upper case, that every match contains; empty if none is certain.

    Only what stands outside of groups, classes and alternatives counts, and what no quantifier makes optional.
    """
    best = run = ""
    i, n = 0, len(pattern)

    def ended(length: int = 0) -> None:
        nonlocal best, run
        best, run = max(best, run[: len(run) - length], key=len), ""

    while i < n:
        c = pattern[i]
        if c == "\\":
            after = pattern[i + 1 : i + 2]
            if after.isalnum():
                if after not in _PLAIN_ESCAPES:
                    return ""
                ended()
            elif after and after.isascii():
                run += after
            else:
                ended()
            i += 2
            continue
        if c in "[(":
            end = _closing(pattern, i)
            if end < 0:
                return ""
            ended()
            i = end
            continue
        if c in "|)":
            return ""
        if c in "?*{":
            ended(1)
            if c == "{":
                i = pattern.find("}", i)
                if i < 0:
                    return ""
        elif c == "+" or c in ".^$":
            ended()
        elif c.isascii():
            run += c.translate(_TO_UPPER)
        else:
            ended()
        i += 1
    ended()
    return best


def _closing(pattern: str, start: int) -> int:
    """The place after the class or group that begins at ``start``; -1 if it is not plain."""
    if pattern[start] == "[":
        i = start + 1
        i += pattern[i : i + 1] == "^"
        i += pattern[i : i + 1] == "]"
        while i < len(pattern):
            if pattern[i] == "\\":
                i += 1
            elif pattern[i] == "[" or pattern.startswith("&&", i):
                return -1
            elif pattern[i] == "]":
                return i + 1
            i += 1
        return -1
    if pattern[start + 1 : start + 2] == "?" and pattern[start + 2 : start + 3] not in (":", "=", "!", "<", ">"):
        return -1
    i = start + 1
    while i < len(pattern):
        if pattern[i] == "\\":
            if pattern[i + 1 : i + 2] == "Q":
                return -1
            i += 2
        elif pattern[i] in "[(":
            i = _closing(pattern, i)
            if i < 0:
                return -1
        elif pattern[i] == ")":
            return i + 1
        else:
            i += 1
    return -1


def _bucketed(rows: list[dict]) -> tuple[list[list[dict]], list[dict]]:
    """Patterns by the rarest run of their literal, and the patterns that have none."""
    runs = [{r["literal"][k : k + RUN] for k in range(len(r["literal"]) - RUN + 1)} for r in rows]
    often = Counter(g for found in runs for g in found)
    buckets: list[list[dict]] = [[] for _ in range(max(len(rows) // BUCKET, 1))]
    rest = []
    for row, found in zip(rows, runs):
        if found:
            rarest = min(found, key=lambda g: (often[g], g))
            buckets[crc32(rarest.encode()) % len(buckets)].append(row)
        else:
            rest.append(row)
    return buckets, rest


def pattern_index(patterns: DataFrame, take: list[str]) -> DataFrame:
    """One row per client: ``__client, __buckets, __rest``; written to the shared folder once. A task holds one client's patterns."""
    active = patterns.where("is_active = 1 AND file_format IS NOT NULL AND customer_code IS NOT NULL")
    narrow = active.select(C("customer_code").alias("__client"), "priority", "pattern_id", C("file_format").alias("pattern"), F.struct(*[C(c) for c in take]).alias("value"))
    one = T.StructType([*narrow.schema.fields[1:4], T.StructField("literal", T.StringType()), narrow.schema["value"]])
    schema = T.StructType([narrow.schema["__client"], T.StructField("__buckets", T.ArrayType(T.ArrayType(one))), T.StructField("__rest", T.ArrayType(one))])
    from pyspark.sql.pandas.types import to_arrow_schema

    shape = to_arrow_schema(schema)

    def build(table: pa.Table) -> pa.Table:
        rows = [{**r, "literal": required_literal(r["pattern"])} for r in table.to_pylist()]
        buckets, rest = _bucketed(rows)
        return pa.Table.from_pylist([{"__client": rows[0]["__client"], "__buckets": buckets, "__rest": rest}], shape)

    path = scratch_path(patterns.sparkSession, "patterns")
    narrow.groupBy("__client").applyInArrow(build, schema).write.parquet(path)
    return patterns.sparkSession.read.schema(schema).parquet(path)


def _best(name: Column, upper: Column, buckets: Column, rest: Column) -> Column:
    """The first pattern by priority and id that is found in the name; null if none is."""
    places = F.array_distinct(
        F.transform(F.sequence(F.lit(1), F.greatest(F.length(upper) - (RUN - 1), F.lit(1))), lambda i: F.pmod(F.crc32(F.substr(upper, i, F.lit(RUN)).cast("binary")), F.size(buckets)).cast("int"))
    )
    near = F.flatten(F.transform(places, lambda b: F.get(buckets, b)))
    hits = F.filter(F.concat(near, rest), lambda p: F.contains(upper, p["literal"]) & F.rlike(name, F.concat(F.lit("(?i)"), p["pattern"])))
    return F.array_min(hits)


def classify_names(files: DataFrame, patterns: DataFrame, client: str, name: str, take: dict[str, str], everyone: str = "ALL") -> DataFrame:
    """First active pattern by priority, of the client or of everyone, found in a file name (any case).

    ``take`` maps pattern columns to new columns, null where no pattern is found. Files without client or name have none.
    """
    index = pattern_index(patterns, list(take))
    held = ["__buckets", "__rest"]
    own = lookup_join(files, index, {client: "__client"}, {c: f"{c}_own" for c in held})
    common = index.where(C("__client") == everyone).withColumn("__copy", F.explode(F.sequence(F.lit(0), F.lit(PARTS - 1))))
    own = own.withColumn("__part", F.pmod(F.xxhash64(name), F.lit(PARTS)).cast("int"))
    both = lookup_join(own, common, {"__part": "__copy"}, {c: f"{c}_all" for c in held})
    upper = F.translate(C(name), _LOWER, _UPPER)
    # Every part is null for clients and names that are missing; least leaves nulls out.
    found = F.array_min(F.filter(F.array(*[_best(C(name), upper, C(f"__buckets_{k}"), C(f"__rest_{k}")) for k in ("own", "all")]), lambda p: p.isNotNull()))
    chosen = both.withColumn("__pattern", F.when(C(client).isNotNull() & C(name).isNotNull(), found))
    return chosen.select(*[C(f"`{c}`") for c in files.columns], *[C("__pattern")["value"][c].alias(out) for c, out in take.items()])
