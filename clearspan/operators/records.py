"""Assembling logical records from lines, and blocks from messages."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from clearspan.operators.chunked import CHUNK, last_before, with_chunk
from clearspan.operators.lookup import lookup_join

# Line families of a text file: transaction codes and line sequence letters.
LINE_FAMILIES = {
    "draft": (["05", "06", "07", "25", "26", "27", "15", "16", "17", "35", "36", "37"], "01234567D"),
    "message": (["33"], "0"),
    "settlement": (["46"], "01"),
    "returned": (["01", "02", "03"], "0123456789DE"),
    "reclassified": (["04"], "012345679DE"),
}
MESSAGE_RECORDS = [
    "22200", "22210", "22220", "22225", "22226", "22230", "22250", "22260", "22261", "22280", "22281", "22282",
]
SETTLEMENT_TYPES = ["110", "120", "130", "140"]
HEADER, TRAILER = "697", "695"


def line_family(line: Column, incoming: Column) -> tuple[Column, Column]:
    """Family and sequence key of a line; both null for lines that belong to none."""
    code, sequence = F.substring(line, 1, 2), F.substring(line, 4, 1)
    record = F.substring(line, 36, 5)
    is_message = (
        (F.substring(line, 17, 10) == "SMSRAWDATA")
        & (F.substring(line, 35, 3) == "V22")
        & record.isin(MESSAGE_RECORDS)
    )
    extra = {"message": is_message, "settlement": incoming}
    family = F
    for name, (codes, letters) in LINE_FAMILIES.items():
        fits = code.isin(codes) & sequence.isin(list(letters))
        family = family.when(fits & extra.get(name, F.lit(True)), F.lit(name))
    family = family.otherwise(F.lit(None))
    key = F.when(family == "message", record).when(family.isNotNull(), sequence)
    return family, key


def sequence_ordinal(key: Column) -> Column:
    """Digits count as themselves, letters follow from 10."""
    return F.when(key.rlike("^[0-9]+$"), key.try_cast("int")).otherwise(F.ascii(F.upper(key)) - 55)


def record_starts(lines: DataFrame, group: list[str], order: str, ordinal: Column, size: int = CHUNK) -> DataFrame:
    """Add ``record_start``: the order value of the first line of each line's logical record.

    A record ends when the sequence number does not rise. Inside a chunk every line but the
    first can be told from the line before; one row per chunk settles the first lines and
    carries the open record into the next chunk. The lines are shuffled once.
    """
    chunk = Window.partitionBy(*group, "__chunk").orderBy(order)
    placed = with_chunk(lines.withColumn("__seq", ordinal), order, size)
    placed = placed.withColumn("__previous", F.lag("__seq").over(chunk))
    own_start = F.when(F.col("__seq") <= F.col("__previous"), F.col(order))
    placed = placed.withColumn("__start", F.last(own_start, ignorenulls=True).over(chunk))

    per_chunk = placed.groupBy(*group, "__chunk").agg(
        F.min(order).alias("__first"),
        F.min_by("__seq", order).alias("__first_seq"),
        F.max_by("__seq", order).alias("__last_seq"),
        F.max("__start").alias("__last_start"),
    )
    chunks = Window.partitionBy(*group).orderBy("__chunk")
    before = F.lag("__last_seq").over(chunks)
    opens = before.isNull() | (F.col("__first_seq") <= before)
    per_chunk = per_chunk.withColumn("__open_start", F.when(opens, F.col("__first")))
    newest = F.coalesce("__last_start", "__open_start")
    carried = F.last(newest, ignorenulls=True).over(chunks.rowsBetween(Window.unboundedPreceding, -1))
    entry = per_chunk.select(*group, "__chunk", F.coalesce("__open_start", carried).alias("__entry"))
    joined = placed.join(entry, [*group, "__chunk"])
    return joined.withColumn("record_start", F.coalesce("__start", "__entry")).select(*lines.columns, "record_start")


def assemble_records(lines: DataFrame, group: list[str], order: str, key: str, keys: list[str], line: str = "line", size: int = CHUNK) -> DataFrame:
    """One row per logical record with a column per line key; absent lines are empty text.

    A record holds each key at most once, so the aggregation is bounded by the key list.
    """
    placed = record_starts(lines, group, order, sequence_ordinal(F.col(key).cast("string")), size)
    cells = [
        F.coalesce(F.max(F.when(F.col(key).cast("string") == k, F.col(line))), F.lit("")).alias(k) for k in keys
    ]
    return placed.groupBy(*group, "record_start").agg(*cells)


def settlement_report_type(first_line: Column) -> Column:
    """Report type of a settlement record; null unless a known type with blank suffix."""
    kind, suffix = F.substring(first_line, 61, 3), F.substring(first_line, 64, 2)
    return F.when(kind.isin(SETTLEMENT_TYPES) & (suffix == "  "), kind)


def with_block(messages: DataFrame, group: list[str], order: str, code: str, carried: dict[str, str], size: int = CHUNK) -> DataFrame:
    """Messages between a header and its first trailer, with the trailer's columns on every row.

    Messages outside a block and blocks without a trailer are dropped. ``block_start`` is the
    header's position; ``carried`` maps trailer columns to output names.
    """
    is_header = F.col(code) == HEADER
    placed = last_before(messages, group, order, F.when(is_header, F.col(order)), "block_start", size, inclusive=True)
    inside = placed.where("block_start IS NOT NULL")
    trailer = F.when(F.col(code) == TRAILER, F.col(order))
    blocks = inside.groupBy(*group, "block_start").agg(
        F.min(trailer).alias("block_end"),
        *[F.min_by(c, trailer).alias(f"__c{i}") for i, c in enumerate(carried)],
    ).where("block_end IS NOT NULL")
    take = {"block_end": "block_end"} | {f"__c{i}": name for i, name in enumerate(carried.values())}
    joined = lookup_join(inside, blocks, [*group, "block_start"], take)
    return joined.where(F.col(order) <= F.col("block_end"))
