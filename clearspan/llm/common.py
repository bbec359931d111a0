"""Column builders and small tables that several text operators share."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from clearspan.session import shared_dir, ship

#: White space that separates words, inside a character class.
SPACE = r"\x20\x09-\x0D"


def text_of(column: str = "text") -> Column:
    """The text, with null read as empty."""
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def words_of(text: Column) -> Column:
    """Array of the words of a text; a word is a run without white space."""
    return F.filter(F.split(text, f"[{SPACE}]+"), lambda w: w != "")


def word_count(text: Column) -> Column:
    """Number of words, without building more than one array."""
    parts = F.size(F.split(text, f"[{SPACE}]+"))
    edges = text.rlike(f"^[{SPACE}]").cast("int") + text.rlike(f"[{SPACE}]\\z").cast("int")
    # Text of white space alone splits into two empty parts, which both edges account for.
    return F.when(text == "", F.lit(0)).otherwise(parts - edges).cast("bigint")


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` computed once per row.

    A lambda that names a column is otherwise free to compute the column again for every
    element, once the optimizer has merged projections.
    """
    return F.get(F.transform(F.array(value), body), F.lit(0))


def kept_once(df: DataFrame) -> DataFrame:
    """``df`` computed once, in the shared checkpoint folder; a lost executor does not lose it."""
    shared_dir(df.sparkSession)
    return df.checkpoint()


def kept_and_counted(df: DataFrame, **counts: Column) -> tuple[DataFrame, dict]:
    """``df`` kept as by ``kept_once``, and aggregates of its rows that are gathered while it is written."""
    seen = Observation()
    kept = kept_once(df.observe(seen, *[c.alias(n) for n, c in counts.items()]))
    return kept, seen.get


#: Rows that a part of a table written on the way has at least, if there are as many: every part costs a task and files.
PART_ROWS = 2_000


def in_fewer_parts(df: DataFrame, rows: int) -> DataFrame:
    """``df`` in no more parts than ``rows`` are worth, which it and what it is joined from have at most; no row is moved.

    Every core gets a part. Large tables stay as they are dealt. Small ones dealt over many parts would be written as so many files, each of which
    starts processes on executors whose file system sets permissions by a command.
    """
    return df.coalesce(max(df.sparkSession.sparkContext.defaultParallelism, -(-rows // PART_ROWS)))


BATCH_ROWS = ("spark.sql.execution.arrow.maxRecordsPerBatch", "2000")


def prepare(spark: SparkSession) -> None:
    """Send the library to the workers, and let Arrow batches have fewer rows unless the session says how many: rows are whole texts."""
    ship(spark)
    if spark.conf.get(BATCH_ROWS[0], None) is None:
        spark.conf.set(*BATCH_ROWS)


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def prefix_sums(df: DataFrame, group: list[str], bucket: str, order: list[Column], value: Column, name: str) -> DataFrame:
    """Sum of ``value`` over the rows before each row, per group, in the order (bucket, order).

    The sum runs inside a bucket, and only one total per bucket is summed across a group, so a
    group with a third of the rows is spread over as many tasks as it has buckets. Nulls in
    ``group`` are values. Buckets must be numbered in the order wanted.
    """
    keys = [*group, bucket]
    totals = df.groupBy(*keys).agg(F.sum(value).alias("__total"))
    before = Window.partitionBy(*group).orderBy(bucket).rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(
        *[F.col(k).alias(f"__g_{k}") for k in keys], F.coalesce(F.sum("__total").over(before), F.lit(0)).alias("__offset")
    )
    inside = Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    same = [F.col(k).eqNullSafe(F.col(f"__g_{k}")) for k in keys]
    return (
        df.withColumn("__inside", F.coalesce(F.sum(value).over(inside), F.lit(0)))
        .join(offsets, [*same], "left")
        .withColumn(name, F.col("__offset") + F.col("__inside"))
        .drop("__inside", "__offset", *[f"__g_{k}" for k in keys])
    )


def buckets_for(rows: Column, rows_per_bucket: int = 2_000) -> Column:
    """How many buckets a group of so many rows is dealt into."""
    return F.greatest(F.ceil(rows / F.lit(rows_per_bucket)), F.lit(1)).cast("bigint")


#: Values of ``key_hash`` lie below this.
HASH_RANGE = float(2**52)


def key_hash(key: Column, *salt: int) -> Column:
    """A stable whole number from the MD5 of a key's text, 52 bits, the same in every engine. Null reads ``null``."""
    text = F.coalesce(key.cast("string"), F.lit("null"))
    salted = F.concat_ws(":", text, *[F.lit(str(s)) for s in salt])
    return F.conv(F.substring(F.md5(salted), 1, 13), 16, 10).cast("bigint")
