"""Writers: partition overwrite, reports, versioned reference tables."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterable

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from clearspan.functions import numbers
from clearspan.session import shared_dir
from clearspan.sources import commits


def write_touched_partitions(df: DataFrame, path: str, partition_by: list[str]) -> None:
    """Replace only the partitions present in ``df``; with no rows nothing changes.

    The rebalance hint groups rows by partition and lets adaptive execution cut a partition
    with a large share of the rows into several write tasks.
    """
    (
        df.hint("rebalance", *partition_by)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*partition_by)
        .parquet(path)
    )


def write_dataset(df: DataFrame, path: str, rows_per_file: int | None = None) -> None:
    """Replace a dataset, splitting files by row count; the file count follows the data."""
    writer = df.write.mode("overwrite")
    if rows_per_file:
        writer = writer.option("maxRecordsPerFile", rows_per_file)
    writer.parquet(path)


def write_by_volume(df: DataFrame, path: str, bytes_per_file: int = 128 << 20) -> None:
    """Replace a dataset; the file count follows the volume, as measured when the rows are dealt for writing."""
    spark = df.sparkSession
    settings = {
        "spark.sql.adaptive.enabled": "true", "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(bytes_per_file),
    }
    before = {k: spark.conf.get(k) for k in settings}
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        df.hint("rebalance").write.mode("overwrite").parquet(path)
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def write_small_report(df: DataFrame, path: str) -> None:
    """One file, for aggregated reports."""
    df.coalesce(1).write.mode("overwrite").parquet(path)


def write_by_class(df: DataFrame, path: str) -> None:
    """Messages by class, function code (class 1644 only) and sub-file."""
    code = F.when(F.col("type_mti") == "1644", F.col("function_code")).otherwise(F.lit("none"))
    df.withColumn("function_code", code).write.mode("overwrite").partitionBy(
        "type_mti", "function_code", "file_idn"
    ).parquet(path)


def report_lines(
    detail: DataFrame, month: str, columns: list[str], amounts: list[str], ratios: list[str], counts: list[str],
    order_by: list[str], width: int = 25,
) -> DataFrame:
    """Header 01, detail 02 and trailer 03 lines of the printed report, with a sort key.

    The trailer adds the rounded detail texts.
    """
    nul = "\u0000"
    cells = {}
    for c in columns:
        if c in amounts:
            cells[c] = numbers.amount_text(F.col(c))
        elif c in ratios:
            cells[c] = numbers.ratio_text(F.col(c))
        else:
            cells[c] = F.coalesce(F.col(c).cast("string"), F.lit(""))
    text = detail.select(*[F.col(c).alias(f"__o{i}") for i, c in enumerate(order_by)], *[v.alias(c) for c, v in cells.items()])
    quoted = [
        F.when(F.col(c).rlike('[,"\r\n]'), F.concat(F.lit('"'), F.replace(c, F.lit('"'), F.lit('""')), F.lit('"'))).otherwise(F.col(c))
        for c in columns
    ]
    order = [f"__o{i}" for i in range(len(order_by))]
    detail_lines = text.select(
        F.lit(2).alias("part"), *order, F.concat_ws(",", F.lit("02"), *quoted).alias("line")
    )
    totals = []
    for c in columns:
        if c in amounts:
            totals.append(F.coalesce(F.sum(F.col(c).try_cast("decimal(28,2)")), F.lit(0)).cast("decimal(28,2)").cast("string"))
        elif c in ratios:
            totals.append(F.coalesce(F.sum(F.col(c).try_cast("decimal(28,6)")), F.lit(0)).cast("decimal(28,6)").cast("string"))
        elif c in counts:
            totals.append(F.coalesce(F.sum(F.col(c).try_cast("bigint")), F.lit(0)).cast("string"))
        else:
            totals.append(F.lit(nul))
    totals[0] = F.count("*").cast("string")
    nulls = [F.lit(None).cast(text.schema[o].dataType).alias(o) for o in order]
    trailer = text.agg(F.concat_ws(",", F.lit("03"), *totals).alias("line")).select(F.lit(3).alias("part"), *nulls, "line")
    header_text = ",".join(["01", month] + [nul] * (width - 2))
    header = trailer.select(F.lit(1).alias("part"), *nulls, F.lit(header_text).alias("line"))
    return header.unionByName(detail_lines).unionByName(trailer)


def write_report_lines(lines: DataFrame, path: str) -> None:
    """The part files, in the order of their names, are the report; each is written by a task of its own."""
    order = [c for c in lines.columns if c.startswith("__o")]
    lines.orderBy("part", *order).select("line").write.mode("overwrite").option("lineSep", "\r\n").text(path)


def write_run_summary(spark: SparkSession, path: str, **values) -> None:
    """Control totals of a run as one JSON row."""
    columns = [F.lit(v).alias(k) for k, v in values.items()]
    spark.range(1).select(*columns).coalesce(1).write.mode("overwrite").json(path)


def read_run_summary(spark: SparkSession, path: str, schema: str) -> DataFrame:
    return spark.read.schema(schema).json(path)


def publish_version(df: DataFrame, root: str, stamp: str, after: int | None = None) -> str:
    """Publish a reference table as a new version; the replaced one goes to ``history``.

    The rows are written first, and become the current version by one commit that fails if another publisher was faster
    than this one, counted from ``after`` (by default the last commit now). History is written after the commit; what a
    crash left out there is made up by the next publish. Readers follow ``current_version`` and are whole at any time.
    """
    spark = df.sparkSession
    log = f"{root}/_commits"
    number, entry = commits.latest(spark, log)
    number = number if after is None else after
    if entry and entry["stamp"] == stamp:
        raise commits.ConflictError(f"{root}: version {stamp} is published")
    target = f"{root}/versions/{stamp}-{uuid.uuid4().hex[:12]}"
    df.write.mode("errorifexists").parquet(target)
    try:
        commits.commit(spark, log, number, {"path": target, "stamp": stamp, "replaced": entry["path"] if entry else None})
    except commits.ConflictError:
        commits.remove(spark, target)
        raise
    keep_history(spark, root)
    return target


def keep_history(spark: SparkSession, root: str) -> None:
    """Rows of replaced versions under the stamp of the version that replaced them, for all commits that lack them."""
    done, _ = commits.latest(spark, f"{root}/_history")
    for number, entry in commits.entries(spark, f"{root}/_commits", after=done):
        if entry["replaced"]:
            spark.read.parquet(entry["replaced"]).write.mode("overwrite").parquet(f"{root}/history/snapshot_ts={entry['stamp']}")
        commits.commit(spark, f"{root}/_history", number - 1, {"stamp": entry["stamp"]})


def current_version(spark: SparkSession, root: str) -> str | None:
    _, entry = commits.latest(spark, f"{root}/_commits")
    return entry["path"] if entry else None


def write_counted(df: DataFrame, path: str, check: Callable[[dict], None] | None = None, rows_per_file: int | None = None, **counts: Column) -> dict:
    """Replace a dataset and return aggregates of its rows that are gathered while it is written.

    With ``check`` the rows are written aside and take the place of the dataset only if the totals pass; otherwise the
    dataset stays as it is.
    """
    spark = df.sparkSession
    seen = Observation()
    observed = df.observe(seen, *[c.alias(name) for name, c in (counts or {"rows": F.count("*")}).items()])
    if check is None:
        write_dataset(observed, path, rows_per_file)
        return seen.get
    aside = f"{path.rstrip('/')}.{uuid.uuid4().hex}"
    write_dataset(observed, aside, rows_per_file)
    try:
        check(seen.get)
    except Exception:
        commits.remove(spark, aside)
        raise
    commits.remove(spark, path)
    commits.move(spark, aside, path)
    return seen.get


def numbered(df: DataFrame, order_by: Iterable[str | Column], name: str, start: int = 1) -> DataFrame:
    """Dense row numbers over a total order, without sorting everything in one task.

    Rows are range-partitioned and kept by a reliable checkpoint, so that counting the
    partitions and numbering them see the same rows; only one offset per partition is small. They are kept before
    that, too: the sample that the ranges are made from would otherwise compute them a second time.
    """
    order_by = list(order_by)
    shared_dir(df.sparkSession)
    ranged = df.checkpoint().repartitionByRange(*order_by).withColumn("__part", F.spark_partition_id()).checkpoint()
    counts = ranged.groupBy("__part").count()
    before = Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("__part", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("__offset"))
    inside = F.row_number().over(Window.partitionBy("__part").orderBy(*order_by))
    return (
        ranged.join(F.broadcast(offsets), "__part")
        .withColumn(name, (inside + F.col("__offset") + (start - 1)).cast("bigint"))
        .drop("__part", "__offset")
    )
