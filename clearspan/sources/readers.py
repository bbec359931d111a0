"""Scans of staged, operational and reference datasets."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from clearspan.functions.typed import catalog_schema
from clearspan.operators.lookup import lookup_join

# Spellings of a missing value in returned cost files.
NA_SPELLINGS = [
    "-1.#IND", "1.#QNAN", "1.#IND", "-1.#QNAN", "#N/A N/A", "#N/A", "N/A", "n/a", "", "#NA", "NULL", "null", "NaN",
    "-NaN", "nan", "-nan",
]


def path_exists(spark: SparkSession, path: str) -> bool:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()).exists(target)


def scan_reference(spark: SparkSession, path: str, columns: Iterable[str]) -> DataFrame:
    return spark.read.parquet(path).select(*columns)


def scan_with_catalog(spark: SparkSession, path: str, catalog: Iterable[dict]) -> DataFrame:
    """Scan with the schema a field catalog declares; columns missing in files are null."""
    return spark.read.schema(catalog_schema(catalog)).parquet(path)


def scan_fixed(spark: SparkSession, path: str, schema: str | T.StructType) -> DataFrame:
    return spark.read.schema(schema).option("mergeSchema", "false").parquet(path)


def scan_date_range(
    spark: SparkSession, root: str, first: str, last: str, client: str, date_column: str = "date"
) -> DataFrame | None:
    """Rows of an inclusive range of date partitions; ``None`` when absent or empty."""
    if not path_exists(spark, root):
        return None
    rows = spark.read.parquet(root).where(F.col(date_column).between(F.lit(first).cast("date"), F.lit(last).cast("date")))
    return None if rows.isEmpty() else rows.withColumn("customer_code", F.lit(client))


def scan_partition(spark: SparkSession, root: str, **partition: str) -> DataFrame:
    """One partition, picked by pruning on the dataset root."""
    rows = spark.read.parquet(root)
    for name, value in partition.items():
        rows = rows.where(F.col(name) == F.lit(value).cast(rows.schema[name].dataType))
    return rows


def scan_optional(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Dataset, or no rows with the declared schema when it does not exist."""
    if path_exists(spark, path):
        wanted = T.StructType.fromDDL(schema)
        return spark.read.parquet(path).select(*[F.col(f.name).cast(f.dataType) for f in wanted])
    return spark.createDataFrame([], schema)


def scan_first_existing(spark: SparkSession, root: str, *names: str) -> DataFrame:
    """First of the named datasets that exists, as folder or as single file."""
    tried = [f"{root.rstrip('/')}/{name}{suffix}" for name in names for suffix in ("", ".parquet")]
    for path in tried:
        if path_exists(spark, path):
            return spark.read.parquet(path)
    raise FileNotFoundError(f"none of these datasets exists: {tried}")


def scan_returned_costs(spark: SparkSession, path: str, schema: str | T.StructType) -> DataFrame:
    """Cost CSV in Latin-1 with many spellings of a missing value."""
    wanted = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    text = T.StructType([T.StructField(f.name, T.StringType()) for f in wanted])
    raw = spark.read.option("header", True).option("encoding", "ISO-8859-1").schema(text).csv(path)
    cells = []
    for f in wanted:
        value = F.when(~F.col(f.name).isin(NA_SPELLINGS), F.col(f.name))
        cells.append((value if isinstance(f.dataType, T.StringType) else value.cast(f.dataType)).alias(f.name))
    return raw.select(*cells)


def scan_text_lines(spark: SparkSession, path: str) -> DataFrame:
    """Latin-1 lines as ``file``, ``line_no`` (rising in file order from 1) and ``line``.

    Numbering needs no shuffle of the lines: rows of one split are numbered in reading order
    and shifted by the lines of the file's earlier splits, which is one small row per split.
    Lines of blanks only are dropped and leave a gap in the numbers. The text is read twice, for the summary of its
    splits and for the lines.
    """
    return _numbered_lines(spark, path).select("file", "line_no", "line")


def _numbered_lines(spark: SparkSession, path: str) -> DataFrame:
    """``file, line_no, line, first_width``, the last being the length of the file's first line that is not blank."""
    # The text source hands the bytes of a line on as they are, whatever they are.
    raw = spark.read.text(path).select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("__block"),
        F.monotonically_increasing_id().alias("__id"),
        F.decode(F.col("value").cast("binary"), "ISO-8859-1").alias("line"),
    )
    filled = F.trim("line") != ""
    span = F.greatest(F.max("__id") - F.min("__id") + 1, F.count("line"))
    splits = raw.groupBy("file", "__block").agg(
        F.min("__id").alias("__first"), span.alias("__rows"), F.min_by(F.length("line"), F.when(filled, F.col("__id"))).alias("__width")
    )
    along = Window.partitionBy("file").orderBy("__block")
    offsets = splits.select(
        "file", "__block", "__first",
        F.coalesce(F.sum("__rows").over(along.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("__offset"),
        F.first("__width", ignorenulls=True).over(along.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)).alias("first_width"),
    )
    placed = lookup_join(raw.where(filled), offsets, ["file", "__block"], ["__first", "__offset", "first_width"])
    return placed.select("file", (F.col("__id") - F.col("__first") + F.col("__offset") + 1).alias("line_no"), "line", "first_width")


def scan_fixed_width(spark: SparkSession, path: str, long_variant: int = 170) -> DataFrame:
    """Fixed-width lines; files whose first line has the long form lose characters 3-4 of every line."""
    short = F.concat(F.substring("line", 1, 2), F.expr("substring(line, 5)"))
    line = F.when(F.col("first_width") == long_variant, short).otherwise(F.col("line")).alias("line")
    return _numbered_lines(spark, path).select("file", "line_no", line)


def file_stem_part(position: int, name: Column | None = None) -> Column:
    """Part of the source file's stem, split at underscores."""
    name = F.col("_metadata.file_name") if name is None else name
    stem = F.regexp_extract(name, r"^(.+)\.parquet$", 1)
    return F.get(F.split(stem, "_"), F.lit(position))


def scan_with_provenance(spark: SparkSession, path: str, position: int = 1, pattern: str | None = None) -> DataFrame:
    """Rows with the business file id taken from the source file name."""
    reader = spark.read.option("recursiveFileLookup", "true")
    if pattern:
        reader = reader.option("pathGlobFilter", pattern)
    rows = reader.parquet(path)
    name = F.col("_metadata.file_name")
    suffix = F.regexp_extract(name, r"_(\d{3})\.parquet$", 1)
    return rows.select("*", file_stem_part(position, name).alias("source_file_idn"), suffix.alias("source_function_code"))


def scan_modified_after(spark: SparkSession, path: str, moment: str, schema: T.StructType) -> DataFrame:
    """Files written or rewritten after ``moment`` (UTC)."""
    return spark.read.schema(schema).option("timeZone", "UTC").option("modifiedAfter", moment).parquet(path)


def file_snapshot(spark: SparkSession, folder: str, pattern: str | None = None) -> DataFrame:
    """``path, modified, length`` of the files below a folder; their content is not read."""
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", "true")
    if pattern:
        reader = reader.option("pathGlobFilter", pattern)
    return reader.load(folder).select("path", F.col("modificationTime").alias("modified"), "length")


def client_config(clients: DataFrame, client: str, default_currency: str = "USD") -> DataFrame:
    """One configuration row: flags as booleans, account prefix lists as arrays, default currency filled."""
    flags = [c for c in clients.columns if c.endswith("_flag")]
    lists = [c for c in clients.columns if c.endswith("_bins")]
    row = clients.where(F.col("client_id") == client)
    for c in flags:
        row = row.withColumn(c, F.upper(F.trim(F.coalesce(F.col(c), F.lit("")))) == "TRUE")
    for c in lists:
        row = row.withColumn(c, split_list(F.col(c)))
    return row.withColumn(
        "report_currency_code", F.coalesce(F.nullif("report_currency_code", F.lit("")), F.lit(default_currency))
    )


def split_list(c: Column) -> Column:
    """Comma text as array without blanks."""
    return F.filter(F.transform(F.split(F.coalesce(c, F.lit("")), ","), lambda x: F.trim(x)), lambda x: x != "")
