"""Clearing views over the base tables (FIXTURES.md part 2)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


#: Schema of each table as its footer gave it, so that a table is not opened once more for every reference to it.
_SCHEMAS: dict[str, tuple[int, T.StructType]] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A base table; its schema is read again when the file or folder has changed."""
    path = f"{sf_dir}/{name}.parquet"
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    changed = target.getFileSystem(spark._jsc.hadoopConfiguration()).getFileStatus(target).getModificationTime()
    if path not in _SCHEMAS or _SCHEMAS[path][0] != changed:
        _SCHEMAS[path] = (changed, spark.read.parquet(path).schema)
    return spark.read.schema(_SCHEMAS[path][1]).parquet(path)


def txn(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One clearing transaction per order; ``record`` is unique."""
    nation = table(spark, sf_dir, "nation")
    merchant = nation.select(
        F.col("n_nationkey").alias("merchant_nation"), F.col("n_regionkey").alias("merchant_region")
    )
    issuer = nation.select(
        F.col("n_nationkey").alias("c_nationkey"), F.col("n_regionkey").alias("issuer_region")
    )
    orders = table(spark, sf_dir, "orders").withColumn(
        "merchant_nation", (F.col("o_orderkey") % 25).cast("int")
    )
    customers = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    joined = (
        orders.join(customers, F.col("o_custkey") == F.col("c_custkey"))
        .join(merchant, "merchant_nation")
        .join(issuer, "c_nationkey")
    )
    return joined.selectExpr(
        "o_orderkey AS record",
        "CAST(o_orderkey % 7 AS INT) AS file_no",
        "400000000 + (o_custkey * 104729) % 90000000 AS acct9",
        "CAST(o_orderdate AS DATE) AS purchase_date",
        "date_add(CAST(o_orderdate AS DATE), CAST(o_orderkey % 20 AS INT)) AS processing_date",
        "CAST(round(o_totalprice * 100) AS BIGINT) AS amount_cents",
        "CASE o_orderkey % 4 WHEN 0 THEN 'EUR' WHEN 1 THEN 'USD' WHEN 2 THEN 'GBP' ELSE 'JPY' END AS ccy",
        "merchant_nation",
        "merchant_region",
        "c_nationkey AS issuer_nation",
        "issuer_region",
        "CASE WHEN o_orderkey % 2 = 0 THEN 'IN' ELSE 'OUT' END AS direction",
        "CASE o_orderkey % 6 WHEN 0 THEN '05' WHEN 1 THEN '06' WHEN 2 THEN '07' WHEN 3 THEN '25' "
        "WHEN 4 THEN '15' ELSE '' END AS code",
        "o_orderpriority AS priority",
    )


def acct_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Overlapping account ranges, several versions per start at larger scales."""
    return table(spark, sf_dir, "part").selectExpr(
        "p_partkey AS range_id",
        "400000000 + (p_partkey * 45000) % 90000000 AS low_key",
        "400000000 + (p_partkey * 45000) % 90000000 + 60000 + p_size * 1000 AS high_key",
        "date_add(DATE '1994-01-01', p_size * 20) AS effective_date",
        "CAST(p_partkey % 25 AS INT) AS range_nation",
        "p_brand AS product",
    )


def fx(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily rates to EUR in parts per million; the 15th of each month is missing."""
    dates = (
        table(spark, sf_dir, "orders")
        .select(F.col("o_orderdate").cast("date").alias("rate_date"))
        .where(F.dayofmonth("rate_date") != 15)
        .distinct()
    )
    quotes = F.expr(
        "array(named_struct('ccy','USD','base',900000), named_struct('ccy','GBP','base',1150000), "
        "named_struct('ccy','JPY','base',6200))"
    )
    return dates.withColumn("q", F.explode(quotes)).selectExpr(
        "rate_date",
        "q.ccy AS from_ccy",
        "'EUR' AS to_ccy",
        "CAST(q.base + day(rate_date) * 100 AS BIGINT) AS rate_ppm",
    )


def rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fee rules with token conditions, an amount floor and validity; one per part."""
    return table(spark, sf_dir, "part").selectExpr(
        "p_partkey + 1 AS rule_id",
        "CAST(p_partkey % 25 AS INT) AS nation",
        "CASE p_size % 4 WHEN 0 THEN '05,06' WHEN 1 THEN 'NOT:07' WHEN 2 THEN '' ELSE '06-20' END AS code_cond",
        "CASE WHEN p_size % 3 = 0 THEN CAST(p_size AS BIGINT) * 200000 END AS amount_min_cents",
        "date_add(DATE '1995-01-01', p_size * 10) AS valid_from",
        "CASE WHEN p_size % 5 = 0 THEN NULL ELSE date_add(DATE '1995-01-01', p_size * 10 + 1500) END AS valid_until",
        "CAST(p_size AS BIGINT) AS var_bp",
        "CAST(p_partkey % 50 AS BIGINT) AS fix_cents",
        "CASE WHEN p_size % 2 = 0 THEN 100 END AS min_cents",
        "CASE WHEN p_size % 7 = 0 THEN 50000 END AS cap_cents",
    )


def lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Numbered lines with a sequence 0-4 per file."""
    return table(spark, sf_dir, "events").selectExpr(
        "CAST(user_id % 8 AS INT) AS file_no",
        "event_id AS line_no",
        "CAST((event_id * 7 + user_id) % 5 AS INT) AS seq",
        "event_type AS line",
    )


def messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Messages with block header 697 and trailer 695."""
    return table(spark, sf_dir, "events").selectExpr(
        "CAST(user_id % 8 AS INT) AS file_no",
        "event_id AS msg_no",
        "CASE event_type WHEN 'signup' THEN '697' WHEN 'purchase' THEN '695' ELSE '000' END AS fc",
        "CAST(ts AS DATE) AS msg_date",
    )


def sre(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two-level roll-up hierarchy over nations."""
    return table(spark, sf_dir, "nation").selectExpr(
        "n_nationkey AS reporting_id", "CAST(floor(n_nationkey / 5) AS INT) AS rollup_id"
    )


# The same views as SQL text for the oracle, where only the base tables exist.
ORACLE_VIEWS = {
    "txn": """SELECT o.o_orderkey AS record,
  CAST(o.o_orderkey % 7 AS INT) AS file_no,
  400000000 + (o.o_custkey * 104729) % 90000000 AS acct9,
  CAST(o.o_orderdate AS DATE) AS purchase_date,
  CAST(o.o_orderdate AS DATE) + CAST(o.o_orderkey % 20 AS INT) AS processing_date,
  CAST(round(o.o_totalprice * 100) AS BIGINT) AS amount_cents,
  CASE o.o_orderkey % 4 WHEN 0 THEN 'EUR' WHEN 1 THEN 'USD' WHEN 2 THEN 'GBP' ELSE 'JPY' END AS ccy,
  CAST(o.o_orderkey % 25 AS INT) AS merchant_nation, mn.n_regionkey AS merchant_region,
  c.c_nationkey AS issuer_nation, inn.n_regionkey AS issuer_region,
  CASE WHEN o.o_orderkey % 2 = 0 THEN 'IN' ELSE 'OUT' END AS direction,
  CASE o.o_orderkey % 6 WHEN 0 THEN '05' WHEN 1 THEN '06' WHEN 2 THEN '07' WHEN 3 THEN '25' WHEN 4 THEN '15' ELSE '' END AS code,
  o.o_orderpriority AS priority
FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey
JOIN nation mn ON o.o_orderkey % 25 = mn.n_nationkey
JOIN nation inn ON c.c_nationkey = inn.n_nationkey""",
    "acct_range": """SELECT p_partkey AS range_id,
  400000000 + (p_partkey * 45000) % 90000000 AS low_key,
  400000000 + (p_partkey * 45000) % 90000000 + 60000 + p_size * 1000 AS high_key,
  DATE '1994-01-01' + CAST(p_size * 20 AS INT) AS effective_date,
  CAST(p_partkey % 25 AS INT) AS range_nation, p_brand AS product
FROM part""",
    "fx": """SELECT d.rate_date, f.from_ccy, 'EUR' AS to_ccy,
  CAST(f.base + day(d.rate_date) * 100 AS BIGINT) AS rate_ppm
FROM (SELECT DISTINCT CAST(o_orderdate AS DATE) AS rate_date FROM orders WHERE day(o_orderdate) <> 15) d
CROSS JOIN (SELECT 'USD' AS from_ccy, 900000 AS base UNION ALL SELECT 'GBP', 1150000 UNION ALL SELECT 'JPY', 6200) f""",
    "rules": """SELECT p_partkey + 1 AS rule_id, CAST(p_partkey % 25 AS INT) AS nation,
  CASE p_size % 4 WHEN 0 THEN '05,06' WHEN 1 THEN 'NOT:07' WHEN 2 THEN '' ELSE '06-20' END AS code_cond,
  CASE WHEN p_size % 3 = 0 THEN CAST(p_size AS BIGINT) * 200000 END AS amount_min_cents,
  DATE '1995-01-01' + CAST(p_size * 10 AS INT) AS valid_from,
  CASE WHEN p_size % 5 = 0 THEN NULL ELSE DATE '1995-01-01' + CAST(p_size * 10 + 1500 AS INT) END AS valid_until,
  CAST(p_size AS BIGINT) AS var_bp, CAST(p_partkey % 50 AS BIGINT) AS fix_cents,
  CASE WHEN p_size % 2 = 0 THEN 100 END AS min_cents, CASE WHEN p_size % 7 = 0 THEN 50000 END AS cap_cents
FROM part""",
    "lines": """SELECT CAST(user_id % 8 AS INT) AS file_no, event_id AS line_no,
  CAST((event_id * 7 + user_id) % 5 AS INT) AS seq, event_type AS line FROM events""",
    "messages": """SELECT CAST(user_id % 8 AS INT) AS file_no, event_id AS msg_no,
  CASE event_type WHEN 'signup' THEN '697' WHEN 'purchase' THEN '695' ELSE '000' END AS fc,
  CAST(ts AS DATE) AS msg_date FROM events""",
    "sre": """SELECT n_nationkey AS reporting_id, CAST(floor(n_nationkey / 5) AS INT) AS rollup_id FROM nation""",
}
