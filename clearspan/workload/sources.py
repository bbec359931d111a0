"""Scans and sinks (A): data is derived from the base tables, written, and read back."""

from __future__ import annotations

import datetime as dt
import time

from pyspark.sql import functions as F

from clearspan import fixtures
from clearspan.operators.lookup import lookup_join
from clearspan.session import scratch_path
from clearspan.sources import readers, sinks
from clearspan.streaming import incremental
from clearspan.workload.registry import query

C = F.col


@query("scan_reference_parquet", "SELECT n_nationkey, n_regionkey FROM nation")
def _reference(spark, sf_dir):
    return readers.scan_reference(spark, f"{sf_dir}/nation.parquet", ["n_nationkey", "n_regionkey"])


@query("scan_with_catalog_schema", "SELECT o_orderkey, o_orderstatus, CAST(NULL AS DECIMAL(18,4)) AS o_fee FROM orders")
def _catalog(spark, sf_dir):
    catalog = spark.createDataFrame(
        [("o_orderkey", "int64", None), ("o_orderstatus", "string", None), ("o_fee", "decimal", -2)], "name string, type string, decimals int"
    )
    rows = [r.asDict() for r in catalog.collect()]
    return readers.scan_with_catalog(spark, f"{sf_dir}/orders.parquet", rows)


@query("scan_fixed_schema", "SELECT c_custkey, c_mktsegment, CAST(NULL AS VARCHAR) AS c_note FROM customer")
def _fixed(spark, sf_dir):
    return readers.scan_fixed(spark, f"{sf_dir}/customer.parquet", "c_custkey bigint, c_mktsegment string, c_note string")


def _operational(spark, sf_dir):
    """Transactions stored by direction and month-end date, as the operational dataset is."""
    path = scratch_path(spark, "operational")
    rows = fixtures.txn(spark, sf_dir).withColumn("date", F.last_day("processing_date")).withColumn("file_type", C("direction"))
    sinks.write_touched_partitions(rows.select("record", "ccy", "amount_cents", "file_type", "date"), path, ["file_type", "date"])
    return path


@query(
    "scan_hive_partition_range",
    """SELECT record, ccy, amount_cents, direction AS file_type, CAST(last_day(processing_date) AS DATE) AS date, 'C1' AS customer_code FROM txn
       WHERE last_day(processing_date) BETWEEN DATE '1996-01-31' AND DATE '1997-06-30'""",
    ("txn",),
)
def _partition_range(spark, sf_dir):
    found = readers.scan_date_range(spark, _operational(spark, sf_dir), "1996-01-31", "1997-06-30", "C1")
    absent = readers.scan_date_range(spark, scratch_path(spark, "absent"), "1996-01-31", "1997-06-30", "C1")
    assert absent is None
    return found


def _rates_dataset(spark, sf_dir):
    path = scratch_path(spark, "rates")
    rates = fixtures.fx(spark, sf_dir).select(
        F.when(C("from_ccy") == "USD", "Visa").otherwise("MasterCard").alias("brand"), F.trunc("rate_date", "month").alias("exchange_date"),
        "rate_date", C("from_ccy").alias("from_currency"), C("to_ccy").alias("to_currency"), "rate_ppm",
    )
    sinks.write_touched_partitions(rates, path, ["brand", "exchange_date"])
    return path, rates


@query(
    "scan_partition_with_fallback",
    """SELECT rate_date, from_ccy AS from_currency, rate_ppm FROM fx WHERE from_ccy <> 'USD' AND date_trunc('month', rate_date) = DATE '1997-03-01'""",
    ("fx",),
)
def _one_partition(spark, sf_dir):
    path, _ = _rates_dataset(spark, sf_dir)
    rows = readers.scan_partition(spark, path, brand="MasterCard", exchange_date="1997-03-01")
    return rows.select("rate_date", "from_currency", "rate_ppm")


@query("scan_optional_or_empty", "SELECT t.record, CAST(NULL AS INTEGER) AS switch_id, n.n_regionkey AS region FROM txn t JOIN nation n ON t.merchant_nation = n.n_nationkey", ("txn",))
def _optional(spark, sf_dir):
    absent = readers.scan_optional(spark, scratch_path(spark, "local-switch"), "nation int, switch_id int")
    present = readers.scan_optional(spark, f"{sf_dir}/nation.parquet", "n_nationkey int, n_regionkey int")
    rows = lookup_join(fixtures.txn(spark, sf_dir), absent, {"merchant_nation": "nation"}, ["switch_id"])
    return lookup_join(rows, present, {"merchant_nation": "n_nationkey"}, {"n_regionkey": "region"}).select("record", "switch_id", "region")


@query("scan_first_existing_dataset", "SELECT s_suppkey, s_nationkey FROM supplier")
def _first_existing(spark, sf_dir):
    return readers.scan_first_existing(spark, sf_dir, "vendor", "supplier", "customer").select("s_suppkey", "s_nationkey")


@query(
    "scan_csv_with_na_tokens",
    """SELECT record AS app_id, CASE WHEN file_no = 0 THEN NULL ELSE CAST(amount_cents * CAST('0.01' AS DECIMAL(3,2)) AS DECIMAL(18,4)) END AS txn_sfc,
       CASE WHEN file_no = 1 THEN NULL ELSE lpad(CAST(merchant_nation AS VARCHAR), 11, '0') END AS mct_cd FROM txn""",
    ("txn",),
)
def _costs(spark, sf_dir):
    path = scratch_path(spark, "returned-costs")
    fixtures.txn(spark, sf_dir).selectExpr(
        "record AS app_id", "CASE file_no WHEN 0 THEN '#N/A' ELSE CAST(CAST(amount_cents * 0.01BD AS DECIMAL(18,2)) AS STRING) END AS txn_sfc",
        "CASE file_no WHEN 1 THEN '-nan' ELSE lpad(CAST(merchant_nation AS STRING), 11, '0') END AS mct_cd",
    ).write.option("header", True).option("encoding", "ISO-8859-1").csv(path)
    return readers.scan_returned_costs(spark, path, "app_id bigint, txn_sfc decimal(18,4), mct_cd string")


LINE = "code || CASE WHEN code = '' THEN 'xx' ELSE '' END || 'AB' || lpad(CAST(record AS STRING), 9, '0') || rpad(priority, 20, '.') || 'é'"


@query(
    "scan_fixed_width_text",
    f"""SELECT direction, record // 5000 AS block, row_number() OVER (PARTITION BY direction, record // 5000 ORDER BY record) AS line_no,
        CASE direction WHEN 'IN' THEN rpad({LINE}, 170, ' ')[1:2] || rpad({LINE}, 170, ' ')[5:] ELSE rpad({LINE}, 168, ' ') END AS line FROM txn""",
    ("txn",),
)
def _lines(spark, sf_dir):
    """One text file per direction and block of records, written by as many tasks as there are files."""
    folder = scratch_path(spark, "text-files")
    text = F.expr(f"CASE direction WHEN 'IN' THEN rpad({LINE}, 170, ' ') ELSE rpad({LINE}, 168, ' ') END")
    rows = fixtures.txn(spark, sf_dir).select("direction", F.expr("record DIV 5000").alias("block"), "record", text.alias("line"))
    ordered = rows.repartition("direction", "block").sortWithinPartitions("direction", "block", "record").select("direction", "block", "line")
    # The CSV writer with one column and no quoting writes Latin-1 text lines.
    ordered.write.partitionBy("direction", "block").option("encoding", "ISO-8859-1").option("sep", "\u0001").option("quote", "\u0000").option("ignoreTrailingWhiteSpace", False).option("ignoreLeadingWhiteSpace", False).csv(folder)
    found = readers.scan_fixed_width(spark, f"{folder}/*/*")
    return found.select(
        F.regexp_extract("file", r"/direction=(IN|OUT)/", 1).alias("direction"), F.regexp_extract("file", r"/block=(\d+)/", 1).cast("bigint").alias("block"), "line_no", "line"
    )


@query(
    "scan_provenance_from_filename",
    "SELECT record, CAST(file_no AS VARCHAR) AS source_file_idn, '691' AS source_function_code FROM txn",
    ("txn",),
)
def _provenance(spark, sf_dir):
    """Files named hash_file_class_code.parquet, as the stage before leaves them."""
    folder = scratch_path(spark, "by-class")
    fixtures.txn(spark, sf_dir).select("record", "file_no").write.partitionBy("file_no").parquet(folder)
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    store = path.getFileSystem(spark._jsc.hadoopConfiguration())
    for n, status in enumerate(store.globStatus(spark._jvm.org.apache.hadoop.fs.Path(f"{folder}/file_no=*/*.parquet"))):
        parent = status.getPath().getParent()
        store.rename(status.getPath(), spark._jvm.org.apache.hadoop.fs.Path(parent, f"h{n}_{parent.getName().split('=')[1]}_1644_691.parquet"))
    return readers.scan_with_provenance(spark, folder).select("record", "source_file_idn", "source_function_code")


def _store_rates(spark, folder, rates, times):
    for i, part in enumerate(times):
        rates.where(part).write.mode("append").parquet(folder)


@query(
    "scan_incremental_new_files",
    "SELECT brand, count(*) AS rates FROM (SELECT CASE from_ccy WHEN 'USD' THEN 'Visa' ELSE 'MasterCard' END AS brand FROM fx) GROUP BY brand",
    ("fx",),
)
def _incremental(spark, sf_dir):
    """Two deliveries, each taken once; a third run finds nothing new, and a file that is written again replaces its rows."""
    _, rates = _rates_dataset(spark, sf_dir)
    source, target, bookmark = (scratch_path(spark, n) for n in ("rate-files", "rate-copy", "rate-bookmark"))
    first = rates.where("brand = 'Visa'").withColumn("rate_ppm", C("rate_ppm") + 1)

    def store(batch, run):
        sinks.write_touched_partitions(batch, target, ["brand"])

    for mode, delivery in (("append", first), ("append", rates.where("brand = 'MasterCard'")), (None, None), ("overwrite", rates.where("brand = 'Visa'"))):
        if mode:
            delivery.write.mode(mode).option("partitionOverwriteMode", "dynamic").partitionBy("brand").parquet(source)
        incremental.run_new_and_changed(spark, source, rates.schema, bookmark, store)
    return spark.read.parquet(target).groupBy("brand").agg(F.count("*").alias("rates"))


@query(
    "stream_incremental_rates",
    """SELECT CASE from_ccy WHEN 'USD' THEN 'Visa' ELSE 'MasterCard' END AS brand, CAST(date_trunc('month', rate_date) AS DATE) AS exchange_date, rate_date, from_ccy AS from_currency,
       CASE WHEN rate_date < DATE '1996-01-01' OR from_ccy <> 'USD' THEN rate_ppm ELSE rate_ppm + 5 END AS rate_ppm, CASE from_ccy WHEN 'USD' THEN '840' WHEN 'GBP' THEN '826' END AS from_currency_numeric_code FROM fx""",
    ("fx",),
)
def _rates_stream(spark, sf_dir):
    """All rates, then corrected ones for some partitions, which replace just these."""
    _, rates = _rates_dataset(spark, sf_dir)
    source, target, checkpoint = (scratch_path(spark, n) for n in ("rate-files", "rate-table", "rate-bookmark"))
    codes = spark.createDataFrame([("USD", "840"), ("GBP", "826"), ("EUR", "978")], "currency_alphabetic_code string, currency_numeric_code string")
    corrected = rates.where("brand = 'Visa' AND exchange_date >= DATE '1996-01-01'").withColumn("rate_ppm", C("rate_ppm") + 5)
    for delivery in (rates, corrected):
        delivery.write.mode("append").parquet(source)
        incremental.run_rates(spark, source, rates.schema, codes, target, checkpoint)
    return spark.read.parquet(target).select("brand", "exchange_date", "rate_date", "from_currency", "rate_ppm", "from_currency_numeric_code")


@query(
    "sink_overwrite_touched_partitions",
    """SELECT CASE from_ccy WHEN 'USD' THEN 'Visa' ELSE 'MasterCard' END AS brand, rate_date, from_ccy AS from_currency, CASE WHEN year(rate_date) = 1997 THEN -rate_ppm ELSE rate_ppm END AS rate_ppm FROM fx""",
    ("fx",),
)
def _touched(spark, sf_dir):
    path, rates = _rates_dataset(spark, sf_dir)
    sinks.write_touched_partitions(rates.where("year(rate_date) = 1997").withColumn("rate_ppm", -C("rate_ppm")), path, ["brand", "exchange_date"])
    sinks.write_touched_partitions(rates.where(F.lit(False)), path, ["brand", "exchange_date"])
    return spark.read.parquet(path).select("brand", "rate_date", "from_currency", "rate_ppm")


@query("sink_single_parquet", "SELECT merchant_nation, count(*) AS n, 1 AS files FROM txn GROUP BY merchant_nation", ("txn",))
def _single(spark, sf_dir):
    path = scratch_path(spark, "report")
    sinks.write_small_report(fixtures.txn(spark, sf_dir).groupBy("merchant_nation").agg(F.count("*").alias("n")), path)
    back = spark.read.parquet(path)
    files = back.select(F.col("_metadata.file_path").alias("f")).distinct().count()
    return back.withColumn("files", F.lit(files))


@query("sink_size_adaptive_parquet", "SELECT count(*) AS n, CAST(sum(amount_cents) AS BIGINT) AS cents, true AS split FROM txn", ("txn",))
def _adaptive(spark, sf_dir):
    path = scratch_path(spark, "fees")
    sinks.write_dataset(fixtures.txn(spark, sf_dir), path, rows_per_file=400)
    back = spark.read.parquet(path)
    sizes = back.groupBy(F.col("_metadata.file_path").alias("f")).agg(F.count("*").alias("n"), F.sum("amount_cents").alias("c"))
    return sizes.agg(F.sum("n").alias("n"), F.sum("c").alias("cents"), ((F.max("n") <= 400) & (F.count("*") > 1)).alias("split"))


REPORT_COLUMNS = ["PRS", "LABEL", "TXN_CNT", "TXN_AMT", "SHARE"]
REPORT_SQL = """detail AS (SELECT CASE direction WHEN 'IN' THEN 1 ELSE 0 END AS prs, ccy || ', "' || code || '"' AS label, count(*) AS n,
   CAST(round(sum(amount_cents) * CAST('0.001' AS DECIMAL(4,3)), 2) AS DECIMAL(28,2)) AS amt, CAST(count(*) * CAST('0.0001234567' AS DECIMAL(11,10)) AS DECIMAL(28,10)) AS share FROM txn GROUP BY ALL),
   texts AS (SELECT prs, label, n, CAST(amt AS VARCHAR) AS amt, regexp_replace(CAST(share AS VARCHAR), '[0-9]{4}$', '') AS share FROM detail)"""


@query(
    "sink_report_records",
    """SELECT '01,199703' || repeat(',' || chr(1), 4) AS line UNION ALL
       SELECT '02,' || prs || ',"' || replace(label, '"', '""') || '",' || n || ',' || amt || ',' || share FROM texts UNION ALL
       SELECT '03,' || count(*) || ',' || chr(1) || ',' || sum(n) || ',' || sum(CAST(amt AS DECIMAL(28,2))) || ',' || sum(CAST(share AS DECIMAL(28,6))) FROM texts""",
    ("txn",),
    REPORT_SQL,
)
def _report(spark, sf_dir):
    detail = fixtures.txn(spark, sf_dir).groupBy(
        F.when(C("direction") == "IN", 1).otherwise(0).alias("PRS"), F.concat("ccy", F.lit(', "'), "code", F.lit('"')).alias("LABEL")
    ).agg(
        F.count("*").alias("TXN_CNT"), (F.sum("amount_cents") * F.lit("0.001").cast("decimal(4,3)")).cast("decimal(28,8)").alias("TXN_AMT"),
        (F.count("*") * F.lit("0.0001234567").cast("decimal(11,10)")).cast("decimal(28,10)").alias("SHARE"),
    )
    lines = sinks.report_lines(detail, "199703", REPORT_COLUMNS, ["TXN_AMT"], ["SHARE"], ["TXN_CNT"], ["PRS", "LABEL"], width=6)
    path = scratch_path(spark, "printed-report")
    sinks.write_report_lines(lines, path)
    back = spark.read.option("lineSep", "\r\n").text(path)
    # The fill character of unused cells is shown as chr(1), which both engines can hold.
    return back.select(F.translate("value", "\u0000", "\u0001").alias("line"))


@query(
    "sink_legacy_csv",
    """SELECT row_number() OVER (ORDER BY ccy, direction, merchant_region, code) AS app_id, CASE direction WHEN 'IN' THEN 2 ELSE 1 END AS bus_id, CASE ccy WHEN 'EUR' THEN 1 WHEN 'USD' THEN 2 ELSE 255 END AS sch_id,
       CASE WHEN merchant_region = 4 THEN 255 ELSE merchant_region END AS scope_id, CASE WHEN code = '' THEN '9999999999999999' ELSE code END AS mct_cd, count(*) AS txn_cnt FROM txn GROUP BY ccy, direction, merchant_region, code""",
    ("txn",),
)
def _legacy(spark, sf_dir):
    from clearspan.plans.fee_quota import filled_export

    groups = fixtures.txn(spark, sf_dir).groupBy("ccy", "direction", "merchant_region", "code").agg(F.count("*").alias("txn_cnt"))
    from clearspan.functions.classify import by_map

    mapped = groups.select(
        "ccy", "direction", "merchant_region", "code", by_map(C("direction"), {"OUT": 1, "IN": 2}).alias("bus_id"), by_map(C("ccy"), {"EUR": 1, "USD": 2}).alias("sch_id"),
        F.when(C("merchant_region") != 4, C("merchant_region")).alias("scope_id"), F.nullif("code", F.lit("")).alias("mct_cd"), "txn_cnt",
    )
    numbered = sinks.numbered(mapped, ["ccy", "direction", "merchant_region", "code"], "app_id")
    path = scratch_path(spark, "export")
    filled_export(numbered, ["app_id", "bus_id", "sch_id", "scope_id", "mct_cd", "txn_cnt"], codes=["bus_id", "sch_id", "scope_id"], texts=["mct_cd"], measures=["txn_cnt"]).write.option("header", True).csv(path)
    return spark.read.option("header", True).schema("app_id bigint, bus_id int, sch_id int, scope_id int, mct_cd string, txn_cnt bigint").csv(path)


@query("sink_run_summary", "SELECT count(*) AS number_of_rows, CAST(sum(amount_cents) AS BIGINT) AS total_cents, 'C1' AS client_code FROM txn", ("txn",))
def _summary(spark, sf_dir):
    totals = fixtures.txn(spark, sf_dir).agg(F.count("*").alias("n"), F.sum("amount_cents").alias("c")).first()
    path = scratch_path(spark, "summary")
    sinks.write_run_summary(spark, path, client_code="C1", number_of_rows=totals["n"], total_cents=totals["c"])
    return sinks.read_run_summary(spark, path, "number_of_rows bigint, total_cents bigint, client_code string")


@query(
    "sink_versioned_reference",
    """SELECT 'current' AS place, '3' AS snapshot_ts, count(*) AS n, CAST(sum(var_bp) AS BIGINT) AS bp FROM rules WHERE code_cond <> '' UNION ALL
       SELECT 'history', '2', count(*), CAST(sum(var_bp) AS BIGINT) FROM rules UNION ALL SELECT 'history', '3', count(*), CAST(sum(var_bp + 1) AS BIGINT) FROM rules""",
    ("rules",),
)
def _versioned(spark, sf_dir):
    root = scratch_path(spark, "rule-table")
    rows = fixtures.rules(spark, sf_dir)
    sinks.publish_version(rows, root, "1")
    sinks.publish_version(rows.withColumn("var_bp", C("var_bp") + 1), root, "2")
    sinks.publish_version(rows.where("code_cond <> ''"), root, "3")
    total = [F.count("*").alias("n"), F.sum("var_bp").alias("bp")]
    current = spark.read.parquet(sinks.current_version(spark, root)).agg(*total).select(F.lit("current").alias("place"), F.lit("3").alias("snapshot_ts"), "n", "bp")
    history = spark.read.parquet(f"{root}/history").groupBy(C("snapshot_ts").cast("string").alias("snapshot_ts")).agg(*total)
    return current.unionByName(history.select(F.lit("history").alias("place"), "snapshot_ts", "n", "bp"))


@query(
    "sink_split_by_class",
    """SELECT CASE direction WHEN 'IN' THEN 1240 ELSE 1644 END AS type_mti, CASE direction WHEN 'IN' THEN 'none' ELSE CASE WHEN merchant_region < 2 THEN '685' ELSE '691' END END AS function_code,
       file_no AS file_idn, count(*) AS n FROM txn GROUP BY ALL""",
    ("txn",),
)
def _split(spark, sf_dir):
    path = scratch_path(spark, "by-class")
    rows = fixtures.txn(spark, sf_dir).selectExpr(
        "record", "CASE direction WHEN 'IN' THEN '1240' ELSE '1644' END AS type_mti", "CASE WHEN merchant_region < 2 THEN '685' ELSE '691' END AS function_code", "file_no AS file_idn"
    )
    sinks.write_by_class(rows, path)
    return spark.read.parquet(path).groupBy("type_mti", "function_code", "file_idn").agg(F.count("*").alias("n"))


@query(
    "lookup_client_config",
    """SELECT t.record, CASE WHEN t.file_no = 0 THEN 'USD' ELSE 'C' || t.file_no END AS report_currency_code, t.file_no IN (1, 2) AS dup_flag, CASE WHEN t.file_no = 3 THEN 2 ELSE 0 END AS bins FROM txn t""",
    ("txn",),
)
def _client(spark, sf_dir):
    rows = fixtures.txn(spark, sf_dir)
    clients = rows.select("file_no").distinct().selectExpr(
        "file_no AS client_id", "CASE WHEN file_no > 0 THEN 'C' || file_no ELSE '' END AS report_currency_code",
        "CASE file_no WHEN 1 THEN 'TRUE' WHEN 2 THEN ' true' WHEN 3 THEN NULL ELSE 'FALSE' END AS dup_flag", "CASE WHEN file_no = 3 THEN '400000, 401047,' END AS issuing_bins",
    )
    parts = [readers.client_config(clients, c) for c in range(7)]
    config = parts[0]
    for p in parts[1:]:
        config = config.unionByName(p)
    out = lookup_join(rows, config, {"file_no": "client_id"}, {"report_currency_code": "report_currency_code", "dup_flag": "dup_flag", "issuing_bins": "b"})
    return out.select("record", "report_currency_code", "dup_flag", F.size("b").alias("bins"))


@query(
    "state_file_ledger",
    """SELECT file_id, content_hash, n AS arrivals, CASE WHEN k = 1 THEN 'new' ELSE 'new version' END AS status FROM (SELECT *, row_number() OVER (PARTITION BY file_id ORDER BY half, first_at, content_hash) AS k FROM
       (SELECT source || lang AS file_id, md5(text) AS content_hash, min(doc_id) AS first_at, min(CASE WHEN n_chars > 800 THEN 1 ELSE 2 END) AS half,
        count(*) FILTER (CASE WHEN n_chars > 800 THEN 1 ELSE 2 END = h) AS n FROM (SELECT *, min(CASE WHEN n_chars > 800 THEN 1 ELSE 2 END) OVER (PARTITION BY source || lang, md5(text)) AS h FROM documents) GROUP BY ALL))""",
)
def _ledger(spark, sf_dir):
    """Long documents arrive first, short ones in a second run; the ledger keeps state between the runs."""
    arrivals = fixtures.table(spark, sf_dir, "documents").select(
        F.concat("source", "lang").alias("file_id"), F.md5("text").alias("content_hash"), F.timestamp_seconds("doc_id").alias("arrived_at"), "n_chars"
    )
    source, ledger, checkpoint = (scratch_path(spark, n) for n in ("arrivals", "ledger", "ledger-bookmark"))
    for part in ("n_chars > 800", "n_chars <= 800"):
        arrivals.where(part).drop("n_chars").write.mode("append").parquet(source)
        incremental.run_ledger(incremental.new_files(spark, source, arrivals.drop("n_chars").schema), ledger, checkpoint)
    rows = spark.read.parquet(ledger).where("status <> 'duplicate'")
    return rows.select("file_id", "content_hash", "arrivals", "status")


@query(
    "state_file_life_cycle",
    """SELECT file_id, content_hash, CASE left(content_hash, 1) WHEN 'f' THEN 'PENDING' WHEN '0' THEN 'FAILED' ELSE 'COMPLETED' END AS state,
       CASE WHEN left(content_hash, 1) = 'f' THEN CAST(0 AS BIGINT) WHEN left(content_hash, 1) IN ('0', '1') THEN 2 ELSE 1 END AS attempts, CASE WHEN left(content_hash, 1) = '0' THEN 'unreadable' END AS error
       FROM (SELECT DISTINCT source || lang AS file_id, md5(text) AS content_hash FROM documents)""",
)
def _life_cycle(spark, sf_dir):
    """Files are registered, worked on with two kinds failing, and the failed ones tried again; one kind is not due yet."""
    docs = fixtures.table(spark, sf_dir, "documents")
    arrivals = docs.select(F.concat("source", "lang").alias("file_id"), F.md5("text").alias("content_hash"), F.timestamp_seconds("doc_id").alias("arrived_at"))
    ledger = incremental.register_arrivals(arrivals, spark.createDataFrame([], incremental.LEDGER_SCHEMA))
    states = scratch_path(spark, "file-states")

    def failing(kinds):
        return lambda files: files.withColumn("error", F.when(F.substring("content_hash", 1, 1).isin(kinds), "unreadable"))

    due = ledger.where("substr(content_hash, 1, 1) <> 'f'")
    incremental.process_files(due, states, "first", failing(["0", "1"]))
    incremental.process_files(due, states, "again", failing(["0"]), take=(incremental.FAILED,))
    found = incremental.file_states(ledger, incremental.state_log(spark, states))
    return found.select("file_id", "content_hash", "state", "attempts", "error")


@query(
    "scan_rewritten_files",
    """SELECT CASE from_ccy WHEN 'USD' THEN 'Visa' ELSE 'MasterCard' END AS brand, CAST(sum(rate_ppm + 1) AS BIGINT) AS total, count(*) AS rates FROM fx WHERE from_ccy = 'USD' GROUP BY brand""",
    ("fx",),
)
def _rewritten(spark, sf_dir):
    """Files written again under the same name after a moment are read again, the others are not."""
    _, rates = _rates_dataset(spark, sf_dir)
    folder = scratch_path(spark, "rate-files")
    rates.write.partitionBy("brand").parquet(folder)
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{folder}/brand=MasterCard")
    store = path.getFileSystem(spark._jsc.hadoopConfiguration())
    newest = max(s.getModificationTime() for s in store.listStatus(path))
    time.sleep(max(0.0, 2.1 - (time.time() - newest / 1000)))
    moment = dt.datetime.fromtimestamp(newest // 1000 + 1, dt.UTC).strftime("%Y-%m-%dT%H:%M:%S")
    again = rates.where("brand = 'Visa'").withColumn("rate_ppm", C("rate_ppm") + 1).drop("brand")
    again.write.mode("overwrite").parquet(f"{folder}/brand=Visa")
    schema = spark.read.parquet(folder).schema
    changed = readers.scan_modified_after(spark, folder, moment, schema)
    return changed.groupBy("brand").agg(F.sum("rate_ppm").alias("total"), F.count("*").alias("rates"))
