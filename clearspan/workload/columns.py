"""Projections, filters and predicates (B)."""

from __future__ import annotations

from pyspark.sql import functions as F

from clearspan import fixtures
from clearspan.operators import columns, filters, rules
from clearspan.workload.registry import query, scalar

C = F.col

REPORT = ["record", "direction", "code", "processing_date", "merchant_nation", "ccy", "amount_cents"]
query("project_report_columns", f"SELECT {', '.join(REPORT)} FROM txn", ("txn",))(
    lambda spark, sf_dir: columns.project(fixtures.txn(spark, sf_dir), REPORT)
)


@query("project_optional_column", "SELECT record, priority, '' AS eci, 0 AS exclude_flag FROM txn", ("txn",))
def _optional(spark, sf_dir):
    rows = fixtures.txn(spark, sf_dir)
    return rows.select(
        "record",
        columns.optional(rows, "priority", "").alias("priority"),
        columns.optional(rows, "eci", "").alias("eci"),
        columns.optional(rows, "exclude_flag", 0).alias("exclude_flag"),
    )


@query(
    "project_first_existing",
    "SELECT record, coalesce(nullif(code, ''), priority) AS product, ccy AS currency, 'none' AS absent FROM txn",
    ("txn",),
)
def _first_existing(spark, sf_dir):
    rows = fixtures.txn(spark, sf_dir).withColumn("code", F.nullif("code", F.lit("")))
    return rows.select(
        "record",
        columns.first_existing(rows, ["gcms_product", "code", "priority"]).alias("product"),
        columns.first_existing(rows, ["CURRENCY", "CCY"], ignore_case=True).alias("currency"),
        columns.first_existing(rows, ["x", "y"], "none").alias("absent"),
    )


@query(
    "align_to_schema",
    "SELECT CAST(NULL AS DATE) AS settled_on, TRY_CAST(code AS INTEGER) AS code, record, CAST(amount_cents AS DECIMAL(18,2)) AS amount_cents, CAST(file_no AS VARCHAR) AS file_no FROM txn",
    ("txn",),
)
def _align(spark, sf_dir):
    schema = "settled_on date, code int, record bigint, amount_cents decimal(18,2), file_no string"
    return columns.align(fixtures.txn(spark, sf_dir), schema)


CATALOG = [
    {"technical": "ccy", "name": "currency_code_de_49"},
    {"technical": "amount_cents", "name": "amount_transaction_de_4"},
    {"technical": "ccy", "name": "ignored_second_name"},
    {"technical": "absent", "name": "never"},
]


@query(
    "rename_from_catalog",
    "SELECT record, ccy AS currency_code_de_49, amount_cents AS amount_transaction_de_4 FROM txn",
    ("txn",),
)
def _rename(spark, sf_dir):
    rows = fixtures.txn(spark, sf_dir).select("record", "ccy", "amount_cents", "priority", "code")
    return columns.rename_from_catalog(rows, CATALOG, drop=["priority", "code", "other"])


@query(
    "order_columns_by_layout",
    "SELECT 1 AS position, 'record' AS name UNION ALL VALUES (2, 'file_no'), (3, 'amount_cents'), (4, 'ccy'), (5, 'code'), (6, 'direction'), (7, 'priority') ORDER BY 1",
)
def _order(spark, sf_dir):
    rows = fixtures.txn(spark, sf_dir).select("priority", "ccy", "direction", "amount_cents", "file_no", "record", "code")
    ordered = columns.order_by_layout(rows, ["record", "file_no"], {"amount_cents": ["ccy", "gone"], "code": ["direction"]})
    # One row per column that holds any value, from the data itself.
    filled = ordered.agg(*[F.count(c).alias(c) for c in ordered.columns])
    cells = [F.struct(F.lit(i + 1).alias("position"), F.lit(c).alias("name"), C(c).alias("n")) for i, c in enumerate(ordered.columns)]
    return filled.select(F.explode(F.array(*cells)).alias("x")).where("x.n > 0").select("x.position", "x.name")


@query(
    "filter_date_range",
    "SELECT record, processing_date FROM txn WHERE processing_date BETWEEN DATE '1996-02-01' AND DATE '1997-01-31'",
    ("txn",),
)
def _date_range(spark, sf_dir):
    kept = filters.by_date_range(fixtures.txn(spark, sf_dir), "processing_date", "1996-02-01", "1997-01-31")
    return filters.by_date_range(kept, "no_such_column", "1996-02-01", "1997-01-31").select("record", "processing_date")


@query(
    "filter_effective_rows",
    """SELECT rule_id, nation FROM rules WHERE valid_from <= DATE '1999-03-01' AND (valid_until IS NULL OR valid_until >= DATE '1999-03-01') AND code_cond <> ''""",
    ("rules",),
)
def _effective(spark, sf_dir):
    day = F.lit("1999-03-01").cast("date")
    return filters.effective_rows(fixtures.rules(spark, sf_dir), day, active=C("code_cond") != "").select("rule_id", "nation")


@query(
    "filter_in_list",
    "SELECT record FROM txn WHERE file_no IN (SELECT CAST(user_id % 8 AS INT) FROM events WHERE event_type = 'purchase' AND value > 300)",
    ("txn",),
)
def _in_list(spark, sf_dir):
    files = fixtures.table(spark, sf_dir, "events").where("event_type = 'purchase' AND value > 300")
    listed = files.selectExpr("CAST(user_id % 8 AS INT) AS file_no")
    return filters.in_list(fixtures.txn(spark, sf_dir), listed, ["file_no"]).select("record")


CONDITIONS = [
    ("C1", "where", "t1.code in ('05', '06')"),
    ("C1", "where", "ccy IN ('EUR','USD')"),
    ("C1", "other", "ccy in ('JPY')"),
    ("C2", "where", "anything else"),
    ("C1", "where", "missing_column in ('1')"),
]


@query("filter_from_condition_table", "SELECT record, code, ccy FROM txn WHERE code IN ('05','06') AND ccy IN ('EUR','USD')", ("txn",))
def _conditions(spark, sf_dir):
    conditions = spark.createDataFrame(CONDITIONS, "client string, kind string, condition string")
    kept = filters.by_condition_table(fixtures.txn(spark, sf_dir), conditions, client="C1", kind="where")
    return filters.by_condition_table(kept, conditions, client="C2", kind="where").select("record", "code", "ccy")


MORE_CONDITIONS = [
    ("C1", "where", "t1.reconciled_member_activity = 'X'"),
    ("C1", "hash_file_filter", "app_hash_file in (select ...)"),
    ("C2", "where", "ccy in ('EUR')"),
]


@query(
    "filter_from_activity_and_files",
    """SELECT 'C1' AS client, record FROM txn WHERE direction = 'IN' AND file_no = day(processing_date) % 7 AND file_no <> 3
       UNION ALL SELECT 'C2', record FROM txn WHERE ccy = 'EUR'""",
    ("txn",),
)
def _activity_conditions(spark, sf_dir):
    """Conditions that cite the member activity and listed files apply for the client that has them only."""
    conditions = spark.createDataFrame(MORE_CONDITIONS, "client string, kind string, condition string")
    rows = fixtures.txn(spark, sf_dir).withColumn("activity", F.when(C("direction") == "IN", "I").otherwise("A"))
    files = rows.select("file_no", "processing_date").where((C("file_no") == F.dayofmonth("processing_date") % 7) & (C("file_no") != 3))

    def of(client):
        kept = filters.by_condition_table(rows, conditions, client=client, kind="where")
        kept = filters.by_member_activity(kept, conditions, "activity", "I", client=client, kind="where")
        kept = filters.by_listed_files(kept, conditions, files, "file_no", "processing_date", client=client, kind="hash_file_filter")
        return kept.select(F.lit(client).alias("client"), "record")

    return of("C1").union(of("C2"))


@query(
    "filter_summary_detail_level",
    """SELECT record FROM txn WHERE file_no <> 1 AND merchant_region <> 0 AND code <> '25' AND merchant_nation IN (1, 2, 3) AND direction = 'IN'""",
    ("txn",),
)
def _summary(spark, sf_dir):
    rows = fixtures.txn(spark, sf_dir).selectExpr(
        "record", "CASE WHEN file_no = 1 THEN '11' ELSE '10' END AS level", "CASE WHEN merchant_region = 0 THEN 1 ELSE 0 END AS aggregation",
        "CASE WHEN code = '25' THEN 'Y' ELSE ' ' END AS no_data",
        "CASE merchant_nation WHEN 1 THEN '100' WHEN 2 THEN '330' WHEN 3 THEN '120' ELSE '999' END AS kind", "CASE WHEN direction = 'IN' THEN '2' ELSE '1' END AS mode",
    )
    names = ("level", "aggregation", "no_data", "kind", "mode")
    return rows.where(filters.summary_detail(*[C(n) for n in names], wanted_mode="2")).select("record")


@query(
    "filter_clearing_population",
    """SELECT record, product FROM (SELECT record, file_no, direction, CASE merchant_region WHEN 0 THEN NULL WHEN 1 THEN 'gcp' ELSE priority END AS product FROM txn)
       WHERE file_no IN (1, 2, 3) AND product IS NOT NULL AND product <> 'gcp' AND file_no <> 2""",
    ("txn",),
)
def _population(spark, sf_dir):
    rows = fixtures.txn(spark, sf_dir).selectExpr(
        "record", "CASE file_no WHEN 1 THEN 'C' WHEN 2 THEN 'M' WHEN 3 THEN 'M' ELSE 'X' END AS indicator", "CASE WHEN file_no = 2 THEN 1 END AS excluded",
        "CASE merchant_region WHEN 0 THEN NULL WHEN 1 THEN 'gcp' ELSE priority END AS product",
    )
    return rows.where(filters.clearing_population(C("indicator"), C("excluded"), C("product"))).select("record", "product")


scalar(
    "pred_blank",
    {"c": "CASE file_no WHEN 0 THEN NULL WHEN 1 THEN ' ' WHEN 2 THEN 'NaN' WHEN 3 THEN ' None' WHEN 4 THEN 'null' ELSE code END", "file_no": "file_no", "code": "code"},
    lambda: [rules.is_blank(C("c")).alias("no_condition")],
    {"no_condition": "file_no < 5 OR code = ''"},
)

# Rule texts and values from the same rows: lists, ranges, negation, blanks, lost zeros, word SPACE.
TOKEN_RULE = (
    "CASE CAST(record % 8 AS INT) WHEN 0 THEN '05,06' WHEN 1 THEN 'NOT:07' WHEN 2 THEN '' WHEN 3 THEN '05-07' WHEN 4 THEN 'not:05-07,25' "
    "WHEN 5 THEN 'nan' WHEN 6 THEN '15, 20-30' ELSE 'SPACE,25' END"
)
scalar(
    "pred_token_list",
    {"rule": TOKEN_RULE, "v": "CASE WHEN code = '' THEN ' ' ELSE code END", "k": "CAST(record % 8 AS INT)"},
    lambda: [
        rules.token_match(rules.token_condition(C("rule"), space_word=True), C("v")).alias("matches"),
        rules.token_match(rules.token_condition(C("rule"), space_word=True), C("v"), spans=2).alias("matches_unrolled"),
    ],
    {
        c: "CASE k WHEN 0 THEN v IN ('05','06') WHEN 1 THEN v <> '07' WHEN 2 THEN true WHEN 3 THEN coalesce(TRY_CAST(v AS INTEGER) BETWEEN 5 AND 7, false) "
        "WHEN 4 THEN NOT coalesce(TRY_CAST(v AS INTEGER) BETWEEN 5 AND 7 OR v = '25', false) WHEN 5 THEN true WHEN 6 THEN coalesce(v = '15' OR TRY_CAST(v AS INTEGER) BETWEEN 20 AND 30, false) ELSE v IN (' ', '25') END"
        for c in ("matches", "matches_unrolled")
    },
)

AMOUNT_RULE = (
    "CASE CAST(record % 8 AS INT) WHEN 0 THEN '>=1000 <200000' WHEN 1 THEN 'between 50000 and 250000.5' WHEN 2 THEN NULL WHEN 3 THEN '<=100000' WHEN 4 THEN '>300000' "
    "WHEN 5 THEN 'any' WHEN 6 THEN '=' || CAST(merchant_nation AS STRING) ELSE '<100000' END"
)
_AMOUNT_SQL = (
    "CASE k WHEN 0 THEN a >= 1000 AND a < 200000 WHEN 1 THEN a BETWEEN 50000 AND 250000.5 WHEN 2 THEN true WHEN 3 THEN a <= 100000 WHEN 4 THEN a > 300000 "
    "WHEN 5 THEN true WHEN 6 THEN a = n ELSE a < 100000 END"
)
_AMOUNT = "CASE WHEN file_no = 0 THEN CAST(merchant_nation AS DECIMAL(18,2)) ELSE CAST(amount_cents * CAST('0.01' AS DECIMAL(3,2)) AS DECIMAL(18,2)) END"


@query(
    "pred_amount_expression",
    f"""SELECT record, coalesce(CASE WHEN a IS NULL THEN k IN (2, 5) ELSE {_AMOUNT_SQL} END, false) AS matches FROM
        (SELECT record, CAST(record % 8 AS INT) AS k, merchant_nation AS n, CASE ccy WHEN 'EUR' THEN {_AMOUNT} WHEN 'USD' THEN ({_AMOUNT}) * 2 WHEN 'GBP' THEN ({_AMOUNT}) * 3 END AS a FROM txn)""",
    ("txn",),
)
def _amount_expression(spark, sf_dir):
    rows = fixtures.txn(spark, sf_dir).selectExpr("record", "ccy", f"{AMOUNT_RULE} AS rule", f"{_AMOUNT} AS amount")
    rates = spark.createDataFrame([("USD", "EUR", 2), ("GBP", "EUR", 3)], "from_ccy string, to_ccy string, rate int")
    rows = rules.converted_amounts(rows, rates, "ccy")
    amount = rules.amount_in(C("amount"), C("ccy"), F.lit("eur"), C("rates_to"))
    return rows.select("record", rules.number_match(rules.number_condition(C("rule"), bare_equal=False), amount).alias("matches"))


scalar(
    "pred_numeric_expression",
    {"rule": AMOUNT_RULE.replace("'any'", "CAST(merchant_nation AS STRING)"), "a": _AMOUNT, "k": "CAST(record % 8 AS INT)", "n": "merchant_nation"},
    lambda: [rules.number_match(rules.number_condition(C("rule")), C("a")).alias("matches")],
    {"matches": _AMOUNT_SQL.replace("WHEN 5 THEN true", "WHEN 5 THEN a = n")},
)

scalar(
    "pred_yes_no",
    {"rule": "CASE file_no WHEN 0 THEN ' no ' WHEN 1 THEN 'YES' WHEN 2 THEN NULL ELSE 'NO' END", "a": "CASE merchant_region WHEN 0 THEN NULL WHEN 1 THEN 0 WHEN 2 THEN -1 ELSE amount_cents END", "file_no": "file_no"},
    lambda: [rules.yes_no_match(C("rule"), C("a")).alias("matches")],
    {"matches": "CASE WHEN file_no = 2 THEN true WHEN file_no = 1 THEN coalesce(a, 0) > 0 ELSE coalesce(a, 0) = 0 END"},
)


@query(
    "assert_required_columns",
    """SELECT 'code' AS "column", 'null' AS problem, count(*) AS "rows", '' AS examples FROM txn WHERE code = ''
       UNION ALL SELECT 'price', 'not a number', count(*), array_to_string(list_sort(list(DISTINCT priority))[1:5], '|') FROM txn WHERE file_no = 0 AND direction = 'IN' HAVING count(*) > 0""",
    ("txn",),
)
def _problems(spark, sf_dir):
    rows = fixtures.txn(spark, sf_dir).selectExpr(
        "record", "nullif(code, '') AS code", "direction", "CASE WHEN file_no = 0 THEN priority WHEN file_no = 1 THEN ' ' ELSE CAST(amount_cents AS STRING) END AS price"
    )
    found = filters.column_problems(rows, ["record", "code"], ["price", "absent"], C("direction") == "IN")
    return found.select("column", "problem", "rows", F.array_join("examples", "|").alias("examples"))


@query(
    "filter_ledger_files",
    """SELECT doc_id, CAST(md5(text) AS VARCHAR) AS content_hash FROM documents WHERE lang = 'en' AND n_chars > 0 AND source IN ('src0', 'src1') AND DATE '2024-01-01' + CAST(doc_id % 60 AS INT) BETWEEN DATE '2024-01-10' AND DATE '2024-02-15'""",
)
def _ledger(spark, sf_dir):
    ledger = fixtures.table(spark, sf_dir, "documents").selectExpr(
        "doc_id", "lang AS client_id", "'MC' AS brand_id", "md5(text) AS content_hash", "date_add(DATE '2024-01-01', CAST(doc_id % 60 AS INT)) AS file_processing_date",
        "CASE source WHEN 'src0' THEN 'x_MasterCard_Inward_1' WHEN 'src1' THEN 'MasterCard_CPS_Collections_File.txt' WHEN 'src2' THEN 'Local_MasterCard_a' ELSE 'VISA_Inward' END AS landing_file_name",
    )
    files = filters.ledger_files(ledger, "en", "MC", "2024-01-10", "2024-02-15", "brand", collections=True)
    return files.select("doc_id", "content_hash")


@query(
    "project_client_overrides",
    """SELECT record, priority AS message_reason_code, CASE WHEN file_no = 4 THEN 'Y' ELSE 'N' END AS reconciled_file, '' AS eci FROM txn""",
    ("txn",),
)
def _overrides(spark, sf_dir):
    rows = fixtures.txn(spark, sf_dir).withColumn("file_name", F.concat(F.lit("x"), F.lpad(C("file_no").cast("string"), 5, "0")))
    suffix = F.when(C("file_name").like("%00004"), "Y").otherwise("N")
    rows = columns.extra_fields(rows, {"message_reason_code": C("priority"), "reconciled_file": suffix}, enabled=True)
    return columns.extra_fields(rows, {"eci": C("code")}, enabled=False).select("record", "message_reason_code", "reconciled_file", "eci")
