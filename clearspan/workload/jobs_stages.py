"""Record and message pipelines over all line families and message classes (M15, M16), and the branches of M6 and M14 for messages."""

from __future__ import annotations

from pyspark.sql import functions as F

from clearspan import fixtures
from clearspan.operators import records
from clearspan.plans import fee_quota, masters, stages
from clearspan.session import scratch_path
from clearspan.sources import sinks
from clearspan.workload.jobs_fees import BITMAP, NUMERIC, currencies, derived
from clearspan.workload.jobs_reports import CLIENT, FEE, JURISDICTION, MONEY, _quota_inputs, _times, _types, brand_rates
from clearspan.workload.registry import query

C = F.col

# Every event is a line; the user tells the family, and the event the place in the record.
_FAMILY = "CASE user_id % 5 WHEN 0 THEN 'draft' WHEN 1 THEN 'message' WHEN 2 THEN 'settlement' WHEN 3 THEN 'returned' ELSE 'reclassified' END"
_PLACE = "CASE WHEN user_id % 5 = 2 THEN event_id % 2 ELSE (event_id * 7 + user_id) % 5 END"
FAMILY_LINE = (
    f"CASE user_id % 5 WHEN 1 THEN '3300' || lpad(CAST(event_id AS STRING), 12, '0') || 'SMSRAWDATA' || '........' || 'V' || "
    "element_at(array('22200', '22210', '22220', '22225', '22226'), CAST((event_id * 7 + user_id) % 5 + 1 AS INT)) || rpad(event_type, 20, ' ') "
    f"ELSE element_at(array('05', '33', '46', '01', '04'), CAST(user_id % 5 + 1 AS INT)) || '0' || CAST({_PLACE} AS STRING) || lpad(CAST(event_id AS STRING), 12, '0') || rpad(event_type, 44, ' ') || "
    "element_at(array('110  ', '140  ', '110xx', '999  '), CAST(event_id DIV 2 % 4 + 1 AS INT)) END"
)


@query(
    "job_record_pipeline_visa",
    f"""SELECT family, file_no, record_start, coalesce(max(event_id) FILTER (seq = 0), 0) AS first_line, coalesce(max(event_id) FILTER (seq = 1), 0) AS second_line,
        CASE WHEN family = 'settlement' THEN max(CASE event_id // 2 % 4 WHEN 0 THEN '110' WHEN 1 THEN '140' END) FILTER (seq = 0) END AS report_type FROM
        (SELECT *, min(event_id) OVER (PARTITION BY file_no, family, grp) AS record_start FROM (SELECT *, sum(opens) OVER (PARTITION BY file_no, family ORDER BY event_id) AS grp FROM
          (SELECT *, CASE WHEN seq > lag(seq) OVER (PARTITION BY file_no, family ORDER BY event_id) THEN 0 ELSE 1 END AS opens FROM
            (SELECT event_id, CAST(user_id % 8 AS INT) AS file_no, {_FAMILY} AS family, {_PLACE} AS seq FROM events)))) GROUP BY family, file_no, record_start""",
)
def _record_pipeline(spark, sf_dir):
    """All five line families of the incoming files: records assembled, cut and typed."""
    lines = fixtures.table(spark, sf_dir, "events").selectExpr("CAST(user_id % 8 AS INT) AS file_no", "event_id AS line_no", f"{FAMILY_LINE} AS line", "'IN' AS file_type")
    catalog = [{"name": "first_line", "type": "int"}, {"name": "second_line", "type": "int"}]
    layouts = {}
    for family in records.LINE_FAMILIES:
        first, second = ("22200", "22210") if family == "message" else ("0", "1")
        layouts[family] = [{"source": s, "name": n, "position": 5, "length": 12} for s, n in ((first, "first_line"), (second, "second_line"))]
    assembled = stages.text_records(lines, list(layouts), ["file_no"], "line_no", 1000)
    kind = F.when(C("family") == "settlement", records.settlement_report_type(C("`0`")))
    dated = assembled.withColumns({"file_date": F.lit("2024-02-01").cast("date"), "report_type": kind})
    return stages.typed_text_records(dated, layouts, catalog, "file_date", ["family", "file_no", "record_start", "report_type"])


# Events other than block ends are messages of every class and function.
_KIND = "event_id % 6"
_MTI = f"CASE {_KIND} WHEN 0 THEN '1240' WHEN 1 THEN '1442' WHEN 5 THEN '1740' ELSE '1644' END"
_FUNCTION = f"CASE {_KIND} WHEN 2 THEN '685' WHEN 3 THEN '688' WHEN 4 THEN '691' ELSE '200' END"
_EDGE = "CASE event_type WHEN 'signup' THEN '697' WHEN 'purchase' THEN '695' ELSE {other} END"
ALL_CLASSES_BODY = (
    f"lpad(CAST(user_id % 1000000 AS STRING), 6, '0') || lpad(CAST(event_id AS STRING), 12, '0') || {_EDGE.format(other=_FUNCTION)} || "
    "CASE WHEN event_type = 'purchase' THEN '035010502500' || 'X' || '240315' || lpad(CAST(event_id AS STRING), 16, '0') || '0165' ELSE '0210165003M990300004ABCD' END || '978'"
)


@query(
    "job_message_pipeline_mc",
    f"""SELECT m.event_id AS ref_id, {_MTI} AS mti, CASE WHEN {_MTI} = '1644' THEN {_FUNCTION} END AS function_code, '00X240315' || right('0000000000000000' || m.block_end, 16) AS file_idn,
       CAST(m.event_id * CAST('0.01' AS DECIMAL(3,2)) AS DECIMAL(18,4)) AS amount, CASE WHEN {_KIND} <> 3 THEN 'M' END AS settlement_indicator, CASE WHEN {_KIND} <> 4 THEN 'ABCD' END AS amount_type FROM
       (SELECT e.*, h.block_end FROM events e JOIN (SELECT file_no, msg_no AS block_start, (SELECT min(x.msg_no) FROM messages x WHERE x.file_no = h.file_no AND x.fc = '695' AND x.msg_no > h.msg_no) AS block_end,
          (SELECT min(x.msg_no) FROM messages x WHERE x.file_no = h.file_no AND x.fc = '697' AND x.msg_no > h.msg_no) AS next_start FROM messages h WHERE h.fc = '697') h
        ON CAST(e.user_id % 8 AS INT) = h.file_no AND e.event_id BETWEEN h.block_start AND h.block_end WHERE h.next_start IS NULL OR h.block_end < h.next_start) m WHERE m.event_type NOT IN ('signup', 'purchase')""",
    ("messages",),
)
def _message_pipeline(spark, sf_dir):
    """All message classes, those of class 1644 by function code: decoded, valued and typed."""
    cls = _EDGE.format(other="NULL").replace("'697'", "'1644'").replace("'695'", "'1644'")
    events = fixtures.table(spark, sf_dir, "events").selectExpr("CAST(user_id % 8 AS INT) AS file_no", "event_id AS msg_no", f"coalesce({cls}, {_MTI}) AS cls", f"{ALL_CLASSES_BODY} AS body")
    payloads = events.select("file_no", "msg_no", F.concat(F.encode("cls", "US-ASCII"), F.unhex(F.lit(BITMAP)), F.encode("body", "US-ASCII")).alias("payload"))
    blocks = stages.decoded_blocks(payloads, False, ["file_no"], "msg_no", 1000)
    names = {"de_4": "amount", "de_49": "currency_code_transaction_de_49", "pds_165_1": "settlement_indicator", "pds_300": "amount_type", "msg_no": "ref_id"}
    catalog = [
        {"name": "amount", "type": "decimal", "decimals": -2}, {"name": "settlement_indicator", "type": "string"}, {"name": "amount_type", "type": "string"},
        {"name": "currency_code_transaction_de_49", "type": "int32"},
    ]
    plain = blocks.where(~F.coalesce(C("function_code"), F.lit("")).isin(records.HEADER, records.TRAILER))
    keep = ["msg_no", "mti", "function_code", "file_idn"]
    values = stages.message_values(plain, list(stages.CONTAINERS), {"de_4": {}, "de_49": {}}, {165: {"pds_165_1": 1, "pds_165_2": 2}, 300: {}}, keep)
    out = stages.typed_messages(values, names, catalog, currencies(spark), ["ref_id", "mti", "function_code", "file_idn"])
    return out.drop("currency_code_transaction_de_49")


QUOTA_MESSAGES = {
    "content_hash": "'f' || CAST(file_no AS STRING)", "record": "record", "file_type": "direction", "date": "processing_date", "local_draft_date": "CASE WHEN file_no <> 6 THEN purchase_date END",
    "transaction_code_sms": "CASE WHEN code = '' THEN '27' ELSE code END", "business_transaction_type": "merchant_region", "business_mode": "CASE WHEN direction = 'IN' THEN 'issuing' ELSE 'acquiring' END",
    "draft_currency_code": NUMERIC, "cryptogram_currency_code": "'840'", "settlement_currency_code_sms": "'826'", "source_amount": f"CASE WHEN file_no = 0 THEN CAST(0 AS DECIMAL(18,4)) ELSE {MONEY} END",
    "cryptogram_amount": FEE, "surcharge_amount_sms": "CASE WHEN merchant_region = 0 THEN CAST(1 AS DECIMAL(18,4)) END", "product_id_sms": "CASE file_no WHEN 0 THEN 'X' ELSE 'C' END",
    "card_number": "CAST(acct9 AS STRING)", "account_funding_source": "CASE WHEN file_no = 2 THEN 'H' ELSE 'P' END", "reversal_indicator": "CASE WHEN code = '25' THEN 1 ELSE 0 END",
    "card_acceptor_country": "'N' || CAST(merchant_nation AS STRING)", "jurisdiction": JURISDICTION,
}
_MONEY_USED = f"CASE WHEN file_no = 0 THEN CAST({FEE} + CASE WHEN merchant_region = 0 THEN 1 ELSE 0 END AS DECIMAL(18,4)) ELSE {MONEY} END"


@query(
    "job_fee_quota_messages",
    """SELECT app_id, mode AS business_mode_id, label AS table_description, kind AS business_transaction_type_id, report_amount, switch_code, reversal_indicator, currency_local_indicator, account_funding_source FROM
       (SELECT *, 'VISA SMS' AS label, 'plain' AS part FROM sms UNION ALL SELECT * REPLACE ('ISSUING' AS mode), 'VISA ON-US DUP (SMS TO ISS)', 'copy' FROM sms WHERE jurisdiction = 'on-us' AND mode = 'ACQUIRING')""",
    ("txn", "fx"),
    f"""sms AS (SELECT record AS app_id, CASE direction WHEN 'IN' THEN 'ISSUING' ELSE 'ACQUIRING' END AS mode, {JURISDICTION} AS jurisdiction, CASE merchant_region WHEN 0 THEN 'PUR' WHEN 1 THEN 'CSH' ELSE 'CRD' END AS kind,
         {_times(_MONEY_USED)} AS report_amount, CASE WHEN file_no = 2 THEN 7 ELSE 0 END AS switch_code, CASE WHEN code = '25' THEN 1 ELSE 0 END AS reversal_indicator, 1 AS currency_local_indicator,
         CASE WHEN file_no = 2 THEN 'C' ELSE 'D' END AS account_funding_source
        FROM txn t LEFT JOIN fx f ON f.rate_date = t.processing_date AND f.from_ccy = CASE WHEN file_no = 0 THEN 'USD' ELSE t.ccy END WHERE merchant_region < 3 AND file_no <> 6 AND code IN ('05', '06', '07', '25', ''))""",
)
def _quota_messages(spark, sf_dir):
    """Single messages in the monthly fee report; a zero amount falls back to cryptogram amount plus surcharge."""
    products = spark.createDataFrame([("X", 1, 11, "VISA"), ("C", 3, 13, "VISA")], "product_code string, range_program_id int, legacy_product_id int, brand string")
    local_files = fixtures.txn(spark, sf_dir).where("file_no = 2 AND direction = 'OUT'").selectExpr("'f' || CAST(file_no AS STRING) AS content_hash")
    switches = spark.createDataFrame([("C1", "VISA", 7)], "customer_code string, brand_code string, switch_id int")
    detail = fee_quota.single_message_detail(
        derived(spark, sf_dir, QUOTA_MESSAGES), CLIENT, brand_rates(spark, sf_dir), products, _types(spark), local_files, switches, currencies(spark)
    )
    return detail.select(
        "app_id", "business_mode_id", "table_description", "business_transaction_type_id", "report_amount", "switch_code", "reversal_indicator", "currency_local_indicator", "account_funding_source"
    )


@query(
    "job_rules_refresh_messages",
    """SELECT CAST(rule_id AS VARCHAR) AS rule_id, CASE WHEN nation % 3 = 0 THEN 'cat' ELSE 'cat P' || nation END AS fee_category, CASE WHEN nation % 2 = 0 THEN 'S/I' ELSE 'T' || nation END AS fee_tier,
       CAST(fix_cents AS DECIMAL(18,8)) AS rate_fixed, CASE WHEN valid_until < DATE '1999-06-01' THEN 'n/a' ELSE CAST(var_bp AS VARCHAR) END AS rate_variable FROM rules""",
    ("rules",),
)
def _message_rules(spark, sf_dir):
    """Rules of messages: validated, labelled and published; a rate of an expired rule need not be a number."""
    sheet = fixtures.rules(spark, sf_dir).selectExpr(
        "CAST(nation AS STRING) AS JURISDICTION", "'2024-01-01' AS GUIDE_DATE", "CAST(valid_from AS STRING) AS VALID_FROM", "CAST(valid_until AS STRING) AS VALID_UNTIL", "CAST(rule_id AS STRING) AS RULE_ID", "'I' AS IRD",
        "CAST(fix_cents AS STRING) AS RATE_FIXED", "CAST(min_cents AS STRING) AS RATE_MIN", "CAST(cap_cents AS STRING) AS RATE_CAP", "CASE WHEN valid_until < DATE '1999-06-01' THEN 'n/a' ELSE CAST(var_bp AS STRING) END AS RATE_VARIABLE",
        "' cat ' AS CATEGORY", "CASE WHEN nation % 3 <> 0 THEN 'P' || CAST(nation AS STRING) END AS PAYMENT_PRODUCT", "CASE WHEN nation % 2 <> 0 THEN 'T' || CAST(nation AS STRING) END AS FEE_TIER",
    )
    root = scratch_path(spark, "message-rules")
    masters.refresh_rules(masters.message_rules(sheet, F.lit("1999-06-01").cast("date")), root, "1")
    published = spark.read.parquet(sinks.current_version(spark, root))
    return published.select("rule_id", "fee_category", "fee_tier", "rate_fixed", "rate_variable")
