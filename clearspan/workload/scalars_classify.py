"""Classification functions (J13-J31)."""

from __future__ import annotations

from pyspark.sql import functions as F

from clearspan import fixtures
from clearspan.functions import classify
from clearspan.operators.columns import copy_columns
from clearspan.sources.readers import split_list
from clearspan.workload.registry import query, scalar

C = F.col
DRAFT_CODE = (
    "CASE CAST(record % 13 AS INT) WHEN 0 THEN '05' WHEN 1 THEN '06' WHEN 2 THEN '07' WHEN 3 THEN '15' WHEN 4 THEN '16' WHEN 5 THEN '17' "
    "WHEN 6 THEN '25' WHEN 7 THEN '26' WHEN 8 THEN '27' WHEN 9 THEN '35' WHEN 10 THEN '36' WHEN 11 THEN '37' ELSE '99' END"
)
MCC = "CASE file_no WHEN 0 THEN 4829 WHEN 1 THEN 6010 WHEN 2 THEN 6011 WHEN 3 THEN 7995 WHEN 4 THEN 5411 WHEN 5 THEN 4815 ELSE NULL END"
REQUEST = "CASE merchant_region WHEN 0 THEN '0200' WHEN 1 THEN '0220' WHEN 2 THEN '0400' WHEN 3 THEN '0420' ELSE '0800' END"
RESPONSE = "CASE WHEN issuer_region = 0 THEN '05' WHEN issuer_region = 4 THEN NULL ELSE '00' END"
PROCESSING = (
    "CASE CAST(record % 14 AS INT) WHEN 0 THEN '00' WHEN 1 THEN '01' WHEN 2 THEN '10' WHEN 3 THEN '11' WHEN 4 THEN '19' WHEN 5 THEN '20' WHEN 6 THEN '22' "
    "WHEN 7 THEN '26' WHEN 8 THEN '29' WHEN 9 THEN '30' WHEN 10 THEN '40' WHEN 11 THEN '50' WHEN 12 THEN '09' ELSE '17' END || '0000'"
)

scalar(
    "class_business_mode",
    {"dc": DRAFT_CODE, "incoming": "direction = 'IN'", "ind": "CASE merchant_region WHEN 0 THEN 'A' WHEN 1 THEN 'I' ELSE 'Z' END", "direction": "CASE WHEN file_no = 0 THEN 'X' ELSE direction END"},
    lambda: [
        classify.business_mode(C("dc"), C("incoming")).alias("by_code"),
        classify.business_mode_of_indicator(C("ind")).alias("by_indicator"),
        classify.business_mode_of_direction(C("direction")).alias("by_direction"),
    ],
    {
        "by_code": "CASE WHEN dc = '99' THEN '' WHEN (dc IN ('05','06','07','25','26','27')) <> incoming THEN 'ACQUIRING' ELSE 'ISSUING' END",
        "by_indicator": "CASE ind WHEN 'A' THEN 'ACQUIRING' WHEN 'I' THEN 'ISSUING' ELSE '' END",
        "by_direction": "CASE direction WHEN 'IN' THEN 'issuing' WHEN 'OUT' THEN 'acquiring' ELSE direction END",
    },
)

scalar(
    "class_transaction_type",
    {
        "dc": DRAFT_CODE, "mcc": MCC, "usage": "CASE WHEN issuer_region = 0 THEN 2 ELSE 1 END",
        "cond": "CASE merchant_region WHEN 0 THEN '7' WHEN 1 THEN '8' WHEN 2 THEN NULL ELSE ' ' END",
        "qual": "CAST(merchant_nation % 3 AS INT)", "incoming": "direction = 'IN'",
        "request": REQUEST, "response": RESPONSE, "processing": PROCESSING,
        "pos": "CASE CAST(merchant_nation % 4 AS INT) WHEN 0 THEN '13' WHEN 1 THEN '51' ELSE '00' END",
    },
    lambda: [
        classify.transaction_type(C("dc"), C("mcc"), C("usage"), C("cond"), C("qual"), C("incoming")).alias("draft_type"),
        classify.transaction_type_of_message(C("request"), C("response"), C("processing"), C("pos"), C("mcc")).alias("message_type"),
    ],
    {
        "draft_type": """CAST(CASE
          WHEN right(dc, 1) = '5' AND incoming AND cond IN ('7','8') THEN 3 WHEN right(dc, 1) = '5' AND incoming AND cond NOT IN ('7','8') THEN 1
          WHEN right(dc, 1) = '5' AND NOT incoming AND mcc NOT IN (4829, 6051, 7995) THEN 1 WHEN right(dc, 1) = '5' AND NOT incoming AND mcc IN (4829, 6051, 7995) THEN 3
          WHEN right(dc, 1) = '7' AND mcc = 6010 THEN 21 WHEN right(dc, 1) = '7' AND mcc = 6011 THEN 22
          WHEN right(dc, 1) = '6' AND usage = 1 AND qual = 2 THEN 25 WHEN right(dc, 1) = '6' AND usage = 1 THEN 19 ELSE 255 END AS INTEGER)""",
        "message_type": """CAST(CASE WHEN request = '0800' THEN NULL
          WHEN response = '00' THEN CASE
            WHEN left(processing, 2) = '01' AND pos = '00' AND mcc IN (6010, 6011) THEN mcc - 5989
            WHEN left(processing, 2) = '30' AND pos = '00' AND mcc = 6011 THEN 247 WHEN left(processing, 2) = '40' AND pos = '00' AND mcc = 6011 THEN 250
            WHEN mcc NOT IN (4815, 6010, 6011) AND pos = '13' AND left(processing, 2) = '22' THEN 20
            WHEN mcc NOT IN (4815, 6010, 6011) AND pos = '00' THEN CASE left(processing, 2) WHEN '00' THEN 1 WHEN '10' THEN 30 WHEN '11' THEN 3 WHEN '19' THEN 115
              WHEN '20' THEN 19 WHEN '26' THEN 25 WHEN '29' THEN 200 WHEN '50' THEN 27 END END
          WHEN response <> '00' AND mcc = 6011 THEN 249 WHEN response <> '00' AND mcc <> 6011 THEN 236 END AS INTEGER)""",
    },
)

scalar(
    "class_transaction_cycle",
    {"dc": DRAFT_CODE, "usage": "CASE merchant_region WHEN 0 THEN 1 WHEN 1 THEN 2 WHEN 2 THEN 9 WHEN 3 THEN 5 ELSE NULL END"},
    lambda: [classify.transaction_cycle(C("dc"), C("usage")).alias("cycle")],
    {
        "cycle": """CAST(CASE WHEN dc IN ('05','06','07') AND usage = 1 THEN 11 WHEN dc IN ('05','06','07') AND usage = 2 THEN 23 WHEN dc IN ('05','06','07') AND usage = 9 THEN 6
          WHEN dc IN ('25','26','27') AND usage = 1 THEN 11 WHEN dc IN ('25','26','27') AND usage = 9 THEN 6 WHEN dc IN ('25','26','27') AND usage = 2 THEN 25
          WHEN dc <> '99' AND left(dc, 1) IN ('1','3') AND usage = 1 THEN 1 WHEN dc <> '99' AND left(dc, 1) IN ('1','3') AND usage = 9 THEN 4 ELSE 255 END AS INTEGER)"""
    },
)

scalar(
    "class_reversal",
    {
        "dc": DRAFT_CODE, "request": REQUEST, "response": RESPONSE,
        "cls": "CASE WHEN direction = 'IN' THEN '1240' ELSE '1442' END",
        "ind": "CASE file_no WHEN 0 THEN NULL WHEN 1 THEN '' ELSE 'R' END",
    },
    lambda: [
        classify.reversal_of_code(C("dc")).alias("by_code"),
        classify.reversal_of_message(C("request"), C("response")).alias("by_message"),
        classify.reversal_of_indicator(C("cls"), C("ind")).alias("by_indicator"),
    ],
    {
        "by_code": "CASE WHEN left(dc, 1) IN ('2', '3') THEN 1 ELSE 0 END",
        "by_message": "CASE WHEN request IN ('0400', '0420') AND response = '00' THEN 1 ELSE 0 END",
        "by_indicator": "(coalesce(ind, '') <> '') = (cls = '1240')",
    },
)

# Some rows have no issuer country, as when no range holds the account.
ISSUER = "CASE WHEN file_no = 6 THEN NULL ELSE issuer_nation END"
ISSUER_REGION = "CASE WHEN file_no = 6 THEN NULL ELSE issuer_region END"
scalar(
    "class_jurisdiction",
    {
        "mc": "merchant_nation", "ic": ISSUER, "mr": "merchant_region", "ir": ISSUER_REGION,
        "bin6": "substr(CAST(acct9 AS STRING), 1, 6)", "bins": "'400000,401047, 401571,419269,434141,,455190'",
        "jc": "CASE WHEN file_no = 0 THEN '00' WHEN file_no = 1 THEN NULL ELSE '01' END",
    },
    lambda: [
        classify.jurisdiction(C("mc") == C("ic"), F.array_contains(split_list(C("bins")), C("bin6")), C("mr"), C("ir")).alias("draft_jurisdiction"),
        classify.jurisdiction_of_settlement(C("jc"), C("mc"), C("ic")).alias("summary_jurisdiction"),
    ],
    {
        "draft_jurisdiction": "CASE WHEN ic IS NULL THEN '' WHEN mc = ic AND bin6 IN ('400000','401047','401571','419269','434141','455190') THEN 'on-us' WHEN mc = ic THEN 'off-us' "
        "WHEN mr = ir THEN 'intraregional' ELSE 'interregional' END",
        "summary_jurisdiction": "CASE WHEN jc = '00' THEN 'interregional' WHEN jc IS NULL OR ic IS NULL THEN '' WHEN mc <> ic THEN 'intraregional' ELSE 'off-us' END",
    },
)

scalar(
    "class_jurisdiction_assigned",
    {"mc": "merchant_nation", "ic": ISSUER, "mr": "merchant_region", "ir": ISSUER_REGION,
     "kind": "CASE file_no WHEN 0 THEN 'intraregional' WHEN 1 THEN 'interregional' WHEN 2 THEN NULL ELSE 'on-us' END"},
    lambda: [
        classify.jurisdiction_assigned(C("mc"), C("ic"), C("mr"), C("ir")).alias("by_country"),
        classify.jurisdiction_assigned_of(C("kind"), C("ic").cast("string"), C("ir").cast("string")).alias("by_kind"),
    ],
    {
        "by_country": "CASE WHEN ic IS NULL THEN '' WHEN mc = ic THEN CAST(mc AS VARCHAR) WHEN mr = ir THEN CAST(ir AS VARCHAR) ELSE '9' END",
        "by_kind": "CASE kind WHEN 'intraregional' THEN CAST(ir AS VARCHAR) WHEN 'interregional' THEN '9' ELSE CAST(ic AS VARCHAR) END",
    },
)

scalar(
    "class_settlement_currency",
    {"kind": "CASE merchant_region WHEN 0 THEN 'on-us' WHEN 1 THEN 'off-us' WHEN 2 THEN NULL ELSE 'intraregional' END", "flag": "CASE WHEN file_no = 0 THEN NULL ELSE CAST(file_no % 3 AS INT) END", "ccy": "ccy"},
    lambda: [
        classify.settlement_report_currency(C("kind"), C("flag"), F.lit("GBP"), F.lit("EUR")).alias("report_ccy"),
        classify.local_or_foreign(C("ccy"), F.lit("GBP")).alias("label"),
    ],
    {"report_ccy": "CASE WHEN kind IN ('on-us', 'off-us') AND flag > 0 THEN 'GBP' ELSE 'EUR' END", "label": "CASE ccy WHEN 'GBP' THEN 'Local' ELSE 'Foreign' END"},
)

scalar(
    "class_group_code",
    {"dc": DRAFT_CODE, "processing": PROCESSING,
     "kind": "CASE CAST(record % 11 AS INT) WHEN 0 THEN 1 WHEN 1 THEN 30 WHEN 2 THEN 27 WHEN 3 THEN 3 WHEN 4 THEN 115 WHEN 5 THEN 19 WHEN 6 THEN 20 WHEN 7 THEN 21 WHEN 8 THEN 22 WHEN 9 THEN 25 ELSE 255 END",
     "rev": "CAST(file_no % 3 AS INT)"},
    lambda: [
        classify.group_of_code(C("dc")).alias("by_code"),
        classify.group_of_processing(C("processing")).alias("by_processing"),
        classify.code_of_type(C("kind"), C("rev")).alias("message_code"),
    ],
    {
        "by_code": "CASE WHEN dc IN ('05','25') THEN 'PUR' WHEN dc IN ('06','26') THEN 'CRD' WHEN dc IN ('07','27') THEN 'CSH' ELSE 'OTH' END",
        "by_processing": "CASE WHEN left(processing, 2) IN ('00','09') THEN 'PUR' WHEN left(processing, 2) = '20' THEN 'CRD' WHEN left(processing, 2) IN ('01','17','50') THEN 'CSH' ELSE 'OTH' END",
        "message_code": "CASE WHEN rev > 1 OR kind = 255 THEN '' ELSE CASE rev WHEN 0 THEN '0' ELSE '2' END || CASE WHEN kind IN (1, 30, 27) THEN '5' WHEN kind IN (3, 115) THEN '6' ELSE '7' END END",
    },
)

scalar(
    "class_card_present",
    {"ind": "CASE file_no WHEN 0 THEN ' ' WHEN 1 THEN NULL WHEN 2 THEN 'x' WHEN 3 THEN '12' ELSE CAST(merchant_nation % 10 AS STRING) END",
     "entry": "'00000' || CAST(merchant_nation % 3 AS STRING) || '6'"},
    lambda: [
        classify.card_present_of_indicator(C("ind")).alias("by_indicator"),
        classify.card_present_of_entry_mode(C("entry")).alias("by_entry_mode"),
        classify.remote_order_flag(C("ind")).alias("remote_flag"),
    ],
    {
        "by_indicator": "CASE WHEN ind = ' ' THEN 'CPR' WHEN length(ind) = 1 AND ind BETWEEN '1' AND '9' THEN 'CNP' ELSE 'UNK' END",
        "by_entry_mode": "CASE substr(entry, 6, 1) WHEN '1' THEN 'CPR' WHEN '0' THEN 'CNP' ELSE 'UNK' END",
        "remote_flag": "CASE WHEN TRY_CAST(nullif(trim(ind), '') AS INTEGER) < 10 THEN 0 ELSE 1 END",
    },
)

scalar(
    "class_token_requestor",
    {"sd": "CASE file_no WHEN 0 THEN NULL WHEN 1 THEN 0 ELSE record END", "sp": "CASE merchant_region WHEN 0 THEN NULL WHEN 1 THEN 0 ELSE 5 END",
     "req": "CASE file_no WHEN 0 THEN NULL WHEN 1 THEN ' 50110000' WHEN 2 THEN '' ELSE CAST(acct9 AS STRING) END"},
    lambda: [classify.token_requestor(C("sd"), C("sp")).alias("requestor"), classify.token_flag(C("req")).alias("flag")],
    {
        "requestor": "CASE WHEN sd IS NULL AND sp IS NULL THEN 'BLANK' WHEN coalesce(sd, 0) <> 0 OR coalesce(sp, 0) <> 0 THEN 'VALID' ELSE 'INVALID' END",
        "flag": "CASE WHEN req IS NULL THEN 'BLANK' WHEN left(trim(req), 3) = '501' THEN '1' ELSE '0' END",
    },
)

scalar(
    "class_travel_micropayment",
    {
        "mcc": "CASE file_no WHEN 0 THEN 5411 WHEN 1 THEN 3500 WHEN 2 THEN 7011 WHEN 3 THEN 5499 ELSE 9999 END",
        "kind": "CASE WHEN merchant_region = issuer_region THEN 'off-us' ELSE 'intraregional' END",
        "prod": "CASE merchant_region WHEN 0 THEN 'X' WHEN 1 THEN 'MTP' WHEN 2 THEN 'MBS' WHEN 3 THEN 'MTA' ELSE 'F2' END",
        "ind": "CASE WHEN direction = 'IN' THEN '5' ELSE ' ' END", "amount": "CAST(amount_cents % 25 AS INT)",
        "terminals": "CASE WHEN issuer_region = 0 THEN NULL ELSE issuer_region END", "activity": "CASE WHEN direction = 'IN' THEN 'BB' ELSE 'CC' END",
        "entry": "'000000' || CAST(merchant_nation % 7 AS STRING)", "country": "CASE issuer_region WHEN 0 THEN 'GRC' WHEN 1 THEN 'USA' ELSE 'LTU' END",
        "ccy": "ccy", "dcc": "CASE file_no WHEN 0 THEN NULL WHEN 1 THEN '1' ELSE '0' END",
    },
    lambda: [
        classify.travel_program(C("prod")).alias("travel"),
        classify.travel_program_of_message(C("activity"), C("prod"), C("mcc")).alias("travel_message"),
        classify.micropayment(C("mcc"), C("kind"), C("prod"), C("ind"), C("amount"), C("terminals")).alias("micropayment"),
        classify.key_entered(C("entry"), C("kind"), C("country")).alias("key_entered"),
        classify.currency_is_local(C("ccy"), F.lit("GBP"), C("dcc")).alias("local_ccy"),
    ],
    {
        "travel": "CASE WHEN prod = 'X' THEN 1 ELSE 0 END",
        "travel_message": "CASE WHEN activity = 'BB' AND (prod = 'MTA' OR (prod = 'MBS' AND mcc IN (3500, 7011))) THEN 1 ELSE 0 END",
        "micropayment": "CASE WHEN mcc IN (5411, 5499) AND kind = 'off-us' AND prod = 'F2' AND amount <= CASE WHEN ind = '5' THEN 10 ELSE 20 END AND coalesce(terminals, 0) <= 3 THEN 1 ELSE 0 END",
        "key_entered": "CASE WHEN right(entry, 1) = '6' AND kind = 'intraregional' AND country IN ('GRC', 'LTU') THEN 1 ELSE 0 END",
        "local_ccy": "CASE WHEN ccy = 'GBP' OR coalesce(dcc, '0') <> '1' THEN 1 ELSE 0 END",
    },
)

scalar(
    "class_funding_source",
    {"src": "CASE file_no WHEN 0 THEN 'C' WHEN 1 THEN 'H' WHEN 2 THEN 'R' WHEN 3 THEN 'D' WHEN 4 THEN 'P' WHEN 5 THEN 'Q' ELSE NULL END"},
    lambda: [classify.funding_group(C("src")).alias("funding")],
    {"funding": "CASE src WHEN 'C' THEN 'C' WHEN 'H' THEN 'C' WHEN 'R' THEN 'C' WHEN 'D' THEN 'D' WHEN 'P' THEN 'D' END"},
)

scalar(
    "class_scope",
    {
        "svc": "CASE WHEN file_no = 0 THEN NULL ELSE CAST(record % 10 AS INT) END", "ind": "CASE WHEN direction = 'IN' THEN 'C' ELSE 'M' END",
        "juris": "CASE merchant_region WHEN 0 THEN 'interregional' WHEN 1 THEN 'intra country' WHEN 2 THEN 'off-us' ELSE 'else' END",
        "country": "CASE WHEN issuer_nation = 3 THEN 90 ELSE issuer_nation END", "area": "CASE WHEN issuer_region = 2 THEN 1 ELSE 0 END",
        "local_file": "file_no = 2", "sw": "CASE WHEN merchant_region = 0 THEN NULL ELSE merchant_region END",
    },
    lambda: [
        classify.report_scope(C("svc"), C("ind"), C("juris"), C("country"), C("area")).alias("scope"),
        classify.merchant_report_scope(classify.report_scope(C("svc"), C("ind"), C("juris"), C("country"), C("area")), C("country"), C("area")).alias("printed_scope"),
        classify.switch_code(C("local_file"), C("sw")).alias("switch_code"),
    ],
    {
        "scope": """CAST(CASE WHEN svc = 4 AND ind = 'C' THEN 1 WHEN svc = 4 THEN 2 WHEN svc IN (2, 3) THEN 4 WHEN svc IN (1, 8) THEN 8 WHEN juris = 'interregional' THEN 8
          WHEN juris = 'intra country' THEN 4 WHEN juris = 'off-us' THEN 2 WHEN country = 90 THEN 2 WHEN area = 1 THEN 4 ELSE 8 END AS INTEGER)""",
        "printed_scope": """CAST(CASE WHEN svc = 4 AND ind = 'C' THEN 1 WHEN country = 90 THEN CASE WHEN (svc = 4) OR (coalesce(svc, 0) NOT IN (1, 2, 3, 4, 8) AND juris IN ('off-us', 'else')) THEN 2 ELSE 4 END
          WHEN area = 1 THEN 4 ELSE 8 END AS INTEGER)""",
        "switch_code": "CASE WHEN local_file THEN coalesce(sw, 0) ELSE 0 END",
    },
)

scalar(
    "class_txn_type_label",
    {"label": "CASE file_no WHEN 0 THEN ' pur' WHEN 1 THEN 'CSH' WHEN 2 THEN '12' WHEN 3 THEN 'abc' ELSE NULL END", "pc": "CASE WHEN merchant_region = 0 THEN '20' ELSE '0' END"},
    lambda: [classify.type_id_of_label(C("label"), C("pc")).alias("type_id")],
    {"type_id": "CAST(CASE WHEN pc = '20' THEN 1 WHEN upper(trim(label)) = 'PUR' THEN 1 WHEN label = 'CSH' THEN 8 ELSE TRY_CAST(label AS INTEGER) END AS INTEGER)"},
)


@query(
    "array_prefix_explode",
    "SELECT range_id, unnest(generate_series(low_key // 1000000, high_key // 1000000)) AS bucket FROM acct_range",
    ("acct_range",),
)
def _prefixes(spark, sf_dir):
    rows = fixtures.acct_range(spark, sf_dir)
    first, last = (F.call_function("div", C(c), F.lit(1_000_000).cast("bigint")) for c in ("low_key", "high_key"))
    return rows.select("range_id", F.explode(F.sequence(first, last)).alias("bucket"))


scalar(
    "array_exists_lambda",
    {"list": "'05,15, 25 ,' || CAST(merchant_nation AS STRING)", "code": "code", "n": "merchant_nation"},
    lambda: [
        F.exists(F.split("list", ","), lambda t: F.trim(t) == C("code")).alias("listed"),
        F.exists(F.split("list", ","), lambda t: F.coalesce(t.try_cast("int") > 20, F.lit(False))).alias("any_large"),
    ],
    {"listed": "code IN ('05', '15', '25')", "any_large": "true"},
)

scalar(
    "array_split_list",
    {"bins": "CASE file_no WHEN 0 THEN NULL WHEN 1 THEN ' , ' ELSE ' ' || code || ',x, ' || priority || ',' END", "code": "code", "file_no": "file_no", "priority": "priority"},
    lambda: [
        F.size(split_list(C("bins"))).alias("n"),
        F.array_join(split_list(C("bins")), "|").alias("joined"),
    ],
    {
        "n": "CAST(CASE WHEN file_no < 2 THEN 0 WHEN code = '' THEN 2 ELSE 3 END AS INTEGER)",
        "joined": "CASE WHEN file_no < 2 THEN '' WHEN code = '' THEN 'x|' || priority ELSE code || '|x|' || priority END",
    },
)


@query(
    "copy_derived_columns",
    "SELECT record, merchant_nation AS jurisdiction_country, issuer_nation AS issuer_country, ccy AS source_currency, 110 AS report_type, 'VI' AS brand FROM txn",
    ("txn",),
)
def _copies(spark, sf_dir):
    copies = {"jurisdiction_country": "merchant_nation", "issuer_country": "issuer_nation", "source_currency": "ccy"}
    rows = copy_columns(fixtures.txn(spark, sf_dir), copies, {"report_type": 110, "brand": "VI"})
    return rows.select("record", *copies, "report_type", "brand")
