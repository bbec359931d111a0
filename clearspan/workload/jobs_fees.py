"""Calculation and fee jobs (M1-M4) and message decoding (L)."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from clearspan import fixtures
from clearspan.functions.message import decode_messages
from clearspan.plans import fees, mc_calculate, visa_calculate
from clearspan.plans.visa_calculate import Client
from clearspan.workload.joins import RULE_MATCH, fx_rates
from clearspan.workload.registry import query
from clearspan.workload.scalars_classify import DRAFT_CODE, MCC, PROCESSING, REQUEST, RESPONSE
from clearspan.workload.windows import FIRST_RULE_SQL

C = F.col
CLIENT = Client(
    code="C1", local_currency="GBP", settlement_currency="EUR", report_currency="EUR", country="GRC",
    issuing_bins_6=["400000", "401047", "419269"], issuing_bins_8=["45519000", "43414100"], acquiring_bins=["000003", "000005"],
)


def currencies(spark):
    return spark.createDataFrame(
        [("978", "EUR", 2), ("840", "USD", 2), ("826", "GBP", 2), ("392", "JPY", 0)], "currency_numeric_code string, currency_alphabetic_code string, decimals int"
    )


def countries(spark, sf_dir):
    """Two- and three-letter codes, regions of both schemes and ids, from nations."""
    return fixtures.table(spark, sf_dir, "nation").selectExpr(
        "'N' || CAST(n_nationkey AS STRING) AS country_code", "'NN' || CAST(n_nationkey AS STRING) AS country_code_alternative",
        "CAST(n_regionkey AS STRING) AS visa_region_code", "CAST(n_regionkey AS STRING) AS mastercard_region_code", "n_nationkey AS legacy_country_id",
    )


NUMERIC = "CASE ccy WHEN 'EUR' THEN '978' WHEN 'USD' THEN '840' WHEN 'GBP' THEN '826' ELSE '392' END"
DRAFTS = {
    "content_hash": "'f' || CAST(file_no AS STRING)", "record": "record", "file_type": "direction", "file_date": "processing_date",
    "account_number": "CAST(acct9 AS STRING) || '***0000'", "merchant_country_code": "'N' || CAST(merchant_nation AS STRING)", "draft_code": DRAFT_CODE,
    "merchant_category_code": MCC, "usage_code": "CAST(1 + file_no % 2 * 8 AS INT)", "draft_code_qualifier_0": "CAST(merchant_nation % 3 AS INT)",
    "special_condition_indicator_merchant_draft_indicator": "CASE merchant_region WHEN 0 THEN '7' ELSE ' ' END", "source_currency_code": NUMERIC,
    "purchase_date": "purchase_date", "central_processing_date": "processing_date", "settlement_flag": "CAST(file_no % 3 AS INT)",
    "authorization_code": "CASE WHEN file_no = 1 THEN '100000' ELSE 'ABC12' END", "business_format_code_cr": "CASE WHEN file_no = 2 THEN 'CR' ELSE ' ' END",
    "business_format_code_df": "'DF'", "business_application_id_ft": "CASE WHEN file_no = 3 THEN ' PP ' END", "message_reason_code_sd": "'57'",
    "collection_only_flag": "CASE WHEN file_no = 4 THEN 'C' ELSE ' ' END", "account_reference_number_acquiring_identifier": "file_no",
    "surcharge_amount_df": "CAST(merchant_nation AS DECIMAL(18,4))", "surcharge_amount_sp": "CAST(issuer_nation AS DECIMAL(18,4))",
    "token_requestor_id_sd": "CASE WHEN file_no > 4 THEN file_no - 5 END",
}
RANGES = [
    "CAST(low_key AS STRING) AS low_key_for_range", "CAST(high_key AS STRING) AS table_key", "date_format(effective_date, 'yyyyMMdd') AS effective_date",
    "CASE WHEN range_nation = 24 THEN 'D' ELSE ' ' END AS delete_indicator", "'N' || CAST(range_nation AS STRING) AS ardef_country", "'N' || CAST(range_nation AS STRING) AS country",
    "product AS product_id", "CASE WHEN range_nation > 12 THEN 'C' ELSE 'D' END AS account_funding_source", "CAST(range_id AS STRING) AS product_subtype",
]


def text_ranges(spark, sf_dir):
    return visa_calculate.active_ranges(fixtures.acct_range(spark, sf_dir).selectExpr(*RANGES))


def derived(spark, sf_dir, columns: dict[str, str]):
    return fixtures.txn(spark, sf_dir).selectExpr(*[f"{e} AS `{c}`" for c, e in columns.items()])


def _inputs(columns: dict[str, str]) -> str:
    return "SELECT *, " + ", ".join(f"{e} AS \"i_{c}\"" for c, e in columns.items()) + " FROM txn"


BEST_TEXT_RANGE = """best AS (SELECT * FROM (SELECT t.record, r.*, row_number() OVER (PARTITION BY t.record ORDER BY r.effective_date DESC, r.high_key DESC, r.low_key) AS n FROM t
  JOIN acct_range r ON t.acct9 BETWEEN r.low_key AND r.high_key AND r.effective_date <= t.processing_date AND r.range_nation <> 24) WHERE n = 1)"""
_COMMON_SQL = """'N' || b.range_nation AS ardef_country, CAST(NULL AS VARCHAR) AS b2b_program_id, CAST(NULL AS VARCHAR) AS fast_funds,
  CASE WHEN b.range_nation > 12 THEN 'C' WHEN b.range_nation IS NOT NULL THEN 'D' END AS funding_source, left(CAST(acct9 AS VARCHAR), 8) AS issuer_bin_8, 'N' || b.range_nation AS issuer_country,
  CAST(n.n_regionkey AS VARCHAR) AS issuer_region, 'N' || merchant_nation AS jurisdiction_country, CAST(merchant_region AS VARCHAR) AS jurisdiction_region, CAST(NULL AS VARCHAR) AS nnss_indicator,
  b.product AS product_id, CAST(b.range_id AS VARCHAR) AS product_subtype, CAST(NULL AS VARCHAR) AS technology_indicator, CAST(NULL AS VARCHAR) AS travel_indicator, ccy AS source_currency_code_alphabetic,
  CASE WHEN b.range_nation IS NULL THEN '' WHEN merchant_nation = b.range_nation THEN 'N' || merchant_nation WHEN merchant_region = n.n_regionkey THEN CAST(n.n_regionkey AS VARCHAR) ELSE '9' END AS jurisdiction_assigned"""
_WORKING_DAYS = """CASE WHEN processing_date = purchase_date THEN 0 ELSE (SELECT count(*) FROM (SELECT unnest(generate_series(purchase_date + 1, processing_date - 1, INTERVAL 1 DAY)) AS g) WHERE dayofweek(g) <> 0) END"""


@query(
    "job_visa_calculate",
    f"""SELECT *, CASE WHEN jurisdiction IN ('on-us', 'off-us') AND "file_no" % 3 <> 0 THEN 'GBP' ELSE 'EUR' END AS settlement_report_currency_code FROM (
     SELECT file_no, i_content_hash AS content_hash, t.record, {_COMMON_SQL}, CASE WHEN file_no = 1 THEN 'INVALID' ELSE 'VALID' END AS authorization_code_valid,
      CASE WHEN file_no = 3 THEN 'PP' END AS business_application_id, CASE WHEN file_no = 2 THEN 'CR' ELSE 'DF' END AS business_format_code,
      CASE WHEN i_draft_code = '99' THEN '' WHEN (left(i_draft_code, 1) IN ('0', '2')) <> (direction = 'IN') THEN 'ACQUIRING' ELSE 'ISSUING' END AS business_mode,
      CAST(CASE WHEN right(i_draft_code, 1) = '5' AND direction = 'IN' THEN CASE WHEN merchant_region = 0 THEN 3 ELSE 1 END
        WHEN right(i_draft_code, 1) = '5' THEN CASE WHEN i_merchant_category_code IN (4829, 7995) THEN 3 WHEN i_merchant_category_code IS NOT NULL THEN 1 ELSE 255 END
        WHEN right(i_draft_code, 1) = '7' THEN CASE i_merchant_category_code WHEN 6010 THEN 21 WHEN 6011 THEN 22 ELSE 255 END
        WHEN right(i_draft_code, 1) = '6' AND file_no % 2 = 0 THEN CASE WHEN merchant_nation % 3 = 2 THEN 25 ELSE 19 END ELSE 255 END AS INTEGER) AS business_transaction_type,
      CAST(CASE WHEN i_draft_code = '99' THEN 255 WHEN left(i_draft_code, 1) = '0' OR i_draft_code IN ('25','26','27') THEN CASE WHEN file_no % 2 = 0 THEN 11 ELSE 6 END ELSE CASE WHEN file_no % 2 = 0 THEN 1 ELSE 4 END END AS INTEGER) AS business_transaction_cycle,
      CASE WHEN b.range_nation IS NULL THEN '' WHEN merchant_nation = b.range_nation THEN CASE WHEN file_no = 4 OR (direction = 'IN' AND file_no IN (3, 5)) OR (direction = 'OUT' AND (left(CAST(acct9 AS VARCHAR), 6) IN ('400000', '401047', '419269')
        OR left(CAST(acct9 AS VARCHAR), 8) IN ('45519000', '43414100'))) THEN 'on-us' ELSE 'off-us' END WHEN merchant_region = n.n_regionkey THEN 'intraregional' ELSE 'interregional' END AS jurisdiction,
      '57' AS message_reason_code, CAST(NULL AS VARCHAR) AS network_identification_code, CASE WHEN left(i_draft_code, 1) IN ('2', '3') THEN 1 ELSE 0 END AS reversal_indicator,
      CAST(greatest(merchant_nation, issuer_nation) AS DECIMAL(18,4)) AS surcharge_amount, {_WORKING_DAYS} AS timeliness,
      CASE WHEN file_no < 5 THEN 'BLANK' WHEN file_no = 5 THEN 'INVALID' ELSE 'VALID' END AS token_requestor_id, CAST(NULL AS VARCHAR) AS type_of_purchase
     FROM t LEFT JOIN best b ON t.record = b.record LEFT JOIN nation n ON b.range_nation = n.n_nationkey)""".replace("SELECT *, CASE WHEN jurisdiction", "SELECT * EXCLUDE (file_no), CASE WHEN jurisdiction"),
    ("txn", "acct_range"),
    f"t AS ({_inputs(DRAFTS)}), {BEST_TEXT_RANGE}",
)
def _visa_calculate(spark, sf_dir):
    return visa_calculate.draft_fields(derived(spark, sf_dir, DRAFTS), text_ranges(spark, sf_dir), countries(spark, sf_dir), currencies(spark), CLIENT)


MESSAGES = {
    "content_hash": "'f' || CAST(file_no AS STRING)", "record": "record", "file_date": "processing_date", "card_number": "CAST(acct9 AS STRING) || '1234567'",
    "card_acceptor_country": "'N' || CAST(merchant_nation AS STRING)", "draft_currency_code": NUMERIC, "draft_amount": "CAST(amount_cents * CAST('0.01' AS DECIMAL(3,2)) AS DECIMAL(18,2))",
    "issuer_acquirer_indicator": "CASE WHEN direction = 'IN' THEN 'I' ELSE 'A' END", "request_message_type": REQUEST, "response_code": RESPONSE, "processing_code": PROCESSING,
    "pos_condition_code": "'00'", "merchant's_type": MCC, "acquiring_institution_id_1": "file_no", "retrieval_reference_number": "'R' || CAST(acct9 AS STRING)",
    "authorization_id_resp_code": "priority", "local_draft_date": "purchase_date", "settlement_date_sms": "processing_date",
}


@query(
    "job_visa_calculate_messages",
    f"""SELECT *, CASE WHEN business_transaction_type IN (1, 30, 27) THEN CASE reversal_indicator WHEN 0 THEN '05' ELSE '25' END WHEN business_transaction_type IN (3, 115) THEN CASE reversal_indicator WHEN 0 THEN '06' ELSE '26' END
      WHEN business_transaction_type IN (19, 20, 21, 22, 25) THEN CASE reversal_indicator WHEN 0 THEN '07' ELSE '27' END ELSE '' END AS transaction_code_sms FROM (
     SELECT i_content_hash AS content_hash, t.record, 'R' || left(CAST(acct9 AS VARCHAR), 5) AS acquirer_bin, {_COMMON_SQL}, 'VALID' AS authorization_code_valid,
      CASE direction WHEN 'IN' THEN 'ISSUING' ELSE 'ACQUIRING' END AS business_mode, CAST(NULL AS INTEGER) AS business_transaction_cycle,
      CAST(CASE WHEN i_request_message_type = '0800' THEN NULL WHEN i_response_code = '00' THEN CASE WHEN left(i_processing_code, 2) = '01' AND i_mcc IN (6010, 6011) THEN i_mcc - 5989
         WHEN left(i_processing_code, 2) = '30' AND i_mcc = 6011 THEN 247 WHEN left(i_processing_code, 2) = '40' AND i_mcc = 6011 THEN 250
         WHEN i_mcc NOT IN (4815, 6010, 6011) THEN CASE left(i_processing_code, 2) WHEN '00' THEN 1 WHEN '10' THEN 30 WHEN '11' THEN 3 WHEN '19' THEN 115 WHEN '20' THEN 19 WHEN '26' THEN 25 WHEN '29' THEN 200 WHEN '50' THEN 27 END END
        WHEN i_response_code <> '00' AND i_mcc = 6011 THEN 249 WHEN i_response_code <> '00' AND i_mcc <> 6011 THEN 236 END AS INTEGER) AS business_transaction_type,
      CASE WHEN b.range_nation IS NULL THEN '' WHEN merchant_nation = b.range_nation THEN CASE WHEN (direction = 'IN' AND file_no IN (3, 5)) OR (direction = 'OUT' AND (left(CAST(acct9 AS VARCHAR), 6) IN ('400000', '401047', '419269')
        OR left(CAST(acct9 AS VARCHAR), 8) IN ('45519000', '43414100'))) THEN 'on-us' ELSE 'off-us' END WHEN merchant_region = n.n_regionkey THEN 'intraregional' ELSE 'interregional' END AS jurisdiction,
      left(i_processing_code, 2) AS processing_code_transaction_type, CASE WHEN i_request_message_type IN ('0400', '0420') AND i_response_code = '00' THEN 1 ELSE 0 END AS reversal_indicator,
      i_draft_amount AS source_amount, CAST(processing_date - purchase_date AS BIGINT) AS timeliness
     FROM t LEFT JOIN best b ON t.record = b.record LEFT JOIN nation n ON b.range_nation = n.n_nationkey)""",
    ("txn", "acct_range"),
    f"""t AS ({_inputs(MESSAGES).replace("i_merchant's_type", "i_mcc")}), {BEST_TEXT_RANGE}""",
)
def _visa_messages(spark, sf_dir):
    return visa_calculate.message_fields(derived(spark, sf_dir, MESSAGES), text_ranges(spark, sf_dir), countries(spark, sf_dir), currencies(spark), CLIENT)


@query(
    "job_visa_calculate_summaries",
    """SELECT 'h' AS content_hash, reporting_id AS record, CAST(130 AS BIGINT) AS vss_report_type, CAST(CASE WHEN rollup_id = reporting_id THEN 10 WHEN reporting_id < 5 THEN 1 ELSE 0 END AS BIGINT) AS vss_aggregation_level FROM sre""",
    ("sre",),
)
def _visa_summaries(spark, sf_dir):
    rows = fixtures.sre(spark, sf_dir).selectExpr("'h' AS content_hash", "reporting_id AS record", "rollup_id AS rollup_to_sre_identifier_130", "reporting_id AS reporting_for_sre_identifier_130")
    return visa_calculate.summary_fields(rows, "130")


def two_way_rates(spark, sf_dir):
    """Rates to EUR, and back at a fixed rate on the same days."""
    there = fx_rates(spark, sf_dir)
    back = there.select("rate_date", C("to_ccy").alias("from_ccy"), C("from_ccy").alias("to_ccy"), F.lit("1.25").cast("decimal(18,10)").alias("rate"))
    return there.unionByName(back)


TEXT_RULES = [
    "CAST(nation AS STRING) AS region_country_code", "rule_id", "code_cond AS transaction_code", "'>=' || CAST(amount_min_cents DIV 100 AS STRING) AS transaction_amount", "'EUR' AS transaction_amount_currency",
    "valid_from", "valid_until", "CAST(rule_id AS STRING) AS fee_descriptor", "'EUR' AS fee_currency", "var_bp * CAST('0.0001' AS DECIMAL(5,4)) AS fee_variable",
    "fix_cents * CAST('0.01' AS DECIMAL(3,2)) AS fee_fixed", "min_cents * CAST('0.01' AS DECIMAL(3,2)) AS fee_min", "cap_cents * CAST('0.01' AS DECIMAL(3,2)) AS fee_cap",
    "'nan' AS cvv2_result_code", "CASE WHEN nation = 7 THEN 'NO' END AS cashback",
]
_EUR = "CASE WHEN t.ccy = 'EUR' THEN CAST(t.amount AS DECIMAL(24,6)) ELSE CAST(CAST(t.amount AS DECIMAL(28,4)) * CAST(f.rate_ppm * CAST('0.000001' AS DECIMAL(7,6)) AS DECIMAL(18,10)) AS DECIMAL(24,6)) END"
_FEE_T = f"""t AS (SELECT t.*, {_EUR} AS eur, CASE WHEN t.ccy = 'EUR' THEN CAST(1 AS DECIMAL(18,10)) WHEN f.rate_ppm IS NOT NULL THEN CAST('1.25' AS DECIMAL(18,10)) END AS fx FROM
  (SELECT *, CAST(amount_cents * CAST('0.01' AS DECIMAL(3,2)) AS DECIMAL(18,4)) AS amount FROM txn) t LEFT JOIN fx f ON f.rate_date = t.purchase_date AND f.from_ccy = t.ccy)"""
_FEE_MATCH = """r.nation = t.merchant_nation AND r.valid_from <= t.purchase_date AND coalesce(r.valid_until, t.purchase_date) >= t.purchase_date AND (r.amount_min_cents IS NULL OR t.eur >= r.amount_min_cents // 100)
  AND CASE r.code_cond WHEN '' THEN true WHEN '05,06' THEN t.code IN ('05','06') WHEN 'NOT:07' THEN t.code <> '07' ELSE coalesce(TRY_CAST(t.code AS INTEGER) BETWEEN 6 AND 20, false) END"""


def _bounded(base: str) -> str:
    low, high = (f"CAST(r.{c} * CAST('0.01' AS DECIMAL(3,2)) * t.fx AS DECIMAL(34,14))" for c in ("min_cents", "cap_cents"))
    return f"CAST(least(greatest({base}, {low}), {high}) AS DECIMAL(34,14))"


_VARIABLE = "CAST(CAST(t.amount AS DECIMAL(28,4)) * (r.var_bp * CAST('0.0001' AS DECIMAL(5,4))) AS DECIMAL(34,14))"
_FIXED = "CAST(r.fix_cents * CAST('0.01' AS DECIMAL(3,2)) * t.fx AS DECIMAL(34,14))"


def _rate8(c: str) -> str:
    return f"CAST({c} AS DECIMAL(14,8))"


@query(
    "job_visa_fee",
    f"""SELECT 'f' || t.file_no AS content_hash, t.record, CAST(coalesce(m.rule_id, -1) AS INTEGER) AS interchange_rule_id, coalesce(CAST(m.rule_id AS VARCHAR), '') AS interchange_fee_descriptor, CASE WHEN m.rule_id IS NULL THEN '' ELSE 'EUR' END AS interchange_fee_currency,
      {_rate8("coalesce(r.var_bp * CAST('0.0001' AS DECIMAL(5,4)), 0)")} AS interchange_fee_variable, {_rate8("coalesce(r.fix_cents * CAST('0.01' AS DECIMAL(3,2)), 0)")} AS interchange_fee_fixed,
      {_rate8("CASE WHEN m.rule_id IS NULL THEN 0 ELSE r.min_cents * CAST('0.01' AS DECIMAL(3,2)) END")} AS interchange_fee_min, {_rate8("CASE WHEN m.rule_id IS NULL THEN 0 ELSE r.cap_cents * CAST('0.01' AS DECIMAL(3,2)) END")} AS interchange_fee_cap,
      CASE WHEN m.rule_id IS NULL THEN CAST(0 AS DECIMAL(34,14)) ELSE {_bounded(f"{_VARIABLE} + coalesce({_FIXED}, CAST(0 AS DECIMAL(34,14)))")} END AS interchange_fee_amount
      FROM t LEFT JOIN m ON t.record = m.record LEFT JOIN rules r ON m.rule_id = r.rule_id""",
    ("txn", "fx", "rules"),
    f"{_FEE_T}, m AS (SELECT t.record, min(r.rule_id) AS rule_id FROM t JOIN rules r ON {_FEE_MATCH} GROUP BY t.record)",
)
def _visa_fee(spark, sf_dir):
    cleaned = derived(spark, sf_dir, {
        "content_hash": "'f' || CAST(file_no AS STRING)", "record": "record", "draft_code": "code", "source_amount": "CAST(amount_cents * CAST('0.01' AS DECIMAL(3,2)) AS DECIMAL(18,4))",
        "file_date": "purchase_date", "cashback": "CASE WHEN direction = 'IN' THEN 0 END", "jurisdiction_assigned": "'overwritten'",
    })
    calculated = derived(spark, sf_dir, {"content_hash": "'f' || CAST(file_no AS STRING)", "record": "record", "jurisdiction_assigned": "CAST(merchant_nation AS STRING)", "source_currency_code_alphabetic": "ccy"})
    table = fixtures.rules(spark, sf_dir).selectExpr(*TEXT_RULES)
    return fees.text_fees(cleaned, calculated, table, two_way_rates(spark, sf_dir), "draft")


MC_RANGES = [
    "CAST(low_key AS STRING) || '0000000000' AS low_range", "CAST(high_key AS STRING) || '9999999999' AS high_range", "CASE WHEN range_nation = 24 THEN 'I' ELSE 'A ' END AS active_inactive_code",
    "CAST(effective_date AS STRING) || ' 00:00:00.000' AS app_date_valid", "CAST(range_id % 90 AS STRING) AS card_program_priority", "'NN' || CAST(range_nation AS STRING) AS card_country_alpha",
    "product AS licensed_product_id", "'P' || CAST(range_id AS STRING) AS card_program_identifier",
]
MC_MESSAGES = {
    "file_id": "'F' || CAST(file_no AS STRING)", "file_idn": "CAST(merchant_region AS STRING)", "ref_id": "record", "file_type": "direction", "file_dt": "substr(replace(CAST(purchase_date AS STRING), '-', ''), 1, 8)",
    "type_mti": "CASE WHEN file_no = 0 THEN '1442' WHEN file_no = 1 THEN '1740' ELSE '1240' END", "pan_de_2": "CASE WHEN file_no = 5 THEN 'X' ELSE '' END || CAST(acct9 AS STRING) || '0000000'", "acquirer_reference_data_de_31": "'2' || lpad(CAST(file_no AS STRING), 6, '0')",
    "card_acceptor_country_code_de_43_6": "'NN' || CAST(merchant_nation AS STRING)", "settlement_indicator_1_pds_165_1": "CASE WHEN file_no = 4 THEN 'c' END",
    "amount_transaction_de_4": "CAST(amount_cents * CAST('0.01' AS DECIMAL(3,2)) AS DECIMAL(18,4))", "amount_reconciliation_de_5": "CAST(amount_cents * CAST('0.02' AS DECIMAL(3,2)) AS DECIMAL(18,4))",
    "currency_code_transaction_de_49": NUMERIC, "currency_code_reconciliation_de_50": "CASE WHEN file_no < 99 THEN '826' ELSE '978' END", "message_number_de_71": "CAST(record % 100 AS STRING)", "content_hash": "md5(CAST(file_no AS STRING))",
}


@query(
    "job_mc_calculate",
    """SELECT 'F' || file_no AS file_id, x.record AS ref_id, CAST(merchant_region AS VARCHAR) AS file_idn, 'C1' AS client_id, strftime(purchase_date, '%Y%m%d') AS file_dt, mti AS type_mti, CASE direction WHEN 'IN' THEN 'issuing' ELSE 'acquiring' END AS business_mode,
       jurisdiction, 'N' || b_nation AS jurisdiction_country, CAST(b_region AS VARCHAR) AS jurisdiction_region, 'fund' || right(product, 1) AS funding_source, product || '/G' AS gcms_product_identifier, 'P' || range_id AS card_program_identifier,
       CASE jurisdiction WHEN 'intraregional' THEN CAST(b_region AS VARCHAR) WHEN 'interregional' THEN '9' ELSE 'N' || b_nation END AS jurisdiction_assigned,
       CASE WHEN mti <> '1740' THEN CASE WHEN direction = 'IN' THEN 'GBP' WHEN jurisdiction IN ('on-us', 'off-us') AND ccy = 'GBP' THEN 'GBP' ELSE 'EUR' END END AS settlement_report_currency_code,
       CASE WHEN mti <> '1740' THEN CASE WHEN direction = 'IN' THEN CAST(amount_cents * CAST('0.02' AS DECIMAL(3,2)) AS DECIMAL(18,4)) WHEN jurisdiction IN ('on-us', 'off-us') AND ccy = 'GBP' THEN CAST(amount_cents * CAST('0.01' AS DECIMAL(3,2)) AS DECIMAL(18,4))
         WHEN ccy = 'EUR' THEN CAST(amount_cents * CAST('0.01' AS DECIMAL(3,2)) AS DECIMAL(18,4)) ELSE CAST(round(CAST(amount_cents * CAST('0.01' AS DECIMAL(3,2)) AS DECIMAL(28,4)) * CAST(rate_ppm * CAST('0.000001' AS DECIMAL(7,6)) AS DECIMAL(18,10)), 4) AS DECIMAL(18,4)) END END AS settlement_report_amount,
       'NN' || b_nation AS iar_country, CAST(CASE WHEN x.record % 100 IN (SELECT n_nationkey FROM nation WHERE n_regionkey = x.merchant_region) THEN 1 ELSE 0 END AS BIGINT) AS exclude_flag, md5(CAST(file_no AS VARCHAR)) AS content_hash FROM
       (SELECT t.*, b.range_nation AS b_nation, b.product, b.range_id, n.n_regionkey AS b_region, f.rate_ppm, CASE file_no WHEN 0 THEN '1442' WHEN 1 THEN '1740' ELSE '1240' END AS mti,
         CASE WHEN merchant_nation = b.range_nation THEN CASE WHEN file_no = 4 OR (direction = 'IN' AND file_no IN (3, 5)) OR (direction = 'OUT' AND (left(CAST(acct9 AS VARCHAR), 6) IN ('400000', '401047', '419269') OR left(CAST(acct9 AS VARCHAR), 8) IN ('45519000', '43414100'))) THEN 'on-us' ELSE 'off-us' END
           WHEN merchant_region = n.n_regionkey THEN 'intraregional' WHEN merchant_region <> n.n_regionkey THEN 'interregional' END AS jurisdiction
        FROM txn t LEFT JOIN best b ON t.record = b.record AND t.file_no <> 5 LEFT JOIN nation n ON b.range_nation = n.n_nationkey LEFT JOIN fx f ON f.rate_date = t.purchase_date AND f.from_ccy = t.ccy) x""",
    ("txn", "acct_range", "fx"),
    """best AS (SELECT * FROM (SELECT t.record, r.*, row_number() OVER (PARTITION BY t.record ORDER BY r.effective_date DESC, r.high_key DESC, r.low_key) AS n FROM txn t
       JOIN acct_range r ON t.acct9 BETWEEN r.low_key AND r.high_key AND r.effective_date <= t.purchase_date AND r.range_nation <> 24) WHERE n = 1)""",
)
def _mc_calculate(spark, sf_dir):
    ranges = fixtures.acct_range(spark, sf_dir)
    products = ranges.select(C("product").alias("licensed_product_id")).distinct().selectExpr(
        "licensed_product_id", "licensed_product_id || '/G' AS gcms_product_id", "'fund' || right(licensed_product_id, 1) AS product_category", "'A' AS active_inactive_code"
    )
    active = mc_calculate.active_ranges(ranges.selectExpr(*MC_RANGES), products)
    regions = fixtures.table(spark, sf_dir, "region").selectExpr("CAST(r_regionkey AS STRING) AS region_code")
    codes = currencies(spark).select(C("currency_numeric_code").cast("bigint").alias("from_code"), C("currency_alphabetic_code").alias("from_ccy"))
    rates = fx_rates(spark, sf_dir).join(F.broadcast(codes), "from_ccy").select("rate_date", "from_code", "to_ccy", "rate")
    cited = fixtures.table(spark, sf_dir, "nation").selectExpr("CAST(n_regionkey AS STRING) AS cited_file_idn", "CAST(n_nationkey AS STRING) AS cited_message")
    return mc_calculate.message_fields(
        derived(spark, sf_dir, MC_MESSAGES), active, countries(spark, sf_dir), regions, currencies(spark), rates, cited, CLIENT
    )


MC_RULES = [
    "' ' || CAST(nation AS STRING) AS region_country_code", "CASE WHEN var_bp % 2 = 0 THEN 'aa' ELSE 'BB ' END AS ird", "rule_id", "code_cond AS processing_code", "'>= ' || CAST(amount_min_cents DIV 100 AS STRING) AS amount_transaction",
    "CASE WHEN amount_min_cents IS NOT NULL THEN 'eur' END AS amount_transaction_currency", "valid_from", "valid_until", "CASE WHEN var_bp % 5 = 0 THEN '' ELSE 'EUR' END AS rate_currency", "CASE WHEN var_bp % 11 <> 0 THEN var_bp * CAST('0.0001' AS DECIMAL(5,4)) END AS rate_variable",
    "fix_cents * CAST('0.01' AS DECIMAL(3,2)) AS rate_fixed", "min_cents * CAST('0.01' AS DECIMAL(3,2)) AS rate_min", "cap_cents * CAST('0.01' AS DECIMAL(3,2)) AS rate_cap", "CASE WHEN nation = 3 THEN 'NOT:1' END AS token_flag",
]
_MC_FX = "(CASE WHEN r.var_bp % 5 = 0 THEN CAST(1 AS DECIMAL(18,10)) ELSE t.fx END)"


@query(
    "job_mc_fee",
    f"""SELECT 'F' || t.file_no AS file_id, t.record AS ref_id, coalesce(m.rule_id, 0) AS rule_id, CASE WHEN r.var_bp % 11 <> 0 THEN CAST(r.var_bp * CAST('0.0001' AS DECIMAL(5,4)) AS DECIMAL(14,8)) END AS rate_variable,
      CASE WHEN m.rule_id IS NULL THEN CAST(0 AS DECIMAL(34,14)) WHEN r.var_bp % 11 = 0 THEN {_FIXED.replace('t.fx', _MC_FX)}
       WHEN {_MC_FX} IS NULL THEN NULL ELSE {_bounded(f"{_VARIABLE} + {_FIXED}").replace('t.fx', _MC_FX)} END AS calculated_value
      FROM t LEFT JOIN m ON t.record = m.record LEFT JOIN rules r ON m.rule_id = r.rule_id""",
    ("txn", "fx", "rules"),
    f"""{_FEE_T}, m AS (SELECT t.record, min(r.rule_id) AS rule_id FROM t JOIN rules r ON {_FEE_MATCH.replace("t.code <> '07'", "t.code <> '07'")} AND (r.var_bp % 2 = 0) = (t.direction = 'IN')
        AND (r.nation <> 3 OR t.file_no <> 2) GROUP BY t.record)""",
)
def _mc_fee(spark, sf_dir):
    keys = {"file_id": "'F' || CAST(file_no AS STRING)", "file_idn": "CAST(merchant_region AS STRING)", "ref_id": "record"}
    messages = derived(spark, sf_dir, {
        **keys, "processing_code_de_3": "code || '0000'", "business_activity_4_pds_158_4": "CASE WHEN direction = 'IN' THEN 'Aa' ELSE 'bb' END", "amount_transaction_de_4": "CAST(amount_cents * CAST('0.01' AS DECIMAL(3,2)) AS DECIMAL(18,4))",
        "currency_code_transaction_de_49": NUMERIC, "date_and_time_local_transaction_de_12": "CAST(purchase_date AS TIMESTAMP)", "token_requestor_id_pds_59": "CASE file_no WHEN 2 THEN '50100' WHEN 3 THEN '4' END",
    })
    calculated = derived(spark, sf_dir, {
        **keys, "jurisdiction_assigned": "CAST(merchant_nation AS STRING)", "gcms_product_identifier": "priority", "funding_source": "CAST(NULL AS STRING)", "settlement_report_amount": "amount_cents",
        "settlement_report_currency_code": "ccy", "card_program_identifier": "'X'", "iar_country": "CAST(issuer_nation AS STRING)",
    })
    table = fixtures.rules(spark, sf_dir).selectExpr(*MC_RULES)
    out = fees.message_fees(messages, calculated, table, currencies(spark), two_way_rates(spark, sf_dir))
    return out.select("file_id", "ref_id", F.coalesce("rule_id", F.lit(0).cast("bigint")).alias("rule_id"), C("rate_variable").cast("decimal(14,8)").alias("rate_variable"), "calculated_value")


@query(
    "udf_first_match_rules",
    "SELECT t.record, coalesce(f.rule_id, -1) AS rule_id FROM txn t LEFT JOIN firsts f ON t.record = f.record",
    ("txn", "rules"),
    FIRST_RULE_SQL,
)
def _first_match(spark, sf_dir):
    """The first rule by a loop over rule text in numpy, a second way that checks the index.

    Transactions are reduced to what the loop compares. Each part of a nation's distinct transactions meets the nation's
    rules: for every code and every span of days in which the same rules hold, the least rule up to each amount floor.
    """
    parts = 16
    rows = fixtures.txn(spark, sf_dir).withColumn("part", F.pmod(F.xxhash64("purchase_date"), F.lit(parts)).cast("int"))
    compared = ["merchant_nation", "part", "code", "amount_cents", "purchase_date"]
    conditions = ["nation", "code_cond", "amount_min_cents", "valid_from", "valid_until"]
    # Of rules that agree on all conditions the first is the only one that can be a first match.
    table = fixtures.rules(spark, sf_dir).groupBy(*conditions).agg(F.min("rule_id").alias("rule_id"))
    table = table.withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(parts - 1))))

    def meets(condition: str, code: str, number: float) -> bool:
        wanted, negate = condition.removeprefix("NOT:").split(","), condition.startswith("NOT:")
        hit = code in wanted or any(int(lo) <= number <= int(hi) for lo, hi in (t.split("-") for t in wanted if "-" in t))
        return hit != negate if condition else True

    def firsts(facts: pd.DataFrame, rules: pd.DataFrame) -> pd.DataFrame:
        codes, days, cents = facts["code"].to_numpy(str), facts["purchase_date"].to_numpy("datetime64[D]"), facts["amount_cents"].to_numpy()
        found = np.full(len(facts), -1)
        rules = rules[rules["valid_from"].notna()]
        begins, ends = rules["valid_from"].to_numpy("datetime64[D]"), rules["valid_until"].to_numpy("datetime64[D]")
        ids, floors = rules["rule_id"].to_numpy(), rules["amount_min_cents"].to_numpy(float, na_value=-np.inf)
        # By floor, then id: the least id so far is the first rule that an amount above the floor meets.
        order = np.lexsort((ids, floors))
        begins, ids, floors = begins[order], ids[order], floors[order]
        ends = np.where(np.isnat(ends), np.datetime64("9999-12-31"), ends)[order]
        texts, text = np.unique(rules["code_cond"].to_numpy(str)[order], return_inverse=True)
        changes = np.unique(np.concatenate([begins, ends + 1]))
        span = np.searchsorted(changes, days, side="right")
        known = ~np.isnat(days)
        for code in np.unique(codes):
            number = pd.to_numeric(code, errors="coerce")
            held = np.array([meets(t, code, number) for t in texts], dtype=bool)[text] if len(texts) else np.zeros(0, dtype=bool)
            of_code = np.flatnonzero((codes == code) & known)
            of_code = of_code[np.argsort(span[of_code], kind="stable")]
            begin, end, rule, floor = begins[held], ends[held], ids[held], floors[held]
            for some in np.split(of_code, np.flatnonzero(np.diff(span[of_code])) + 1):
                if not len(some):
                    continue
                valid = (begin <= days[some[0]]) & (end >= days[some[0]])
                least = np.minimum.accumulate(np.concatenate([[np.iinfo(np.int64).max], rule[valid]]))
                first = least[np.searchsorted(floor[valid], cents[some], side="right")]
                found[some] = np.where(first == np.iinfo(np.int64).max, -1, first)
        return facts.assign(rule_id=found)

    distinct = rows.select(*compared).distinct()
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in distinct.schema) + ", rule_id bigint"
    found = distinct.groupBy("merchant_nation", "part").cogroup(table.groupBy("nation", "part")).applyInPandas(firsts, schema)
    matched = rows.join(found, compared, "left")
    return matched.select("record", F.coalesce("rule_id", F.lit(-1)).cast("bigint").alias("rule_id"))


# Elements 3, 4, 24, 48 and 49 present; every other message ends inside element 48.
BITMAP = "3000010000018000"
BODY = (
    "lpad(CAST(user_id AS STRING), 6, '0') || lpad(CAST(event_id AS STRING), 12, '0') || CASE event_type WHEN 'signup' THEN '697' WHEN 'purchase' THEN '695' ELSE '000' END || "
    "lpad(CAST(length(event_type) + 7 AS STRING), 3, '0') || '0105' || lpad(CAST(length(event_type) AS STRING), 3, '0') || event_type || '978'"
)


@query(
    "udf_row_decode",
    """SELECT event_id, CASE WHEN user_id % 2 = 0 THEN '1644' ELSE '1240' END AS mti, CASE WHEN user_id % 2 = 0 THEN fc END AS function_code, true AS parse_ok, right('000000' || user_id, 6) AS de_3, right('000000000000' || event_id, 12) AS de_4,
       fc AS de_24, CASE WHEN event_type <> 'error' THEN '0105' || right('000' || length(event_type), 3) || event_type END AS de_48, CASE WHEN event_type <> 'error' THEN '978' END AS de_49
       FROM (SELECT *, CASE event_type WHEN 'signup' THEN '697' WHEN 'purchase' THEN '695' ELSE '000' END AS fc FROM events)""",
)
def _decode(spark, sf_dir):
    rows = fixtures.table(spark, sf_dir, "events").selectExpr("event_id", "event_type", "CASE WHEN user_id % 2 = 0 THEN '1644' ELSE '1240' END AS cls", f"{BODY} AS body")
    whole = F.concat(F.encode("cls", "US-ASCII"), F.unhex(F.lit(BITMAP)), F.encode("body", "US-ASCII"))
    cut = F.substring(whole, 1, 38)
    payloads = rows.select("event_id", F.when(C("event_type") == "error", cut).otherwise(whole).alias("payload"))
    decoded = decode_messages(payloads, "payload", False, ["event_id"])
    return decoded.select("event_id", "mti", "function_code", "parse_ok", *[C("elements")[f"de_{n}"].alias(f"de_{n}") for n in (3, 4, 24, 48, 49)])
