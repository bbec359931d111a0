"""Report jobs (M5-M10)."""

from __future__ import annotations

from pyspark.sql import functions as F

from clearspan import fixtures
from clearspan.operators import aggregates
from clearspan.plans import fee_quota, merchant_report, quality, transaction_report
from clearspan.plans.visa_calculate import Client
from clearspan.session import scratch_path
from clearspan.workload.joins import fx_rates
from clearspan.workload.jobs_fees import NUMERIC, countries, currencies, derived
from clearspan.workload.registry import query

C = F.col
CLIENT = Client(code="C1", local_currency="GBP", settlement_currency="EUR", report_currency="EUR", country="GRC", duplicate_on_us=True)
MONEY = "CAST(amount_cents * CAST('0.01' AS DECIMAL(3,2)) AS DECIMAL(18,4))"
FEE = "CAST(amount_cents * CAST('0.0001' AS DECIMAL(5,4)) AS DECIMAL(18,4))"
JURISDICTION = (
    "CASE WHEN merchant_nation = issuer_nation THEN CASE WHEN file_no < 4 THEN 'on-us' ELSE 'off-us' END WHEN merchant_region = issuer_region THEN 'intraregional' ELSE 'interregional' END"
)
RATE_SQL = "coalesce(CAST(f.rate_ppm * CAST('0.000001' AS DECIMAL(7,6)) AS DECIMAL(18,10)), CAST(1 AS DECIMAL(18,10)))"


def _times(amount: str) -> str:
    return f"CAST(CAST({amount} AS DECIMAL(28,4)) * {RATE_SQL} AS DECIMAL(24,6))"


DRAFTS = {
    "content_hash": "'f' || CAST(file_no AS STRING)", "record": "record", "file_type": "direction", "date": "processing_date", "purchase_date": "purchase_date",
    "draft_code": "CASE WHEN code = '' THEN '27' ELSE code END", "merchant_country_code": "'N' || CAST(merchant_nation AS STRING)", "ardef_country": "'N' || CAST(issuer_nation AS STRING)",
    "product_id": "CASE file_no WHEN 0 THEN 'X' WHEN 1 THEN 'F2' ELSE 'C' END", "source_currency_code_alphabetic": "ccy", "source_currency_code": NUMERIC, "source_amount": MONEY, "interchange_fee_amount": FEE,
    "business_mode": "CASE WHEN direction = 'IN' THEN 'ISSUING' ELSE 'ACQUIRING' END", "business_transaction_type": "merchant_region", "business_transaction_cycle": "issuer_region",
    "jurisdiction": JURISDICTION, "reversal_indicator": "CASE WHEN code = '25' THEN 1 ELSE 0 END", "issuer_bin_8": "substr(CAST(acct9 AS STRING), 1, 8)", "account_number": "CAST(acct9 AS STRING) || '0000000'",
    "moto_ec_indicator": "CASE file_no WHEN 0 THEN ' ' WHEN 1 THEN '5' ELSE 'R' END", "funding_source": "CASE WHEN file_no = 2 THEN 'H' ELSE 'P' END", "merchant_name": "' ' || lower(priority)",
    "card_acceptor_id": "'m' || CAST(merchant_nation AS STRING)", "terminal_id": "'t' || CAST(issuer_region AS STRING)", "account_reference_number_acquiring_identifier": "file_no",
    "merchant_category_code": "CASE WHEN merchant_region = 0 THEN 5411 ELSE 6011 END", "dcc_indicator": "CASE WHEN file_no = 3 THEN '1' END", "settlement_report_currency_code": "CASE WHEN file_no < 3 THEN 'GBP' ELSE 'EUR' END",
    "interchange_fee_descriptor": "' D' || CAST(file_no AS STRING) || ' '",
}
MESSAGES = {
    "content_hash": "'g' || CAST(file_no AS STRING)", "ref_id": "record", "file_type": "direction", "type_mti": "CASE WHEN file_no = 0 THEN '1442' ELSE '1240' END", "date": "processing_date", "file_dt": "replace(CAST(processing_date AS STRING), '-', '')",
    "gcms_product_identifier": "CASE file_no WHEN 0 THEN 'MTA' WHEN 1 THEN 'MBS' ELSE 'C' END", "currency_code_transaction_de_49": NUMERIC, "currency_code_reconciliation_de_50": "'826'", "amount_transaction_de_4": MONEY,
    "amount_reconciliation_de_5": f"CAST({MONEY} * 2 AS DECIMAL(18,4))", "amounts_transaction_fee_7_pds_146_7": FEE, "calculated_value": f"CAST({FEE} * 3 AS DECIMAL(18,4))", "iar_country": "'NN' || CAST(issuer_nation AS STRING)",
    "card_acceptor_country_code_de_43_6": "CASE WHEN merchant_region = 1 THEN 'FRA' ELSE 'NN' || CAST(merchant_nation AS STRING) END", "date_de_12_1": "purchase_date", "date_and_time_local_transaction_de_12": "purchase_date",
    "processing_code_de_3": "CASE WHEN code = '' THEN '**' ELSE code END || '0000'", "jurisdiction": JURISDICTION, "jurisdiction_assigned": "CAST(merchant_nation AS STRING)", "ird": "priority", "pan_de_2": "CAST(acct9 AS STRING) || '0000000'",
    "acquirer_reference_data_de_31": "'2' || lpad(CAST(file_no AS STRING), 6, '0')", "pos_entry_mode_de_22": "'00000' || CAST(merchant_nation % 3 AS STRING) || '6'", "message_reversal_indicator_pds_25": "CASE WHEN merchant_region = 0 THEN 'R' ELSE '' END",
    "business_mode": "CASE WHEN direction = 'IN' THEN 'issuing' ELSE 'acquiring' END", "funding_source": "'D'", "card_acceptor_name_de_43_1": "priority", "card_acceptor_id_code_de_42": "CAST(merchant_nation AS STRING)",
    "card_acceptor_terminal_id_de_41": "'t'", "card_acceptor_business_code_[mcc]_de_26": "CASE WHEN merchant_region = 0 THEN 3500 ELSE 6011 END", "business_activity_4_pds_158_4": "CASE WHEN file_no < 3 THEN 'BB' ELSE 'CC' END",
    "settlement_report_currency_code": "CASE WHEN file_no < 3 THEN 'GBP' ELSE 'EUR' END", "settlement_indicator_1_pds_165_1": "CASE WHEN file_no = 2 THEN 'C' ELSE 'M' END", "rule_id": "CAST(merchant_region AS STRING)",
}


def brand_rates(spark, sf_dir):
    """Rates of both brands, with the numeric code of the from-currency."""
    codes = currencies(spark).select(C("currency_numeric_code").alias("from_code_text"), C("currency_alphabetic_code").alias("from_ccy"))
    rates = fx_rates(spark, sf_dir).join(F.broadcast(codes), "from_ccy").withColumn("from_code", C("from_code_text").cast("bigint"))
    return rates.withColumn("brand", F.explode(F.array(F.lit("VISA"), F.lit("MasterCard"))))


def _programs(spark):
    return spark.createDataFrame([("X", 1), ("F2", 2), ("C", 3), ("MTA", 4)], "bin_product_id string, range_program_id int")


DRAFT_REPORT_SQL = f"""SELECT 'C1' AS customer_code, 'f' || file_no AS file_id, record AS row_id, CASE direction WHEN 'IN' THEN 'NN' || issuer_nation ELSE 'NN' || merchant_nation END AS customer_country_code,
  CASE direction WHEN 'IN' THEN 'I' ELSE 'A' END AS business_mode_code, 'VI' AS brand_code, processing_date, left(CAST(processing_date AS VARCHAR), 7) AS processing_month, purchase_date AS transaction_date, left(CAST(purchase_date AS VARCHAR), 7) AS transaction_month,
  CASE WHEN code IN ('05', '25') THEN 'PUR' WHEN code = '06' THEN 'CRD' WHEN code IN ('07', '') THEN 'CSH' ELSE 'OTH' END AS transaction_group_code, CAST(merchant_region AS VARCHAR) AS transaction_type_id, {JURISDICTION} AS jurisdiction_code,
  'NN' || merchant_nation AS merchant_country_code, CASE WHEN merchant_region = 0 THEN 5411 ELSE 6011 END AS mcc_code, upper(priority) AS merchant, 'M' || merchant_nation AS merchant_id, 'T' || issuer_region AS terminal_id, file_no AS acquirer_bin,
  'NN' || issuer_nation AS issuer_country_code, CAST(left(CAST(acct9 AS VARCHAR), 6) AS INTEGER) AS issuer_bin_6, CAST(left(CAST(acct9 AS VARCHAR), 8) AS INTEGER) AS issuer_bin_8, CASE WHEN file_no = 2 THEN 'H' ELSE 'P' END AS funding_source_code,
  CASE file_no WHEN 0 THEN 1 WHEN 1 THEN 2 ELSE 3 END AS product_program_id, CASE file_no WHEN 0 THEN 'X' WHEN 1 THEN 'F2' ELSE 'C' END AS product_code, CASE file_no WHEN 0 THEN 'CPR' WHEN 1 THEN 'CNP' ELSE 'UNK' END AS card_present_code,
  code = '25' AS is_reversal_or_chargeback, ' D' || file_no || ' ' AS interchange_rule, 'EUR' AS reported_currency_code, CAST(CASE WHEN code = '25' THEN -1 ELSE 1 END * {_times(MONEY)} AS DECIMAL(24,6)) AS transaction_amount,
  CAST(CASE WHEN code = '25' THEN -1 ELSE 1 END * {_times(FEE)} AS DECIMAL(24,6)) AS interchange_fees_amount FROM txn t LEFT JOIN fx f ON f.rate_date = t.processing_date AND f.from_ccy = t.ccy"""
_CB = "file_no = 0"
_PLACE = "CASE WHEN merchant_region = 1 THEN 'FRA' ELSE 'NN' || merchant_nation END"
_MC_MONEY = f"CASE direction WHEN 'IN' THEN {MONEY} * 2 ELSE {MONEY} END"
_MC_CCY = "CASE direction WHEN 'IN' THEN 'GBP' ELSE t.ccy END"
_MC_SIGN = "CASE WHEN (merchant_region = 0) <> (file_no = 0) THEN -1 ELSE 1 END"
MESSAGE_REPORT_SQL = f"""SELECT 'C1' AS customer_code, 'g' || file_no AS file_id, record AS row_id, CASE WHEN (direction = 'IN') = ({_CB}) THEN {_PLACE} ELSE 'NN' || issuer_nation END AS customer_country_code,
  CASE direction WHEN 'IN' THEN 'I' ELSE 'A' END AS business_mode_code, 'MC' AS brand_code, processing_date, left(CAST(processing_date AS VARCHAR), 7) AS processing_month, purchase_date AS transaction_date, left(CAST(purchase_date AS VARCHAR), 7) AS transaction_month,
  'OTH' AS transaction_group_code, CASE WHEN code = '' THEN '**' ELSE code END AS transaction_type_id, {JURISDICTION} AS jurisdiction_code,
  CASE WHEN {_CB} THEN 'NN' || issuer_nation ELSE {_PLACE} END AS merchant_country_code, CASE WHEN merchant_region = 0 THEN 3500 ELSE 6011 END AS mcc_code, priority AS merchant, CAST(merchant_nation AS VARCHAR) AS merchant_id, 'T' AS terminal_id, file_no AS acquirer_bin,
  CASE WHEN {_CB} THEN {_PLACE} ELSE 'NN' || issuer_nation END AS issuer_country_code, CAST(left(CAST(acct9 AS VARCHAR), 6) AS INTEGER) AS issuer_bin_6, CAST(left(CAST(acct9 AS VARCHAR), 8) AS INTEGER) AS issuer_bin_8, 'D' AS funding_source_code,
  CASE file_no WHEN 0 THEN 4 WHEN 1 THEN NULL ELSE 3 END AS product_program_id, CASE file_no WHEN 0 THEN 'MTA' WHEN 1 THEN 'MBS' ELSE 'C' END AS product_code, CASE merchant_nation % 3 WHEN 0 THEN 'CNP' WHEN 1 THEN 'CPR' ELSE 'UNK' END AS card_present_code,
  (merchant_region = 0) <> (file_no = 0) AS is_reversal_or_chargeback, merchant_nation || '-' || priority AS interchange_rule, 'EUR' AS reported_currency_code, CAST({_MC_SIGN} * {_times(_MC_MONEY)} AS DECIMAL(24,6)) AS transaction_amount,
  CAST({_MC_SIGN} * {_times(f"CASE direction WHEN 'IN' THEN {FEE} ELSE {FEE} * 3 END")} AS DECIMAL(24,6)) AS interchange_fees_amount FROM txn t LEFT JOIN fx f ON f.rate_date = t.processing_date AND f.from_ccy = {_MC_CCY}"""


@query(
    "job_transaction_report",
    """SELECT * REPLACE ('I' AS business_mode_code), CAST(0 AS DECIMAL(24,6)) AS scheme_fees_amount FROM both_families WHERE jurisdiction_code = 'on-us' AND business_mode_code = 'A'
       UNION ALL SELECT *, CASE WHEN brand_code = 'VI' AND business_mode_code = 'A' THEN CAST(row_id AS DECIMAL(24,6)) ELSE CAST(0 AS DECIMAL(24,6)) END FROM both_families""",
    ("txn", "fx"),
    f"both_families AS ({DRAFT_REPORT_SQL} UNION ALL {MESSAGE_REPORT_SQL})",
)
def _transaction_report(spark, sf_dir):
    rates = brand_rates(spark, sf_dir).where("brand = 'VISA'")
    frames = [
        transaction_report.draft_rows(derived(spark, sf_dir, DRAFTS), countries(spark, sf_dir), _programs(spark), rates, CLIENT),
        transaction_report.message_rows(derived(spark, sf_dir, MESSAGES), currencies(spark), _programs(spark), rates, CLIENT),
    ]
    final_detail = fixtures.txn(spark, sf_dir).where("direction = 'OUT'").selectExpr(
        "'f' || CAST(file_no AS STRING) AS app_hash_file", "record AS app_id", "'ACQUIRING' AS business_mode_id", "CAST(record AS DECIMAL(24,6)) AS unitary_scheme_fee_cost"
    )
    return transaction_report.report(frames, transaction_report.unit_costs(final_detail))


SINGLE_MESSAGES = {
    "content_hash": "'f' || CAST(file_no AS STRING)", "record": "record", "date": "processing_date", "local_draft_date": "CASE WHEN file_no <> 6 THEN purchase_date END",
    "card_acceptor_country": "'N' || CAST(merchant_nation AS STRING)", "ardef_country": "'N' || CAST(issuer_nation AS STRING)", "product_id": "'C'", "source_currency_code_alphabetic": "ccy",
    "source_amount": f"CASE WHEN file_no = 0 THEN CAST(0 AS DECIMAL(18,4)) ELSE {MONEY} END", "cryptogram_amount": FEE, "surcharge_amount_sms": "CASE WHEN merchant_region = 0 THEN CAST(1 AS DECIMAL(18,4)) END",
    "interchange_fee_amount": FEE, "business_mode": "CASE WHEN direction = 'IN' THEN 'ISSUING' ELSE 'ACQUIRING' END", "business_transaction_type": "merchant_region", "jurisdiction": JURISDICTION,
    "reversal_indicator": "CASE WHEN code = '25' THEN 1 ELSE 0 END", "issuer_bin_8": "substr(CAST(acct9 AS STRING), 1, 8)", "card_number": "CAST(acct9 AS STRING)", "funding_source": "'C'", "transaction_code_sms": "code",
}


@query(
    "job_transaction_report_messages",
    f"""SELECT record AS row_id, CASE WHEN code IN ('05', '25') THEN 'PUR' WHEN code = '06' THEN 'CRD' WHEN code = '07' THEN 'CSH' ELSE 'OTH' END AS transaction_group_code,
        CAST(CASE WHEN code = '25' THEN -1 ELSE 1 END * CASE WHEN file_no = 0 THEN CAST(CAST({FEE} + CASE WHEN merchant_region = 0 THEN 1 ELSE 0 END AS DECIMAL(28,4)) * {RATE_SQL} AS DECIMAL(24,6)) ELSE {_times(MONEY)} END AS DECIMAL(24,6)) AS transaction_amount
        FROM txn t LEFT JOIN fx f ON f.rate_date = t.processing_date AND f.from_ccy = CASE WHEN file_no = 0 THEN 'USD' ELSE t.ccy END WHERE file_no <> 6""",
    ("txn", "fx"),
)
def _single_message_report(spark, sf_dir):
    plain = Client(code="C1", report_currency="EUR")
    rows = transaction_report.single_message_rows(
        derived(spark, sf_dir, SINGLE_MESSAGES), countries(spark, sf_dir), _programs(spark), brand_rates(spark, sf_dir).where("brand = 'VISA'"), plain
    )
    return rows.select("row_id", "transaction_group_code", "transaction_amount")


def _types(spark):
    return spark.createDataFrame([(0, "PUR"), (1, "CSH"), (2, "CRD"), (3, "OTH")], "type_key int, transaction_type_id string")


def _message_types(spark):
    return spark.createDataFrame([("05", "PUR"), ("06", "CSH"), ("18", "PUR")], "type_key string, transaction_type_id string")


def _quota_inputs(spark, sf_dir):
    products = spark.createDataFrame(
        [("X", 1, 11, "VISA"), ("F2", 2, 12, "VISA"), ("MTA", 4, 14, "MC"), ("C", 3, 13, "MC")], "product_code string, range_program_id int, legacy_product_id int, brand string"
    )
    local_files = fixtures.txn(spark, sf_dir).where("file_no = 2 AND direction = 'OUT'").selectExpr("'f' || CAST(file_no AS STRING) AS content_hash")
    switches = spark.createDataFrame([("C1", "VISA", 7), ("C1", "MasterCard", 8), ("C2", "VISA", 9)], "customer_code string, brand_code string, switch_id int")
    tickets = fixtures.table(spark, sf_dir, "region").selectExpr(
        "'VISA' AS brand", "'GRC' AS country_code_list", "'EUR' AS ticket_currency", "CAST(r_regionkey * 1000 AS DECIMAL(18,2)) AS size_ticket_min", "CAST((r_regionkey + 1) * 1000 AS DECIMAL(18,2)) AS size_ticket_max", "r_regionkey + 1 AS size_ticket_id"
    )
    rates = brand_rates(spark, sf_dir)
    details = [
        fee_quota.draft_detail(derived(spark, sf_dir, DRAFTS), CLIENT, rates, products, _types(spark), local_files, switches),
        fee_quota.message_detail(derived(spark, sf_dir, MESSAGES), CLIENT, rates, products, _message_types(spark), local_files, switches, currencies(spark)),
    ]
    return details, tickets, rates


_DRAFT_AMOUNT = _times(MONEY)
DETAIL_SQL = f"""drafts AS (SELECT 'VISA' AS transaction_brand, 'f' || file_no AS hash, record AS app_id, CASE direction WHEN 'IN' THEN 'ISSUING' ELSE 'ACQUIRING' END AS business_mode_id, {_DRAFT_AMOUNT} AS report_amount, CASE file_no WHEN 0 THEN 'X' WHEN 1 THEN 'F2' ELSE 'C' END AS product_id,
    CASE file_no WHEN 0 THEN 1 WHEN 1 THEN 2 END AS range_program_id, CASE file_no WHEN 0 THEN 11 WHEN 1 THEN 12 END AS legacy_product_id, CASE WHEN file_no = 2 THEN 'C' ELSE 'D' END AS account_funding_source,
    CASE merchant_region WHEN 0 THEN 'PUR' WHEN 1 THEN 'CSH' WHEN 2 THEN 'CRD' END AS business_transaction_type_id, {JURISDICTION} AS jurisdiction, CASE WHEN code = '25' THEN 1 ELSE 0 END AS reversal_indicator,
    CASE WHEN ccy = 'GBP' OR file_no <> 3 THEN 1 ELSE 0 END AS currency_local_indicator, CASE WHEN file_no = 1 THEN 0 ELSE 1 END AS motoec_indicator, CAST(acct9 AS VARCHAR) || '0000000' AS account_number, 'N' || merchant_nation AS merchant_country_code,
    CASE WHEN file_no = 2 THEN 7 ELSE 0 END AS switch_code, CASE WHEN file_no = 0 THEN 1 ELSE 0 END AS travel_program_indicator,
    CASE WHEN merchant_region = 0 AND {JURISDICTION} = 'off-us' AND file_no <> 0 AND {_DRAFT_AMOUNT} <= CASE WHEN file_no = 1 THEN 10 ELSE 20 END AND tc.n <= 3 THEN 1 ELSE 0 END AS greece_micropayment_indicator, 0 AS key_entered_tpe
   FROM txn t LEFT JOIN fx f ON f.rate_date = t.processing_date AND f.from_ccy = t.ccy JOIN (SELECT merchant_nation AS mn, count(DISTINCT issuer_region) AS n FROM txn GROUP BY 1) tc ON tc.mn = t.merchant_nation
   WHERE merchant_region < 3 AND code IN ('05', '06', '07', '25', '')),
  msgs AS (SELECT 'MasterCard' AS transaction_brand, 'g' || file_no AS hash, record AS app_id, CASE direction WHEN 'IN' THEN 'ISSUING' ELSE 'ACQUIRING' END AS business_mode_id, {_times(_MC_MONEY)} AS report_amount, CASE file_no WHEN 0 THEN 'MTA' WHEN 1 THEN 'MBS' ELSE 'C' END AS product_id,
    CASE file_no WHEN 0 THEN 4 WHEN 1 THEN NULL ELSE 3 END AS range_program_id, CASE file_no WHEN 0 THEN 14 WHEN 1 THEN NULL ELSE 13 END AS legacy_product_id, 'D' AS account_funding_source, CASE code WHEN '05' THEN 'PUR' WHEN '06' THEN 'CSH' END AS business_transaction_type_id,
    {JURISDICTION} AS jurisdiction, CASE WHEN (merchant_region = 0) <> (file_no = 0) THEN 1 ELSE 0 END AS reversal_indicator, CASE WHEN direction = 'IN' OR ccy = 'GBP' THEN 1 ELSE 0 END AS currency_local_indicator, CASE WHEN merchant_nation % 3 = 0 THEN 0 ELSE 1 END AS motoec_indicator,
    CAST(acct9 AS VARCHAR) || '0000000' AS account_number, CASE WHEN file_no = 0 THEN 'NN' || issuer_nation ELSE {_PLACE} END AS merchant_country_code, 0 AS switch_code,
    CASE WHEN file_no = 0 OR (file_no = 1 AND merchant_region = 0) THEN 1 ELSE 0 END AS travel_program_indicator, 0 AS greece_micropayment_indicator,
    CASE WHEN {JURISDICTION} = 'intraregional' AND file_no = 0 AND merchant_region = 1 THEN 1 ELSE 0 END AS key_entered_tpe
   FROM txn t LEFT JOIN fx f ON f.rate_date = t.processing_date AND f.from_ccy = {_MC_CCY}),
  plain AS (SELECT * FROM drafts UNION ALL SELECT * FROM msgs),
  det AS (SELECT *, 'EUR' AS report_currency, 'C1' AS app_customer_code, 'GRC' AS bank_country, CASE WHEN transaction_brand = 'VISA' AND report_amount >= 0 AND report_amount < 5000 THEN CAST(floor(report_amount / 1000) AS INTEGER) + 1 ELSE 0 END AS size_ticket FROM
    (SELECT * FROM plain UNION ALL SELECT * REPLACE ('ISSUING' AS business_mode_id) FROM plain WHERE jurisdiction = 'on-us' AND business_mode_id = 'ACQUIRING'))"""
_DIMS = ", ".join(aggregates.FEE_REPORT_DIMS)
_NUMBERING = "row_number() OVER (ORDER BY " + ", ".join(f"{d} NULLS FIRST" for d in aggregates.FEE_REPORT_DIMS) + ")"


@query(
    "job_fee_quota_generate",
    f"""SELECT *, {_NUMBERING} AS app_id FROM (SELECT {_DIMS}, count(*) AS transaction_count, CAST(sum(report_amount) AS DECIMAL(34,6)) AS transaction_amount, min(legacy_product_id) AS legacy_product_id FROM det GROUP BY {_DIMS})""",
    ("txn", "fx"),
    DETAIL_SQL,
)
def _quota_generate(spark, sf_dir):
    details, tickets, rates = _quota_inputs(spark, sf_dir)
    _, report = fee_quota.generate(details, tickets, rates)
    return report.drop(*aggregates.COST_COLUMNS)


@query(
    "job_fee_quota_read",
    f"""SELECT d.transaction_brand, d.business_mode_id, d.jurisdiction, count(*) AS rows_, CAST(sum(CASE WHEN g.app_id % 10 = 0 THEN 0 ELSE g.n * CAST('0.05' AS DECIMAL(3,2)) END) AS DECIMAL(34,6)) AS cost, CAST(sum(CAST('0.25' AS DECIMAL(24,6))) AS DECIMAL(34,6)) AS unit_estimate
        FROM det d JOIN (SELECT *, {_NUMBERING} AS app_id FROM (SELECT {_DIMS}, count(*) AS n FROM det GROUP BY {_DIMS})) g ON {' AND '.join(f'd.{d} IS NOT DISTINCT FROM g.{d}' for d in aggregates.FEE_REPORT_DIMS)} GROUP BY d.transaction_brand, d.business_mode_id, d.jurisdiction""",
    ("txn", "fx"),
    DETAIL_SQL,
)
def _quota_read(spark, sf_dir):
    """Generate, let the cost file come back with some costs missing, and carry costs to the detail."""
    details, tickets, rates = _quota_inputs(spark, sf_dir)
    root = scratch_path(spark, "analytics")
    funding = spark.createDataFrame([("C", 1), ("D", 2)], "bin_funding_source_code string, bin_funding_source_mc_numeric_code int")
    country = countries(spark, sf_dir)
    fee_quota.store_generated(spark, root, CLIENT, "199703", details, tickets, rates, country, funding, "run-1")
    exported = spark.read.option("header", True).csv(f"{fee_quota.month_root(root, 'C1', '199703', 'state')}/export")
    returned = f"{root}/returned"
    exported.selectExpr(
        "app_id", "txn_cnt", "CASE WHEN app_id % 10 = 0 THEN '#N/A' ELSE CAST(CAST(txn_cnt AS INT) * 0.05BD AS STRING) END AS txn_sfc", "CAST(CAST(txn_cnt AS INT) * 0.25BD AS STRING) AS est_sch_fee_amt", "mct_cd", "prg_id"
    ).write.option("header", True).csv(returned)
    fee_quota.store_returned(spark, root, CLIENT, "199703", returned)
    final = spark.read.parquet(f"{fee_quota.month_root(root, 'C1', '199703', 'final')}/detail")
    return final.groupBy("transaction_brand", "business_mode_id", "jurisdiction").agg(
        F.count("*").alias("rows_"), F.sum("transaction_scheme_fee_cost").alias("cost"), F.sum("unitary_estimated_scheme_fee_cost").alias("unit_estimate")
    )


SUMMARIES = {
    "summary_level_130": "CASE WHEN file_no = 0 THEN '11' ELSE '10' END", "vss_aggregation_level": "CASE WHEN file_no = 1 THEN 1 ELSE 0 END", "no_data_indicator_130": "' '", "business_draft_type_130": "CASE merchant_region WHEN 0 THEN '100' WHEN 1 THEN '330' ELSE '999' END",
    "business_mode_130": "CASE WHEN direction = 'OUT' THEN '1' ELSE '2' END", "business_draft_cycle_130": "CASE WHEN issuer_region = 0 THEN '2' ELSE '1' END", "date": "processing_date", "settlement_currency_code_130": NUMERIC, "jurisdiction_code_130": "CASE WHEN file_no = 2 THEN '00' ELSE '01' END",
    "source_country_code_130": "merchant_region", "destination_country_code_130": "issuer_region", "reversal_indicator_130": "'N'", "fee_level_descriptor": "' F' || CAST(file_no AS STRING)", "count_130": "file_no", "interchange_amount_settlement_currency_130": MONEY,
    "reimbursement_fee_credits_settlement_currency": FEE, "reimbursement_fee_debits_settlement_currency": "CASE WHEN file_no < 5 THEN CAST(1 AS DECIMAL(18,4)) END",
}


def _two(e: str) -> str:
    return f"CAST(round({e}, 2) AS DECIMAL(18,2))"


@query(
    "job_quality_visa",
    f"""SELECT processing_date AS app_processing_date, 'Base II' AS data_source, 'brand' AS file_source, 'C1' AS app_customer_code, CASE direction WHEN 'OUT' THEN 'Acquirer' ELSE 'Issuer' END AS business_mode, {JURISDICTION} AS jurisdiction, CASE WHEN file_no < 3 THEN 'Local' ELSE 'Foreign' END AS settlement_currency,
        CASE WHEN code = '25' THEN 'Y' ELSE 'N' END AS reversal_indicator, CASE merchant_region WHEN 0 THEN 'Sale' WHEN 1 THEN 'Cash' END AS trx_type, CASE issuer_region WHEN 1 THEN 'Original' END AS trx_cycle, 'D' || file_no AS fee_descriptor, 'EUR' AS report_currency_code,
        CAST(count(*) AS DECIMAL(18,2)) AS trx_count, {_two(f"sum(CAST({MONEY} AS DECIMAL(28,4)) * {RATE_SQL})")} AS trx_amt, {_two(f"sum(CAST({FEE} AS DECIMAL(28,4)) * {RATE_SQL})")} AS itx_amt FROM txn t LEFT JOIN fx f ON f.rate_date = t.processing_date AND f.from_ccy = t.ccy GROUP BY ALL
       UNION ALL SELECT processing_date, 'VSS', 'brand', 'C1', CASE direction WHEN 'OUT' THEN 'Acquirer' ELSE 'Issuer' END, CASE WHEN file_no = 2 THEN 'interregional' WHEN merchant_region <> issuer_region THEN 'intraregional' ELSE 'off-us' END,
        CASE WHEN coalesce(f.from_ccy, 'EUR') = 'GBP' THEN 'Local' ELSE 'Foreign' END, 'N', CASE merchant_region WHEN 0 THEN 'Sale' WHEN 1 THEN 'Cash' END, 'Original', 'F' || file_no, 'EUR', CAST(sum(file_no) AS DECIMAL(18,2)), {_two(f"sum(CAST({MONEY} AS DECIMAL(28,4)) * {RATE_SQL})")},
        {_two(f"sum(CASE WHEN file_no < 5 THEN CAST({FEE} + 1 AS DECIMAL(28,4)) * {RATE_SQL} END)")} FROM txn t LEFT JOIN fx f ON f.rate_date = t.processing_date AND f.from_ccy = t.ccy WHERE file_no > 1 AND merchant_region < 2 AND issuer_region <> 0 GROUP BY ALL""",
    ("txn", "fx"),
)
def _quality_visa(spark, sf_dir):
    types = spark.createDataFrame([(0, "100", "Sale"), (1, "330", "Cash")], "btt_id int, btt_code string, trx_type string")
    cycles = spark.createDataFrame([(1, "1", "Original"), (9, "2", "Chargeback")], "btc_id int, btc_code string, trx_cycle string")
    rates = brand_rates(spark, sf_dir).where("brand = 'VISA'").drop("from_code").withColumnRenamed("from_code_text", "from_code")
    return quality.text_quality(derived(spark, sf_dir, DRAFTS), derived(spark, sf_dir, SUMMARIES), types, cycles, rates, CLIENT, origin="BRAND")


TOTALS = {
    "type_mti": "'1644'", "function_code": "CASE WHEN file_no = 0 THEN 688 ELSE 685 END", "reconciled_transaction_function_1_pds_372_1": "CASE WHEN file_no = 1 THEN 1740 ELSE 1240 END", "file_dt": "substr(replace(CAST(date_add(processing_date, 3650) AS STRING), '-', ''), 3)",
    "reconciled_member_activity_pds_302": "CASE merchant_region WHEN 0 THEN 'A' WHEN 1 THEN 'I' ELSE 'Z' END", "settlement_indicator_1_pds_165_1": "CASE WHEN file_no = 2 THEN 'C' ELSE 'M' END", "reconciled_business_activity_2_pds_358_2": "CASE WHEN merchant_region = 4 THEN 'x' ELSE '0' || CAST(merchant_region AS STRING) END",
    "reconciled_business_activity_4_pds_358_4": "priority", "reconciled_processing_code_pds_374": "code", "currency_code_reconciliation_de_50": NUMERIC, "total_transaction_number_pds_402": "file_no", "reconciled_file_pds_300": "'x' || CAST(file_no AS STRING)",
    "amount_net_transaction_in_reconciliation_currency_2_pds_394_2": MONEY, "amount_net_fee_in_reconciliation_currency_2_pds_395_2": FEE,
}


@query(
    "job_quality_mc",
    f"""SELECT processing_date + 3650 AS app_processing_date, 'Settlement Data' AS data_source, 'default' AS file_source, 'C1' AS app_customer_code, '1240' AS app_message_type, CASE merchant_region WHEN 0 THEN 'Acquirer' WHEN 1 THEN 'Issuer' ELSE 'Unknown' END AS business_mode,
        CASE WHEN file_no = 2 THEN 'on-us' WHEN merchant_region IN (2, 3) THEN 'intraregional' WHEN merchant_region = 1 THEN 'interregional' END AS jurisdiction, 'EUR' AS report_currency_code, CASE WHEN ccy = 'EUR' THEN 'Local' ELSE 'Foreign' END AS settlement_currency, CASE code WHEN '05' THEN 'PUR' WHEN '06' THEN 'CSH' END AS trx_type,
        priority AS ird, '' AS rule_id, '' AS message_reason_code, '' AS electronic_commerce_indicator, '' AS reconciled_file_flg, CAST(sum(file_no) AS DECIMAL(38,6)) AS trx_count, CAST(sum({MONEY}) AS DECIMAL(38,6)) AS trx_amt, CAST(sum({FEE}) AS DECIMAL(38,6)) AS itx_amt FROM txn WHERE file_no > 1 GROUP BY ALL
       UNION ALL SELECT processing_date, 'Transactional Data', 'default', 'C1', CASE WHEN file_no = 0 THEN '1442' ELSE '1240' END, 'Acquirer', CASE WHEN file_no = 2 THEN 'on-us' ELSE {JURISDICTION} END, 'EUR', CASE WHEN file_no < 3 THEN 'Foreign' ELSE 'Local' END,
        CASE code WHEN '05' THEN 'PUR' WHEN '06' THEN 'CSH' WHEN '' THEN 'PUR' END, CASE WHEN file_no < 3 THEN 'BB' ELSE 'CC' END, CAST(merchant_region AS VARCHAR), '', '', '', CAST(count(*) AS DECIMAL(38,6)), CAST(sum(CAST({MONEY} AS DECIMAL(28,4)) * {RATE_SQL}) AS DECIMAL(38,6)), CAST(sum(CAST({FEE} * 3 AS DECIMAL(28,4)) * {RATE_SQL}) AS DECIMAL(38,6))
        FROM txn t LEFT JOIN fx f ON f.rate_date = t.processing_date AND f.from_ccy = t.ccy WHERE direction = 'OUT' GROUP BY ALL""",
    ("txn", "fx"),
)
def _quality_mc(spark, sf_dir):
    rates = brand_rates(spark, sf_dir).where("brand = 'MasterCard'")
    return quality.message_quality(
        derived(spark, sf_dir, TOTALS), derived(spark, sf_dir, MESSAGES), _message_types(spark), currencies(spark), rates, CLIENT, "A", unmask=True
    )


MERCHANT_MESSAGES = {
    **{c: MESSAGES[c] for c in ("date", "card_acceptor_id_code_de_42", "message_reversal_indicator_pds_25")},
    "settlement_indicator_1_pds_165_1": "CASE file_no WHEN 0 THEN 'X' WHEN 1 THEN 'C' ELSE 'M' END", "gcms_product_identifier": "CASE merchant_region WHEN 0 THEN 'gcp' WHEN 1 THEN NULL ELSE 'MTA' END", "card_program_identifier": "CASE WHEN merchant_nation % 2 = 0 THEN 'MSI' ELSE 'DMC' END",
    "cardholder_transaction_type_de_3_1": "CASE file_no WHEN 2 THEN '20' WHEN 3 THEN '9' ELSE '0' END", "jurisdiction": "CASE WHEN file_no = 4 THEN '' ELSE " + JURISDICTION + " END", "jurisdiction_country": "CASE WHEN file_no = 5 THEN '7' ELSE 'NN' || CAST(issuer_nation AS STRING) END",
    "currency_code_transaction_de_49": "ccy", "settlement_report_currency_code": "'EUR'", "card_present_data_de_22_6": "CAST(issuer_region % 2 AS STRING)", "settlement_report_amount": "CAST(CAST(amount_cents * CAST('0.01' AS DECIMAL(3,2)) AS DECIMAL(18,2)) AS STRING)", "amounts_transaction_fee_7_pds_146_7": FEE,
}
_AREA = "(c_id IN (1, 2, 3))"
MERCHANT_SQL = f"""src AS (SELECT *, CASE WHEN file_no = 5 THEN 7 ELSE issuer_nation END AS nat, {JURISDICTION} AS juris FROM txn WHERE file_no > 0 AND merchant_region <> 0),
  tx AS (SELECT CAST(year(processing_date) * 100 + month(processing_date) AS INTEGER) AS mth, CASE WHEN nat = 5 THEN 90 ELSE nat END AS c_id, right('00000000000' || merchant_nation, 11) AS mct,
    CASE WHEN merchant_region = 1 THEN NULL ELSE 4 END AS prg, CASE WHEN merchant_region = 1 THEN NULL ELSE 2 END AS fnd, CASE WHEN file_no <> 4 AND juris = 'interregional' THEN 8 WHEN file_no <> 4 AND juris = 'intraregional' THEN 4 WHEN file_no <> 4 AND juris = 'off-us' THEN 2
      WHEN nat = 5 THEN 2 WHEN nat IN (1, 2, 3) THEN 4 ELSE 8 END AS scp, CASE file_no WHEN 2 THEN 1 WHEN 3 THEN 8 ELSE 1 END AS typ, CASE WHEN merchant_region = 0 THEN 1 ELSE 0 END AS rev, CASE WHEN ccy = 'EUR' THEN 1 ELSE 0 END AS lcl, issuer_region % 2 AS prs, CASE WHEN merchant_nation % 2 = 0 THEN 2 ELSE 1 END AS sub,
    CASE WHEN amount_cents <= 10000000 THEN 1 WHEN amount_cents <= 30000000 THEN 2 ELSE 255 END AS bkt, CAST(amount_cents * CAST('0.01' AS DECIMAL(3,2)) AS DECIMAL(18,2)) AS amt, CAST(amount_cents * CAST('0.0001' AS DECIMAL(5,4)) AS DECIMAL(18,4)) AS irf FROM src WHERE merchant_region <> 1 OR true),
  mth AS (SELECT mth, c_id, coalesce(prg, 0) AS prg, fnd, scp, typ, rev, lcl, prs, sub, bkt, count(*) AS n, sum(amt) AS amt, sum(irf) AS irf FROM tx GROUP BY ALL),
  tmpl AS (SELECT CASE WHEN p_size % 4 = 0 THEN 255 ELSE 1 + p_size % 2 END AS t_sub, CASE WHEN p_size % 3 = 0 THEN 255 ELSE (ARRAY[1, 2, 4, 8])[1 + p_size % 4] END AS t_scp, CASE WHEN p_size % 5 = 0 THEN 255 ELSE 4 END AS t_prg, CASE WHEN p_size % 7 = 0 THEN 255 ELSE p_size % 2 END AS t_prs, p_size AS fee FROM part),
  fees AS (SELECT m.mth, m.sub, m.prs, m.prg, m.fnd, m.scp, m.c_id, CAST(sum(t.fee * CAST('0.01' AS DECIMAL(3,2)) * m.n) AS DECIMAL(28,8)) AS qrt, CAST(sum(CAST(t.fee * CAST('0.00001' AS DECIMAL(6,5)) AS DECIMAL(12,6)) * CAST(m.amt AS DECIMAL(24,2))) AS DECIMAL(28,8)) AS clr
    FROM mth m JOIN tmpl t ON t.t_sub IN (m.sub, 255) AND t.t_scp IN (m.scp, 255) AND t.t_prg IN (m.prg, 255) AND t.t_prs IN (m.prs, 255) WHERE m.typ = 1 GROUP BY ALL),
  tot AS (SELECT mth, sub, prs, prg, fnd, scp, c_id, sum(n) AS n, sum(amt) AS amt, sum(irf) AS irf FROM mth WHERE typ = 1 GROUP BY ALL)"""
_PRINT_MONTH = 199703


@query(
    "job_merchant_report",
    f"""SELECT 1 - prs AS "TXN_CRD_PRS_FLG_ID", label AS "SUB_SCH_LDSC", cat AS "SCH_FEE_CAT_CD", CASE WHEN cat IS NOT NULL THEN 'Category ' || cat END AS "SCH_FEE_CAT_DSC", CAST(sum(amt) AS DECIMAL(34,2)) AS "TXN_AMT", CAST(sum(n) AS BIGINT) AS "TXN_CNT", CAST(sum(irf) AS DECIMAL(34,4)) AS "TXN_IRF",
        CAST(sum(qrt) AS DECIMAL(34,8)) AS "QRT_AMT", CAST(sum(clr) AS DECIMAL(34,8)) AS "CLR_AMT", CAST(sum(qrt + clr) AS DECIMAL(34,8)) AS "TOT_PLUS_1_AMT", CAST(sum(qrt + clr + irf) AS DECIMAL(34,8)) AS "TOT_AMT",
        CASE WHEN sum(amt) = 0 THEN 0 ELSE CAST(CAST(round(sum(qrt), 2) * 100 AS HUGEINT) * 1000000 // CAST(sum(amt) * 100 AS HUGEINT) AS BIGINT) END AS "QRT_FEE" FROM
       (SELECT o.*, CASE o.sub WHEN 1 THEN 'Main' ELSE 'Second' END AS label, coalesce(f.qrt, CAST(0 AS DECIMAL(28,8))) AS qrt, coalesce(f.clr, CAST(0 AS DECIMAL(28,8))) AS clr,
         CASE WHEN o.prg = 4 AND o.fnd = 2 THEN CASE WHEN o.scp = 1 THEN NULL WHEN o.scp = 2 AND o.c_id = 90 THEN '02' WHEN o.c_id = 90 OR o.c_id IN (1, 2, 3) THEN '04' ELSE '08' END END AS cat
        FROM tot o LEFT JOIN fees f ON o.mth = f.mth AND o.sub = f.sub AND o.prs = f.prs AND o.prg = f.prg AND o.fnd IS NOT DISTINCT FROM f.fnd AND o.scp = f.scp AND o.c_id = f.c_id WHERE o.mth = {_PRINT_MONTH}) GROUP BY ALL""",
    ("txn",),
    MERCHANT_SQL,
)
def _merchant_report(spark, sf_dir):
    nation = fixtures.table(spark, sf_dir, "nation")
    alpha2 = "CASE n_nationkey WHEN 1 THEN 'AT' WHEN 2 THEN 'be' WHEN 3 THEN 'BG' ELSE 'N' || CAST(n_nationkey AS STRING) END"
    country = nation.selectExpr(
        "CASE WHEN n_nationkey = 5 THEN 90 ELSE n_nationkey END AS country_id", "CASE WHEN n_nationkey = 5 THEN '90' ELSE CAST(n_nationkey AS STRING) END AS numeric", f"{alpha2} AS alpha2", "'NN' || CAST(n_nationkey AS STRING) AS alpha3"
    )
    products = spark.createDataFrame([("MTA", 14, 2, 4), ("MTA ", 15, 3, 5)], "product_code string, legacy_product_id int, rng_fnd_id int, range_program_id int")
    types = spark.createDataFrame([("0", "PUR"), ("09", "CSH"), ("20", "REF")], "business_transaction_type_id string, transaction_type_id string")
    buckets = spark.createDataFrame([(1, "0", "100000"), (2, "0", "300000")], "id int, low string, high string").selectExpr("id", "CAST(low AS DECIMAL(28,6)) AS low", "CAST(high AS DECIMAL(28,6)) AS high")
    template = fixtures.table(spark, sf_dir, "part").selectExpr(
        "90 AS t_CTRY_ID", "1 AS t_STA", "'Total' AS t_FEE_DSC", "1 AS t_BUS_ID", "1 AS t_SCH_ID", "CASE WHEN p_size % 4 = 0 THEN 255 ELSE 1 + p_size % 2 END AS t_SUB_SCH_ID",
        "CASE WHEN p_size % 3 = 0 THEN 255 ELSE array(1, 2, 4, 8)[p_size % 4] END AS t_TXN_SCP_ID", "CASE WHEN p_size % 5 = 0 THEN 255 ELSE 4 END AS t_TXN_PRG_ID", "CASE WHEN p_size % 7 = 0 THEN 255 ELSE p_size % 2 END AS t_TXN_CRD_PRS_FLG_ID",
        *[f"255 AS {t}" for t in ("t_FND_SRC_ID", "t_TXN_TYP_ID", "t_TXN_RVSL_FLG_ID", "t_TXN_CRNCY_LCL_FLG_ID", "t_SCH_FEE_REG_ID", "t_TXN_ACS_FEE_FLG_ID", "t_RG_MCT_AMT_ID")],
        "CAST(p_size * CAST('0.01' AS DECIMAL(3,2)) AS DECIMAL(12,6)) AS FIX_QRT_FEE", "CAST(p_size * CAST('0.00001' AS DECIMAL(6,5)) AS DECIMAL(12,6)) AS VAR_CLR_FEE",
        *[f"CAST(NULL AS DECIMAL(12,6)) AS {k}_{f}_FEE" for f in aggregates.FEE_FAMILIES for k in ("FIX", "VAR") if (k, f) not in (("FIX", "QRT"), ("VAR", "CLR"))],
    )
    sub = spark.createDataFrame([(1, "Main "), (2, "Second")], "SUB_SCH_ID int, SUB_SCH_LDSC string")
    categories = spark.createDataFrame([(4, 2, s, str(s), f"Category 0{s}") for s in (2, 4, 8)], "TXN_PRG_ID int, TXN_FND_SRC_ID int, TXN_SCP_ID int, SCH_FEE_CAT_CD string, SCH_FEE_CAT_DSC string")
    rows = merchant_report.transactions(derived(spark, sf_dir, MERCHANT_MESSAGES), products, types, country, buckets)
    path = scratch_path(spark, "merchant-month")
    merchant_report.monthly(rows).write.parquet(path)
    report = merchant_report.printed_report(spark.read.parquet(path), template, country, sub, categories, _PRINT_MONTH)
    money = {"TXN_AMT": 2, "TXN_IRF": 4, "QRT_AMT": 8, "CLR_AMT": 8, "TOT_PLUS_1_AMT": 8, "TOT_AMT": 8}
    return report.select(
        "TXN_CRD_PRS_FLG_ID", "SUB_SCH_LDSC", "SCH_FEE_CAT_CD", "SCH_FEE_CAT_DSC", "TXN_CNT", *[C(c).cast(f"decimal(34,{s})").alias(c) for c, s in money.items()], F.floor(C("QRT_FEE") * 1_000_000).cast("bigint").alias("QRT_FEE")
    )
