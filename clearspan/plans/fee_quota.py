"""Monthly scheme-fee report: detail, grouped report, export; and returned costs back to the detail."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from clearspan.functions import classify, numbers
from clearspan.operators import aggregates, filters, joins, sets
from clearspan.operators.columns import optional
from clearspan.operators.lookup import lookup_join
from clearspan.plans.visa_calculate import Client
from clearspan.sources import readers, sinks

C = F.col
DETAIL = [
    "app_type_file", "app_customer_code", "app_hash_file", "app_id", "table_description", "app_processing_date",
    "account_number", "card_acceptor_id", "account_funding_source", "account_range_country", "product_id",
    "range_program_id", "legacy_product_id", "jurisdiction", "business_transaction_type_id", "reversal_indicator",
    "currency_local_indicator", "motoec_indicator", "settlement_amount", "transaction_brand", "merchant_country_code",
    "switch_code", "travel_program_indicator", "greece_micropayment_indicator", "key_entered_tpe", "settlement_currency",
    "bank_country", "business_mode_id", "size_ticket", "transaction_purchase_date", "exchange_rate", "report_amount",
    "report_currency",
]
# Codes of the export.
EXPORT_MODE = {"ACQUIRING": 1, "ISSUING": 2}
EXPORT_SCHEME = {"MasterCard": 1, "VISA": 2}
EXPORT_SCOPE = {
    "MasterCard": {"on-us": 1, "off-us": 2, "intraregional": 4, "interregional": 8},
    "VISA": {"on-us": 1, "off-us": 2, "intraregional": 3, "interregional": 4},
}
EXPORT_TYPE = {"PUR": 1, "CSH": 8, "CRD": 1}
EXPORT_COLUMNS = [
    "app_id", "app_execution_id", "rpt_bnk_id", "set_mth", "bus_id", "sch_id", "tkt_siz_id", "prd_id", "prg_id",
    "fnd_src_id", "txn_scp_id", "txn_typ_id", "txn_rvsl_flg_id", "txn_crncy_lcl_flg_id", "txn_crd_prs_flg_id", "mct_cd",
    "txn_cnt", "txn_amt", "txn_sfc", "mct_ctry_id", "unt_sfc", "est_sch_fee_amt", "unt_est_sch_fee_amt", "swt_cd",
    "trvl_prg_ind", "grc_mpymt_ind", "key_etrd_tpe",
]
EXPORT_MEASURES = ["txn_cnt", "txn_amt", "txn_sfc", "unt_sfc", "est_sch_fee_amt", "unt_est_sch_fee_amt"]
EXPORT_PLAIN = ["app_id", "app_execution_id", "rpt_bnk_id", "set_mth"]
MISSING_CODE, MISSING_TEXT = 255, "9" * 16
MICROPAYMENT_COUNTRY = "GRC"


def month_root(root: str, client: str, month: str, stage: str) -> str:
    """Where a month's report lives; writer and readers share it."""
    return f"{root}/{client}/scheme_fee/{stage}/report_month={month}"


def filled_export(rows: DataFrame, columns: list[str], codes: list[str], texts: list[str], measures: list[str]) -> DataFrame:
    """Export columns with the fill value of their kind in place of nulls."""
    cells = {c: F.coalesce(C(c), F.lit(MISSING_CODE)) for c in codes}
    cells |= {c: F.coalesce(C(c), F.lit(MISSING_TEXT)) for c in texts}
    cells |= {c: F.coalesce(C(c), F.lit(0)) for c in measures}
    return rows.select(*[cells.get(c, C(c)).alias(c) for c in columns])


def _report_amount(rows: DataFrame, rates: DataFrame, brand: str, currency: str, amount, client: Client) -> DataFrame:
    wanted = rates.where((F.upper("brand") == brand.upper()) & (C("to_ccy") == client.report_currency))
    rows = joins.join_rate(rows, wanted, {"date": "rate_date", currency: "from_ccy"}, "rate", "exchange_rate", F.lit(1).cast(numbers.RATE))
    return rows.withColumn("report_amount", (C("exchange_rate").cast(numbers.RATE) * amount.cast("decimal(18,4)")).cast("decimal(24,6)"))


def _product(rows: DataFrame, products: DataFrame, brand: str, key: str) -> DataFrame:
    dim = products.where(C("brand") == brand).groupBy("product_code").agg(F.min("range_program_id").alias("p"), F.min("legacy_product_id").alias("l"))
    return lookup_join(rows, dim, {key: "product_code"}, {"p": "range_program_id", "l": "legacy_product_id"})


def _switch(rows: DataFrame, local_files: DataFrame, switches: DataFrame, client: Client, brand: str) -> DataFrame:
    """Switch code of rows of local files: the client's one configured number, else 0."""
    mine = switches.where((C("customer_code") == client.code) & (C("brand_code") == brand))
    switch = mine.agg(F.min("switch_id").alias("id")).first()["id"] or 0
    listed = local_files.select("content_hash").distinct().withColumn("__local", F.lit(1))
    rows = lookup_join(rows, listed, ["content_hash"], ["__local"])
    return rows.withColumn("switch_code", classify.switch_code(C("__local").isNotNull(), F.lit(switch)).cast("int")).drop("__local")


def _detail(rows: DataFrame, values: dict, client: Client, is_own, copy_label: str) -> DataFrame:
    constants = {
        "app_customer_code": F.lit(client.code), "bank_country": F.lit(client.country), "report_currency": F.lit(client.report_currency),
        "size_ticket": F.lit(0), "app_type_file": C("file_type"), "app_hash_file": C("content_hash"), "app_processing_date": C("date"),
    }
    cells = {**constants, **values}
    detail = rows.select(*[(cells[c] if c in cells else C(c)).alias(c) for c in DETAIL])
    own = (C("jurisdiction") == "on-us") & (C("business_mode_id") == "ACQUIRING")
    return sets.duplicate_on_us(detail, F.coalesce(own, F.lit(False)), "business_mode_id", "ISSUING", {"table_description": copy_label}, is_own)


def draft_detail(drafts: DataFrame, client: Client, rates, products, types, local_files, switches) -> DataFrame:
    """Detail rows of text drafts."""
    get = lambda name: optional(drafts, name)
    terminals = aggregates.distinct_terminals(drafts, "card_acceptor_id", "terminal_id")
    rows = lookup_join(drafts, types, {"business_transaction_type": "type_key"}, {"transaction_type_id": "business_transaction_type_id"})
    rows = rows.where(filters.reported_draft(C("business_transaction_type_id"), C("draft_code")))
    rows = _switch(rows, local_files, switches, client, "VISA")
    rows = _report_amount(rows, rates, "VISA", "source_currency_code_alphabetic", C("source_amount"), client)
    rows = _product(rows, products, "VISA", "product_id")
    rows = lookup_join(rows, terminals, ["card_acceptor_id"], ["count_terminal"])
    micropayment = F.lit(0)
    if client.country == MICROPAYMENT_COUNTRY:
        micropayment = classify.micropayment(
            get("merchant_category_code").cast("int"), C("jurisdiction"), C("product_id"), C("moto_ec_indicator"), C("report_amount"), C("count_terminal")
        )
    mode = F.upper("business_mode")
    values = {
        "app_id": C("record").cast("bigint"), "table_description": F.when(mode == "ACQUIRING", "VISA ACQ").otherwise("VISA ISS"),
        "account_number": C("account_number").cast("string"), "card_acceptor_id": C("card_acceptor_id").cast("string"),
        "account_funding_source": classify.funding_group(C("funding_source")), "account_range_country": C("ardef_country"),
        "reversal_indicator": C("reversal_indicator").cast("int"),
        "currency_local_indicator": classify.currency_is_local(C("source_currency_code_alphabetic"), F.lit(client.local_currency), get("dcc_indicator")),
        "motoec_indicator": classify.remote_order_flag(C("moto_ec_indicator")), "settlement_amount": F.lit(None).cast("decimal(18,4)"),
        "transaction_brand": F.lit("VISA"), "travel_program_indicator": classify.travel_program(C("product_id")),
        "greece_micropayment_indicator": micropayment, "key_entered_tpe": F.lit(0),
        "settlement_currency": C("settlement_report_currency_code"), "business_mode_id": mode,
        "transaction_purchase_date": C("purchase_date").cast("date"),
    }
    return _detail(rows, values, client, client.duplicate_on_us, "VISA ON-US DUP (ACQ TO ISS)")


def single_message_detail(messages: DataFrame, client: Client, rates, products, types, local_files, switches, currency) -> DataFrame:
    """Detail rows of single messages; a zero amount falls back to cryptogram amount plus surcharge."""
    get = lambda name: optional(messages, name)
    rows = messages.where("local_draft_date IS NOT NULL")
    rows = lookup_join(rows, types, {"business_transaction_type": "type_key"}, {"transaction_type_id": "business_transaction_type_id"})
    rows = rows.where(filters.reported_draft(C("business_transaction_type_id"), C("transaction_code_sms")))
    rows = _switch(rows, local_files, switches, client, "VISA")
    for key, name in (("draft_currency_code", "draft_ccy"), ("cryptogram_currency_code", "crypto_ccy"), ("settlement_currency_code_sms", "settle_ccy")):
        rows = lookup_join(rows, currency, {key: "currency_numeric_code"}, {"currency_alphabetic_code": name})
    zero = F.lit(0).cast("decimal(18,4)")
    other = F.coalesce(C("cryptogram_amount").cast("decimal(18,4)"), zero) + F.coalesce(C("surcharge_amount_sms").cast("decimal(18,4)"), zero)
    is_zero = C("source_amount") == 0
    rows = rows.withColumn("used_ccy", F.when(is_zero, C("crypto_ccy")).otherwise(C("draft_ccy")))
    amount = F.when(is_zero, other.cast("decimal(18,4)")).otherwise(C("source_amount").cast("decimal(18,4)"))
    rows = _report_amount(rows, rates, "VISA", "used_ccy", amount, client)
    rows = _product(rows, products, "VISA", "product_id_sms")
    values = {
        "app_id": C("record").cast("bigint"), "table_description": F.lit("VISA SMS"), "account_number": C("card_number").cast("string"),
        "card_acceptor_id": get("card_acceptor_terminal_id").cast("string"), "account_funding_source": classify.funding_group(C("account_funding_source")),
        "account_range_country": get("pan_extended_country_code").cast("string"), "product_id": C("product_id_sms"),
        "reversal_indicator": C("reversal_indicator").cast("int"),
        "currency_local_indicator": classify.currency_is_local(C("draft_ccy"), F.lit(client.local_currency), get("dcc_indicator_sms")),
        "motoec_indicator": classify.remote_order_flag(get("mail_telephone_or_electronic_commerce_indicator").cast("string")),
        "settlement_amount": get("settlement_amount").cast("decimal(18,4)"), "transaction_brand": F.lit("VISA"),
        "merchant_country_code": C("card_acceptor_country"), "travel_program_indicator": classify.travel_program(get("product_id").cast("string")),
        "greece_micropayment_indicator": F.lit(0), "key_entered_tpe": F.lit(0), "settlement_currency": C("settle_ccy"),
        "business_mode_id": F.upper("business_mode"), "transaction_purchase_date": C("local_draft_date").cast("date"),
    }
    return _detail(rows, values, client, client.duplicate_on_us, "VISA ON-US DUP (SMS TO ISS)")


def message_detail(messages: DataFrame, client: Client, rates, products, types, local_files, switches, currency) -> DataFrame:
    """Detail rows of messages of classes 1240 and 1442; the latter swaps issuer and merchant country."""
    get = lambda name: optional(messages, name)
    chargeback = C("type_mti").cast("string") == "1442"
    incoming = C("file_type") == "IN"
    rows = messages.withColumns({
        "__type": F.substring("processing_code_de_3", 1, 2),
        "__num": F.lpad(F.when(incoming, get("currency_code_reconciliation_de_50")).otherwise(C("currency_code_transaction_de_49")).cast("string"), 3, "0"),
        "account_range_country": F.when(chargeback, C("card_acceptor_country_code_de_43_6")).otherwise(C("iar_country")),
        "merchant_country_code": F.when(chargeback, C("iar_country")).otherwise(C("card_acceptor_country_code_de_43_6")),
    })
    rows = lookup_join(rows, types, {"__type": "type_key"}, {"transaction_type_id": "business_transaction_type_id"})
    rows = _switch(rows, local_files, switches, client, "MasterCard")
    rows = lookup_join(rows, currency, {"__num": "currency_numeric_code"}, {"currency_alphabetic_code": "ccy_alpha"})
    amount = F.when(incoming, get("amount_reconciliation_de_5")).otherwise(C("amount_transaction_de_4"))
    rows = _report_amount(rows, rates, "MasterCard", "ccy_alpha", amount, client)
    rows = _product(rows, products, "MC", "gcms_product_identifier")
    entry = get("pos_entry_mode_de_22").cast("string")
    mcc = get("card_acceptor_business_code_[mcc]_de_26").cast("int")
    values = {
        "app_id": C("ref_id").cast("bigint"), "table_description": F.lit("MASTERCARD ISS AND ACQ"),
        "account_number": F.substring(C("pan_de_2").cast("string"), 1, 16), "card_acceptor_id": get("card_acceptor_id_code_de_42").cast("string"),
        "account_funding_source": C("funding_source"), "product_id": C("gcms_product_identifier"),
        "reversal_indicator": classify.reversal_of_indicator(C("type_mti").cast("string"), get("message_reversal_indicator_pds_25").cast("string")).cast("int"),
        "currency_local_indicator": classify.currency_is_local(C("ccy_alpha"), F.lit(client.local_currency)),
        "motoec_indicator": F.when(F.substring(entry, 6, 1) == "0", 0).otherwise(1),
        "settlement_amount": get("settlement_report_amount").cast("decimal(18,4)"), "transaction_brand": F.lit("MasterCard"),
        "travel_program_indicator": classify.travel_program_of_message(get("business_activity_4_pds_158_4").cast("string"), C("gcms_product_identifier"), mcc),
        "greece_micropayment_indicator": F.lit(0), "key_entered_tpe": classify.key_entered(entry, C("jurisdiction"), C("account_range_country")),
        "settlement_currency": get("settlement_report_currency_code").cast("string"), "business_mode_id": F.upper("business_mode"),
        "transaction_purchase_date": F.to_date(get("date_and_time_local_transaction_de_12")),
    }
    return _detail(rows, values, client, client.duplicate_on_us, "MASTERCARD ON-US DUP (ACQ TO ISS)")


def with_size_ticket(detail: DataFrame, tickets: DataFrame, rates: DataFrame) -> DataFrame:
    """Size bucket of the amount in the ticket's currency, by brand and bank country."""
    currencies = tickets.groupBy("brand", "country_code_list").agg(F.min("ticket_currency").alias("ticket_currency"))
    keys = {"transaction_brand": "brand", "bank_country": "country_code_list"}
    rows = lookup_join(detail, currencies, keys, ["ticket_currency"])
    by_brand = rates.withColumn("rate_brand", F.upper("brand"))
    rows = rows.withColumn("__brand", F.upper("transaction_brand"))
    rows = joins.join_rate(
        rows, by_brand, {"app_processing_date": "rate_date", "__brand": "rate_brand", "report_currency": "from_ccy", "ticket_currency": "to_ccy"}, "rate", "__fx"
    )
    same = C("report_currency") == C("ticket_currency")
    amount = F.when(same, C("report_amount")).otherwise((C("report_amount") * C("__fx")).cast("decimal(24,6)")).cast("decimal(24,6)")
    rows = rows.withColumn("__ticket_amount", amount)
    rows = joins.join_bucket(
        rows, tickets, keys, C("__ticket_amount"), "size_ticket_min", "size_ticket_max", "size_ticket_id", "size_ticket", 0, half_open=True
    )
    return rows.select(*detail.columns)


def fee_report(detail: DataFrame) -> DataFrame:
    """The grouped report of a detail with size tickets, with a dense ``app_id``."""
    report = aggregates.fee_report(detail, aggregates.FEE_REPORT_DIMS, "report_amount", "legacy_product_id")
    return sinks.numbered(report, aggregates.FEE_REPORT_DIMS, "app_id")


def generate(details: list[DataFrame], tickets: DataFrame, rates: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Detail with size tickets, and the grouped report with a dense ``app_id``."""
    detail = with_size_ticket(sets.union_by_name(details), tickets, rates)
    return detail, fee_report(detail)


def export(report: DataFrame, country: DataFrame, funding: DataFrame, execution: str, month: str, client: Client) -> DataFrame:
    """The 27 export columns of the grouped report."""
    rows = lookup_join(report, funding, {"account_funding_source": "bin_funding_source_code"}, {"bin_funding_source_mc_numeric_code": "fnd_src_id"})
    by_alpha2 = country.groupBy("country_code").agg(F.min("legacy_country_id").alias("id"))
    by_alpha3 = country.groupBy("country_code_alternative").agg(F.min("legacy_country_id").alias("id"))
    rows = lookup_join(rows, by_alpha2, {"merchant_country_code": "country_code"}, {"id": "__id2"})
    rows = lookup_join(rows, by_alpha3, {"merchant_country_code": "country_code_alternative"}, {"id": "__id3"})
    brand = C("transaction_brand")
    cells = {
        "app_execution_id": F.lit(execution), "rpt_bnk_id": F.lit(client.code), "set_mth": F.lit(int(month)),
        "bus_id": classify.by_map(C("business_mode_id"), EXPORT_MODE), "sch_id": classify.by_map(brand, EXPORT_SCHEME), "tkt_siz_id": C("size_ticket"),
        "prd_id": C("legacy_product_id"), "prg_id": C("range_program_id"), "txn_scp_id": classify.brand_map(brand, C("jurisdiction"), EXPORT_SCOPE, "VISA"),
        "txn_typ_id": classify.by_map(C("business_transaction_type_id"), EXPORT_TYPE), "txn_rvsl_flg_id": C("reversal_indicator"),
        "txn_crncy_lcl_flg_id": C("currency_local_indicator"), "txn_crd_prs_flg_id": C("motoec_indicator"), "mct_cd": F.substring("account_number", 1, 16),
        "txn_cnt": C("transaction_count"), "txn_amt": C("transaction_amount"), "txn_sfc": C("transaction_scheme_fee_cost"),
        "mct_ctry_id": F.when(brand == "MasterCard", C("__id3")).otherwise(C("__id2")), "unt_sfc": C("unitary_scheme_fee_cost"),
        "est_sch_fee_amt": C("estimated_scheme_fee_cost"), "unt_est_sch_fee_amt": C("unitary_estimated_scheme_fee_cost"), "swt_cd": C("switch_code"),
        "trvl_prg_ind": C("travel_program_indicator"), "grc_mpymt_ind": C("greece_micropayment_indicator"), "key_etrd_tpe": C("key_entered_tpe"),
    }
    rows = rows.withColumns(cells)
    codes = [c for c in EXPORT_COLUMNS if c not in EXPORT_MEASURES + EXPORT_PLAIN + ["mct_cd"]]
    return filled_export(rows, EXPORT_COLUMNS, codes, ["mct_cd"], EXPORT_MEASURES)


def store_generated(spark: SparkSession, root: str, client: Client, month: str, details: list[DataFrame], tickets, rates, country, funding, execution: str) -> DataFrame:
    """Write detail, report, export and run summary; the stored report feeds the export."""
    base = month_root(root, client.code, month, "state")
    detail = with_size_ticket(sets.union_by_name(details), tickets, rates)
    # Counted while they are written; the report is made from the detail as it is stored.
    rows = sinks.write_counted(detail, f"{base}/detail", rows_per_file=1_000_000)["rows"]
    stored = spark.read.schema(detail.schema).parquet(f"{base}/detail")
    report = fee_report(stored)
    groups = sinks.write_counted(report, f"{base}/report")["rows"]
    out = export(spark.read.schema(report.schema).parquet(f"{base}/report"), country, funding, execution, month, client)
    out.orderBy("app_id").write.mode("overwrite").option("header", True).csv(f"{base}/export")
    sinks.write_run_summary(
        spark, f"{base}/summary", client_code=client.code, report_month=month, execution_id=execution, number_of_groups=groups, number_of_inserted_rows=rows
    )
    return out


RETURNED_SCHEMA = "app_id bigint, txn_cnt decimal(18,0), txn_sfc decimal(24,6), est_sch_fee_amt decimal(24,6), mct_cd string, prg_id string"
SUMMARY_SCHEMA = "client_code string, report_month string, execution_id string, number_of_groups bigint, number_of_inserted_rows bigint"


def with_costs(report: DataFrame, returned: DataFrame) -> DataFrame:
    """Returned costs laid over the report."""
    costs = returned.select(
        "app_id", C("txn_sfc").alias("c0"), numbers.unit_cost(C("txn_sfc"), C("txn_cnt")).alias("c1"), C("est_sch_fee_amt").alias("c2"),
        numbers.unit_cost(C("est_sch_fee_amt"), C("txn_cnt")).alias("c3"),
    )
    return joins.overlay(report, costs, ["app_id"], dict(zip(aggregates.COST_COLUMNS, ("c0", "c1", "c2", "c3"))))


def carried_costs(detail: DataFrame, updated: DataFrame) -> DataFrame:
    """Costs of the report carried to every detail row."""
    plain = detail.drop(*[c for c in aggregates.COST_COLUMNS if c in detail.columns])
    dims = {c: c for c in aggregates.FEE_REPORT_DIMS}
    return lookup_join(plain, updated, dims, {c: c for c in aggregates.COST_COLUMNS}, null_safe=True)


def store_returned(spark: SparkSession, root: str, client: Client, month: str, returned_path: str) -> None:
    """Read the returned cost file, update report and detail, and check the run's control totals.

    Totals are counted while the tables are written; a table whose total is wrong does not take its place.
    """
    base, final_base = (month_root(root, client.code, month, s) for s in ("state", "final"))
    summary = sinks.read_run_summary(spark, f"{base}/summary", SUMMARY_SCHEMA).first()
    came = Observation()
    returned = readers.scan_returned_costs(spark, returned_path, RETURNED_SCHEMA).observe(came, F.count("*").alias("rows"))
    updated = with_costs(spark.read.parquet(f"{base}/report"), returned)

    def groups_agree(totals: dict) -> None:
        aggregates.check_totals(came.get["rows"], summary["number_of_groups"], "returned cost file")
        aggregates.check_totals(totals["rows"], summary["number_of_groups"], "updated report")

    sinks.write_counted(updated, f"{final_base}/report", groups_agree)
    final = carried_costs(spark.read.parquet(f"{base}/detail"), spark.read.parquet(f"{final_base}/report"))
    sinks.write_counted(
        final, f"{final_base}/detail", lambda totals: aggregates.check_totals(totals["rows"], summary["number_of_inserted_rows"], "updated detail"), rows_per_file=1_000_000
    )
