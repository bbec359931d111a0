"""Unified transaction report over both record families."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clearspan.functions import classify, dates, numbers, text
from clearspan.operators import joins, sets
from clearspan.operators.columns import optional
from clearspan.operators.lookup import lookup_join
from clearspan.plans.visa_calculate import Client

C = F.col
OUTPUT = [
    "customer_code", "file_id", "row_id", "customer_country_code", "business_mode_code", "brand_code", "processing_date",
    "processing_month", "transaction_date", "transaction_month", "transaction_group_code", "transaction_type_id",
    "jurisdiction_code", "merchant_country_code", "mcc_code", "merchant", "merchant_id", "terminal_id", "acquirer_bin",
    "issuer_country_code", "issuer_bin_6", "issuer_bin_8", "funding_source_code", "product_program_id", "product_code",
    "card_present_code", "is_reversal_or_chargeback", "interchange_rule", "reported_currency_code", "transaction_amount",
    "interchange_fees_amount", "scheme_fees_amount",
]


def _rate(rows: DataFrame, rates: DataFrame, currency: str, client: Client, name: str = "__rate") -> DataFrame:
    wanted = rates.where(C("to_ccy") == client.report_currency)
    return joins.join_rate(rows, wanted, {"date": "rate_date", currency: "from_ccy"}, "rate", name, F.lit(1).cast(numbers.RATE))


def _converted(amount: Column, rate: str = "__rate") -> Column:
    return (C(rate).cast(numbers.RATE) * amount.cast("decimal(18,4)")).cast("decimal(24,6)")


def _finish(rows: DataFrame, values: dict[str, Column], client: Client) -> DataFrame:
    """Output columns, reversal signs, and own-bank acquiring rows a second time as issuing rows."""
    common = {
        "customer_code": F.lit(client.code), "file_id": C("content_hash").cast("string"), "reported_currency_code": F.lit(client.report_currency),
        "processing_date": C("date").cast("date"), "processing_month": dates.month_key(C("date").cast("date"), "-"),
        "scheme_fees_amount": F.lit(0).cast("decimal(24,6)"),
    }
    cells = {**common, **values}
    out = rows.select(*[cells[c].alias(c) for c in OUTPUT])
    reversal = C("is_reversal_or_chargeback")
    out = out.withColumns({c: numbers.signed_for_reversal(C(c), reversal).cast("decimal(24,6)") for c in ("transaction_amount", "interchange_fees_amount")})
    own = (C("jurisdiction_code") == "on-us") & (C("business_mode_code") == "A")
    return sets.duplicate_on_us(out, F.coalesce(own, F.lit(False)), "business_mode_code", "I", enabled=client.duplicate_on_us)


def _text_common(rows: DataFrame, country: DataFrame, products: DataFrame, merchant_key: str) -> DataFrame:
    for key, name in ((merchant_key, "merchant_alt"), ("ardef_country", "issuer_alt")):
        rows = lookup_join(rows, country, {key: "country_code"}, {"country_code_alternative": name})
    return lookup_join(rows, products, {"product_id": "bin_product_id"}, {"range_program_id": "program_id"})


def _text_values(get) -> dict[str, Column]:
    mode = C("business_mode")
    return {
        "customer_country_code": F.when(mode == "ISSUING", C("issuer_alt")).when(mode == "ACQUIRING", C("merchant_alt")),
        "business_mode_code": F.when(mode == "ISSUING", "I").when(mode == "ACQUIRING", "A"),
        "row_id": C("record").cast("bigint"), "brand_code": F.lit("VI"), "transaction_type_id": C("business_transaction_type").cast("string"),
        "jurisdiction_code": C("jurisdiction"), "merchant_country_code": C("merchant_alt"), "issuer_country_code": C("issuer_alt"),
        "issuer_bin_8": C("issuer_bin_8").try_cast("int"), "funding_source_code": C("funding_source"), "product_program_id": C("program_id").cast("int"),
        "product_code": C("product_id"), "is_reversal_or_chargeback": C("reversal_indicator").cast("boolean"),
        "interchange_rule": get("interchange_fee_descriptor").cast("string"),
    }


def draft_rows(drafts: DataFrame, country: DataFrame, products: DataFrame, rates: DataFrame, client: Client) -> DataFrame:
    get = lambda name: optional(drafts, name)
    rows = _rate(_text_common(drafts, country, products, "merchant_country_code"), rates, "source_currency_code_alphabetic", client)
    values = _text_values(get) | {
        "transaction_date": C("purchase_date").cast("date"), "transaction_month": dates.month_key(C("purchase_date").cast("date"), "-"),
        "transaction_group_code": classify.group_of_code(C("draft_code")), "mcc_code": get("merchant_category_code").cast("int"),
        "merchant": text.clean_upper(get("merchant_name")), "merchant_id": text.clean_upper(get("card_acceptor_id")), "terminal_id": text.clean_upper(get("terminal_id")),
        "acquirer_bin": get("account_reference_number_acquiring_identifier").cast("string").try_cast("int"),
        "issuer_bin_6": F.substring(C("account_number"), 1, 6).try_cast("int"), "card_present_code": classify.card_present_of_indicator(C("moto_ec_indicator")),
        "transaction_amount": _converted(C("source_amount")), "interchange_fees_amount": _converted(get("interchange_fee_amount")),
    }
    return _finish(rows, values, client)


def single_message_rows(messages: DataFrame, country: DataFrame, products: DataFrame, rates: DataFrame, client: Client) -> DataFrame:
    get = lambda name: optional(messages, name)
    rows = _text_common(messages.where("local_draft_date IS NOT NULL"), country, products, "card_acceptor_country")
    rows = _rate(rows, rates, "source_currency_code_alphabetic", client)
    rows = _rate(rows.withColumn("__usd", F.lit("USD")), rates, "__usd", client, "__usd_rate")
    amount = numbers.amount_or_fallback(C("source_amount"), C("__rate"), get("cryptogram_amount"), get("surcharge_amount_sms"), C("__usd_rate"))
    indicator = get("mail_telephone_or_electronic_commerce_indicator").cast("string")
    values = _text_values(get) | {
        "transaction_date": C("local_draft_date").cast("date"), "transaction_month": dates.month_key(C("local_draft_date").cast("date"), "-"),
        "transaction_group_code": classify.group_of_code(C("transaction_code_sms")), "mcc_code": get("merchant's_type").cast("int"),
        "merchant": text.clean_upper(get("card_acceptor_name")), "merchant_id": text.clean_upper(get("card_acceptor_id_sms")),
        "terminal_id": text.clean_upper(get("card_acceptor_terminal_id")), "acquirer_bin": get("acquiring_institution_id_1").cast("string").try_cast("int"),
        "issuer_bin_6": F.substring(C("card_number"), 1, 6).try_cast("int"), "card_present_code": classify.card_present_of_indicator(indicator),
        "transaction_amount": amount.cast("decimal(24,6)"), "interchange_fees_amount": _converted(get("interchange_fee_amount")),
    }
    return _finish(rows, values, client)


def message_rows(messages: DataFrame, currency: DataFrame, products: DataFrame, rates: DataFrame, client: Client) -> DataFrame:
    get = lambda name: optional(messages, name)
    incoming = C("file_type") == "IN"
    chargeback = C("type_mti").cast("string") == "1442"
    rows = messages.withColumns({
        "__product": F.coalesce(get("licensed_product_identifier_pds_3").cast("string"), C("gcms_product_identifier")),
        "__num": F.lpad(F.when(incoming, get("currency_code_reconciliation_de_50")).otherwise(C("currency_code_transaction_de_49")).cast("string"), 3, "0"),
    })
    rows = lookup_join(rows, products, {"__product": "bin_product_id"}, {"range_program_id": "program_id"})
    rows = lookup_join(rows, currency, {"__num": "currency_numeric_code"}, {"currency_alphabetic_code": "ccy_alpha"})
    rows = _rate(rows, rates, "ccy_alpha", client)
    issuer, merchant = C("iar_country"), C("card_acceptor_country_code_de_43_6")
    issuer_side, merchant_side = (F.when(chargeback, b).otherwise(a) for a, b in ((issuer, merchant), (merchant, issuer)))
    pan = C("pan_de_2").cast("string")
    values = {
        "row_id": C("ref_id").cast("bigint"), "customer_country_code": F.when(incoming, issuer_side).when(C("file_type") == "OUT", merchant_side),
        "business_mode_code": F.when(incoming, "I").when(C("file_type") == "OUT", "A"), "brand_code": F.lit("MC"),
        "transaction_date": F.to_date("date_de_12_1"), "transaction_month": dates.month_key(F.to_date("date_de_12_1"), "-"),
        "transaction_group_code": classify.group_of_processing(C("processing_code_de_3")), "transaction_type_id": F.substring("processing_code_de_3", 1, 2),
        "jurisdiction_code": C("jurisdiction"), "merchant_country_code": merchant_side, "mcc_code": get("card_acceptor_business_code_[mcc]_de_26").cast("int"),
        "merchant": text.clean_upper(get("card_acceptor_name_de_43_1")), "merchant_id": text.clean_upper(get("card_acceptor_id_code_de_42")),
        "terminal_id": text.clean_upper(get("card_acceptor_terminal_id_de_41")), "acquirer_bin": text.acquirer_bin(get("acquirer_reference_data_de_31").cast("string")),
        "issuer_country_code": issuer_side, "issuer_bin_6": F.substring(pan, 1, 6).try_cast("int"), "issuer_bin_8": F.substring(pan, 1, 8).try_cast("int"),
        "funding_source_code": get("funding_source").cast("string"), "product_program_id": C("program_id").cast("int"), "product_code": C("__product"),
        "card_present_code": classify.card_present_of_entry_mode(get("pos_entry_mode_de_22").cast("string")),
        "is_reversal_or_chargeback": classify.reversal_of_indicator(C("type_mti").cast("string"), get("message_reversal_indicator_pds_25").cast("string")),
        "interchange_rule": F.concat(get("jurisdiction_assigned").cast("string"), F.lit("-"), get("ird").cast("string")),
        "transaction_amount": _converted(F.when(incoming, get("amount_reconciliation_de_5")).otherwise(C("amount_transaction_de_4"))),
        "interchange_fees_amount": _converted(F.when(incoming, get("amounts_transaction_fee_7_pds_146_7").cast("decimal(18,4)")).otherwise(get("calculated_value").cast("decimal(18,4)"))),
    }
    return _finish(rows, values, client)


def report(frames: list[DataFrame], costs: DataFrame | None = None) -> DataFrame:
    """All families in one table, with unit scheme-fee costs by file, row and role if given."""
    rows = sets.union_by_name(frames)
    if costs is not None:
        rows = joins.attach_cost(rows, costs, ["file_id", "row_id", "business_mode_code"], "unitary_scheme_fee_cost", "scheme_fees_amount")
    return rows.select(*OUTPUT)


def unit_costs(detail: DataFrame) -> DataFrame:
    """Cost table of the fee report's final detail."""
    mode = F.when(C("business_mode_id") == "ACQUIRING", "A").when(C("business_mode_id") == "ISSUING", "I")
    return detail.select(
        C("app_hash_file").alias("file_id"), C("app_id").alias("row_id"), mode.alias("business_mode_code"), C("unitary_scheme_fee_cost").cast("decimal(24,6)").alias("unitary_scheme_fee_cost")
    ).where("business_mode_code IS NOT NULL")
