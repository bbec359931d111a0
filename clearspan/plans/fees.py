"""Fee rule assignment and fee amounts for both record families."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from clearspan.functions import classify, numbers, text
from clearspan.operators import joins, rule_index, rules
from clearspan.operators.columns import optional
from clearspan.operators.lookup import lookup_join

C = F.col

# Rule columns that are no conditions on text records.
NOT_CONDITIONS = {
    "region_country_code", "valid_from", "valid_until", "rule_id", "fee_descriptor", "fee_description", "fee_currency",
    "fee_variable", "fee_fixed", "fee_min", "fee_cap", "jurisdiction", "fee_program", "guide_date", "fpi", "cod_hierarchy",
    "program_default", "source_currency_code_alphabetic", "message_identifier", "validation_code",
    "v_i_p_full_financial_message_sets", "sender_data", "additional_sender_data", "settlement_service",
    "other_criteria_applies",
}
# Rule columns that are compared as numbers, and as present or absent amounts.
NUMBER_CONDITIONS = {"timeliness", "surcharge_amount", "surcharge_amount_sms"}
YES_NO_CONDITIONS = {"cashback"}
# Rule column -> transaction column, and rule columns left out, by record type.
RULE_COLUMNS = {
    "draft": {
        "account_funding_source": "funding_source", "acquirer_bin": "account_reference_number_acquiring_identifier",
        "authorization_code": "authorization_code_valid", "cvv2_result_code": "cvv_result_code",
        "dynamic_currency_conversion_indicator": "dcc_indicator", "merchant_country_code": "jurisdiction_country",
        "merchant_country_region": "jurisdiction_region", "merchant_vat": "merchant_vat_registration_number",
        "moto_eci_indicator": "moto_ec_indicator", "national_tax_indicator": "national_tax_included",
        "pos_environment_code": "pos_environment", "pos_terminal_capability": "pos_terminal_capacity",
        "special_condition_indicator": "special_condition_indicator_merchant_draft_indicator",
        "summary_commodity": "summary_commodity_code", "transaction_amount": "source_amount",
        "transaction_amount_currency": "source_currency_code_alphabetic",
        "transaction_code_qualifier": "draft_code_qualifier_0", "transaction_code": "draft_code",
        "type_purchase": "type_of_purchase",
    },
    "sms": {
        "account_funding_source": "funding_source", "acceptance_terminal_indicator": "pos_terminal_type",
        "acquirer_business_id": "acquirer_business_id_sms",
        "authorization_characteristics_indicator": "authorization_characteristics_indicator_sms",
        "authorization_code": "authorization_code_valid", "authorization_response_code": "response_code",
        "business_application_id": "business_application_identifier",
        "cardholder_id_method": "customer_identification_method", "cvv2_result_code": "cvv_result_code_sms",
        "dynamic_currency_conversion_indicator": "dcc_indicator_sms", "fee_program_indicator": "fee_program_indicator_sms",
        "merchant_category_code": "merchant's_type", "merchant_country_code": "jurisdiction_country",
        "merchant_country_region": "jurisdiction_region", "merchant_verification_value": "mvv_code",
        "message_reason_code": "message_reason_code_sms",
        "moto_eci_indicator": "mail_telephone_or_electronic_commerce_indicator",
        "network_identification_code": "network_id", "point_of_service_condition_code": "pos_condition_code",
        "pos_environment_code": "recurring_payment_indicator_flag", "pos_entry_mode": "pos_entry_mode_sms",
        "pos_terminal_capability": "pos_terminal_entry_capability", "reimbursement_attribute": "reimbursement_attribute_sms",
        "special_condition_indicator": "chargeback_special_condition_merchant_indicator",
        "summary_commodity": "summary_commodity_code", "surcharge_amount": "surcharge_amount_sms",
        "transaction_amount": "source_amount", "transaction_amount_currency": "source_currency_code_alphabetic",
        "transaction_code": "transaction_code_sms", "usage_code": "usage_code_sms",
    },
}
RULES_LEFT_OUT = {
    "draft": ["acquirer_country", "acquirer_region", "processing_code_transaction_type", "point_of_service_condition_code"],
    "sms": [
        "acquirer_country", "acquirer_region", "authorized_amount", "business_format_code", "merchant_vat",
        "national_tax_indicator", "prepaid_card_indicator", "summary_commodity", "transaction_code_qualifier",
        "type_purchase", "settlement_flag", "token_requestor_id", "cashback",
    ],
}
# Token conditions of message rules -> transaction column.
MESSAGE_CONDITIONS = {
    "processing_code": "processing_code", "card_acceptor_business_code": "card_acceptor_business_code",
    "gcms_product_identifier": "gcms_product_identifier", "funding_source": "funding_source",
    "mastercard_assigned_id": "mastercard_assigned_id", "card_present_data": "card_present_data",
    "merchant_country": "merchant_country",
    "transaction_destination_institution": "transaction_destination_institution_id",
    "tti": "transaction_type_identifier", "ucaf_collection_id": "ucaf_collection_id", "token_flag": "token_flag",
    "card_program_indicator": "card_program_indicator", "issuer_country": "issuer_country", "issuer_bin_8": "issuer_bin_8",
}
RULE_AMOUNT, RULE_AMOUNT_CURRENCY = "source_amount", "source_currency_code_alphabetic"


TEXT_RULE_RESULT = ["rule_id", "fee_descriptor", "fee_currency", "fee_variable", "fee_fixed", "fee_min", "fee_cap"]


def _one_rate(rates: DataFrame, keys: list[str]) -> DataFrame:
    return rates.groupBy(*keys).agg(F.max("rate").alias("rate"))


def assign_text_rules(rows: DataFrame, rule_table: DataFrame, rates: DataFrame, kind: str, day: str = "file_date") -> DataFrame:
    """First matching rule of text records by (region, rule id); unmatched rows get id -1.

    ``rates`` has ``rate_date``, ``from_ccy``, ``to_ccy`` and ``rate``.
    """
    renames = {k: v for k, v in RULE_COLUMNS[kind].items() if k in rule_table.columns}
    table = rule_table.drop(*RULES_LEFT_OUT[kind]).withColumnsRenamed(renames)
    tested = [c for c in table.columns if c not in NOT_CONDITIONS | {RULE_AMOUNT} and c in rows.columns]
    tokens, bounds, values, parsed = {}, {}, {}, {}
    for n, c in enumerate(tested):
        cell, value = C(f"`{c}`"), C(f"`{c}`").cast("string")
        if c in NUMBER_CONDITIONS:
            bounds[f"p{n}"], values[f"v{n}"], parsed[f"p{n}"] = f"v{n}", cell.cast(rules.BOUND), rules.number_condition(value)
            continue
        tokens[f"p{n}"] = f"v{n}"
        if c in YES_NO_CONDITIONS:
            values[f"v{n}"], parsed[f"p{n}"] = rule_index.amount_class(cell.cast(rules.BOUND)), rule_index.yes_no_condition(cell)
        else:
            values[f"v{n}"] = F.coalesce(value, F.lit("")) if c in rules.BLANK_MATTERS else text.or_blank_word(value, when_empty=True)
            parsed[f"p{n}"] = rules.token_condition(cell, space_word=True)
    bounds["days"], values["v_day"], parsed["days"] = "v_day", rule_index.days(C(day)), rule_index.validity(C("valid_from"), C("valid_until"))

    facts, amounts = rows, None
    if {RULE_AMOUNT, RULE_AMOUNT_CURRENCY} <= set(table.columns):
        facts = rules.converted_amounts(rows, rates.withColumnRenamed("rate_date", day), RULE_AMOUNT_CURRENCY, [day])
        parsed["amounts"] = rules.number_condition(C(RULE_AMOUNT).cast("string"))
        amounts = rule_index.Amounts("amounts", RULE_AMOUNT_CURRENCY, RULE_AMOUNT, RULE_AMOUNT_CURRENCY, "rates_to")
    conditions = rule_index.Conditions({"jurisdiction_assigned": "region_country_code"}, tokens, bounds, amounts)
    order = [C("rule_id").cast("bigint"), "valid_from", "fee_descriptor"]
    index = rule_index.build_index(table.withColumns(parsed), conditions, order, [C(c) for c in TEXT_RULE_RESULT])
    take = {c: f"interchange_{c}" for c in TEXT_RULE_RESULT}
    matched = rule_index.first_rule(facts.withColumns(values), index, take)
    unmatched = C("interchange_rule_id").isNull()
    zero = F.lit(0).cast("decimal(14,8)")
    filled = {"interchange_rule_id": F.coalesce(C("interchange_rule_id").cast("int"), F.lit(-1))}
    filled |= {f"interchange_{c}": F.coalesce(C(f"interchange_{c}"), F.lit("")) for c in ("fee_descriptor", "fee_currency")}
    filled |= {f"interchange_{c}": F.coalesce(C(f"interchange_{c}").cast("decimal(14,8)"), zero) for c in ("fee_variable", "fee_fixed")}
    filled |= {f"interchange_{c}": F.when(unmatched, zero).otherwise(C(f"interchange_{c}").cast("decimal(14,8)")) for c in ("fee_min", "fee_cap")}
    return matched.withColumns(filled).select(*rows.columns, *take.values())


def text_fees(cleaned: DataFrame, calculated: DataFrame, rule_table: DataFrame, rates: DataFrame, kind: str, day: str = "file_date") -> DataFrame:
    """Fee columns of text records: consolidate, first rule, clamped fee."""
    merged = joins.join_suffixing(cleaned, calculated, ["content_hash", "record"], "_cln")
    assigned = assign_text_rules(merged, rule_table, rates, kind, day)
    single = _one_rate(rates, ["rate_date", "from_ccy", "to_ccy"])
    keys = {day: "rate_date", "interchange_fee_currency": "from_ccy", "source_currency_code_alphabetic": "to_ccy"}
    rated = lookup_join(assigned, single, keys, {"rate": "__rate"})
    fx = numbers.fee_rate_to(C("interchange_fee_currency"), C("source_currency_code_alphabetic"), C("__rate"))
    parts = [C(c) for c in ("source_amount", "interchange_fee_variable", "interchange_fee_fixed", "interchange_fee_min", "interchange_fee_cap")]
    out = rated.withColumn("interchange_fee_amount", numbers.fee_clamped(*parts, fx))
    names = ["rule_id", "fee_descriptor", "fee_currency", "fee_variable", "fee_fixed", "fee_min", "fee_cap", "fee_amount"]
    return out.select("content_hash", "record", *[f"interchange_{n}" for n in names])


KEYS = ["file_id", "file_idn", "ref_id"]


def message_evaluation(messages: DataFrame, calculated: DataFrame, currency: DataFrame) -> DataFrame:
    """Transaction values compared by message rules; missing data is the word BLANK."""
    get = lambda name: optional(messages, name)
    calc = calculated.select(
        *KEYS, C("jurisdiction_assigned").alias("jurisdiction"), "gcms_product_identifier", "funding_source", "settlement_report_amount",
        "settlement_report_currency_code", C("card_program_identifier").alias("card_program_indicator"), C("iar_country").alias("issuer_country"),
    )
    own = messages.select(
        *KEYS,
        F.substring(get("pan_de_2").cast("string"), 1, 8).alias("issuer_bin_8"),
        F.substring(get("acquirer_reference_data_de_31").cast("string"), 2, 6).alias("acquirer_bin"),
        get("business_activity_4_pds_158_4").cast("string").alias("ird"),
        F.substring(get("processing_code_de_3").cast("string"), 1, 2).alias("processing_code"),
        get("card_acceptor_business_code_[mcc]_de_26").cast("string").alias("card_acceptor_business_code"),
        get("mastercard_assigned_id_pds_176").cast("string").alias("mastercard_assigned_id"),
        get("card_present_data_de_22_6").cast("string").alias("card_present_data"),
        get("card_acceptor_country_code_de_43_6").cast("string").alias("merchant_country"),
        get("transaction_destination_institution_id_code_de_93").cast("string").alias("transaction_destination_institution_id"),
        get("transaction_type_identifier_pds_43").cast("string").alias("transaction_type_identifier"),
        get("electronic_commerce_indicator_3_pds_52_3").cast("string").alias("ucaf_collection_id"),
        classify.token_flag(get("token_requestor_id_pds_59").cast("string")).alias("token_flag"),
        C("amount_transaction_de_4").cast("decimal(18,4)").alias("amount_transaction"),
        C("currency_code_transaction_de_49").cast("bigint").alias("currency_code_transaction"),
        F.to_date("date_and_time_local_transaction_de_12").alias("txn_date"),
    )
    work = own.join(calc, KEYS)
    codes = currency.select(C("currency_numeric_code").cast("bigint").alias("num"), "currency_alphabetic_code")
    work = lookup_join(work, codes, {"currency_code_transaction": "num"}, {"currency_alphabetic_code": "amount_transaction_currency"})
    words = [c for c in {*MESSAGE_CONDITIONS.values(), "jurisdiction", "ird", "acquirer_bin", "amount_transaction_currency"} if c != "token_flag"]
    return work.withColumns({c: text.or_blank_word(C(c)) for c in sorted(words)})


def assign_message_rules(rows: DataFrame, rule_table: DataFrame, rates: DataFrame) -> DataFrame:
    """First matching rule of messages by (region, rule id); unmatched rows get rule 0.

    ``rule`` is the place of the rule among those of its region.
    """
    table = rule_table.withColumns({
        "region_key": F.upper(F.trim("region_country_code")), "ird_key": F.upper(F.trim("ird")),
        "valid_from": F.to_date("valid_from"), "valid_until": F.to_date("valid_until"),
    })
    order = [C("rule_id").cast("bigint"), "ird_key", "valid_from"]
    table = table.withColumn("rule", F.row_number().over(Window.partitionBy("region_key").orderBy(*order)))
    facts = rows.withColumns({"region_key": F.upper(F.trim("jurisdiction")), "ird_key": F.upper(F.trim("ird"))})
    tested = {c: v for c, v in MESSAGE_CONDITIONS.items() if c in table.columns}
    parsed = {f"parsed_{c}": rules.token_condition(C(c)) for c in tested} | {"days": rule_index.validity(C("valid_from"), C("valid_until"))}
    values = {f"v_{v}": text.rule_text(C(v)) for v in tested.values()} | {"v_day": rule_index.days(C("txn_date"))}
    amounts = None
    if "amount_transaction" in table.columns:
        facts = rules.converted_amounts(facts, rates.withColumnRenamed("rate_date", "txn_date"), "amount_transaction_currency", ["txn_date"])
        values["own_amount"] = C("amount_transaction").cast(rules.BOUND)
        parsed["amounts"] = rules.number_condition(C("amount_transaction").cast("string"), bare_equal=False)
        amounts = rule_index.Amounts("amounts", "amount_transaction_currency", "amount_transaction", "amount_transaction_currency", "rates_to", "own_amount")
    conditions = rule_index.Conditions(
        {"region_key": "region_key", "ird_key": "ird_key"}, {f"parsed_{c}": f"v_{v}" for c, v in tested.items()}, {"days": "v_day"}, amounts
    )
    names = ["region_country_code", "rule_id", "rate_currency", "rate_variable", "rate_fixed", "rate_min", "rate_cap", "valid_from", "valid_until", "rule"]
    index = rule_index.build_index(table.withColumns(parsed), conditions, order, [C(c) for c in names])
    matched = rule_index.first_rule(facts.withColumns(values), index, {c: c for c in names})
    return matched.withColumn("rule", F.coalesce("rule", F.lit(0))).select(*rows.columns, *names)


def message_fees(messages: DataFrame, calculated: DataFrame, rule_table: DataFrame, currency: DataFrame, rates: DataFrame) -> DataFrame:
    """Fee columns of messages for all files at once."""
    assigned = assign_message_rules(message_evaluation(messages, calculated, currency), rule_table, rates)
    single = _one_rate(rates, ["rate_date", "from_ccy", "to_ccy"])
    rated = assigned.withColumns({"__from": F.upper(F.trim("rate_currency")), "__to": F.upper(F.trim("amount_transaction_currency"))})
    rated = lookup_join(rated, single, {"txn_date": "rate_date", "__from": "from_ccy", "__to": "to_ccy"}, {"rate": "__rate"})
    fx = numbers.fee_rate_to(C("__from"), C("__to"), C("__rate"), blank_is_same=True)
    parts = [C("amount_transaction"), *[C(c).cast("decimal(14,8)") for c in ("rate_variable", "rate_fixed", "rate_min", "rate_cap")]]
    return rated.withColumn("fx_to_trx", fx).withColumn("calculated_value", numbers.fee_clamped_strict(*parts, fx)).drop("__from", "__to", "__rate")
