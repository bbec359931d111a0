"""Data quality reports: transactions against settlement summaries, over a whole date range at once."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clearspan.functions import classify, dates, numbers, text
from clearspan.operators import aggregates, filters, joins, sets
from clearspan.operators.columns import optional
from clearspan.operators.lookup import lookup_join
from clearspan.plans.visa_calculate import Client

C = F.col
TEXT_DIMS = [
    "app_processing_date", "data_source", "file_source", "app_customer_code", "business_mode", "jurisdiction",
    "settlement_currency", "reversal_indicator", "trx_type", "trx_cycle", "fee_descriptor", "report_currency_code",
]
MESSAGE_DIMS = [
    "app_processing_date", "data_source", "file_source", "app_customer_code", "app_message_type", "business_mode",
    "jurisdiction", "report_currency_code", "settlement_currency", "trx_type", "ird", "rule_id", "message_reason_code",
    "electronic_commerce_indicator", "reconciled_file_flg",
]
SUMMARY_CYCLE = "Original"
#: Currency code of the amounts, and what is summed.
MEASURES = ["__code", "__count", "__amount", "__fee"]


def _labels(client: Client, source: str, origin: str) -> dict:
    return {
        "data_source": F.lit(source), "file_source": F.lit(origin.lower()), "app_customer_code": F.lit(client.code),
        "report_currency_code": F.lit(client.report_currency),
    }


def _draft_rows(drafts: DataFrame, types: DataFrame, cycles: DataFrame, client: Client, modes: tuple[str, ...], origin: str) -> DataFrame:
    """Drafts of the wanted directions with their dimensions, the currency code of the amounts and what is summed."""
    directions = ["OUT" if m == "A" else "IN" for m in modes]
    rows = drafts.where(C("file_type").isin(directions)).withColumnRenamed("date", "app_processing_date")
    rows = lookup_join(rows, types, {"business_transaction_type": "btt_id"}, ["trx_type"])
    rows = lookup_join(rows, cycles, {"business_transaction_cycle": "btc_id"}, ["trx_cycle"])
    zero = F.lit(0).cast("decimal(18,4)")
    return rows.withColumns({
        **_labels(client, "Base II", origin), "business_mode": F.when(C("file_type") == "OUT", "Acquirer").otherwise("Issuer"),
        "settlement_currency": classify.local_or_foreign(C("settlement_report_currency_code"), F.lit(client.local_currency)),
        "reversal_indicator": F.when(C("reversal_indicator") == 0, "N").otherwise("Y"), "fee_descriptor": F.trim("interchange_fee_descriptor"),
        "__code": C("source_currency_code").cast("string"), "__count": F.lit(1).cast("decimal(18,0)"),
        "__amount": F.coalesce(C("source_amount").cast("decimal(18,4)"), zero), "__fee": F.coalesce(C("interchange_fee_amount").cast("decimal(18,4)"), zero),
    }).select(*TEXT_DIMS, *MEASURES)


def _summary_rows(summaries: DataFrame, types: DataFrame, cycles: DataFrame, client: Client, modes: tuple[str, ...], origin: str) -> DataFrame:
    """Settlement summary rows of the wanted roles in the shape of ``_draft_rows``; a row without credits or debits adds no fee."""
    columns = [C(c) for c in ("summary_level_130", "vss_aggregation_level", "no_data_indicator_130", "business_draft_type_130", "business_mode_130")]
    wanted = [filters.summary_detail(*columns, "1" if m == "A" else "2") for m in modes]
    rows = summaries.where(reduce(lambda a, b: a | b, wanted, F.lit(False))).withColumnRenamed("date", "app_processing_date")
    rows = lookup_join(rows, types, {"business_draft_type_130": "btt_code"}, ["trx_type"])
    rows = lookup_join(rows, cycles, {"business_draft_cycle_130": "btc_code"}, ["trx_cycle"]).where(C("trx_cycle") == SUMMARY_CYCLE)
    fee = C("reimbursement_fee_credits_settlement_currency").cast("decimal(18,4)") + C("reimbursement_fee_debits_settlement_currency").cast("decimal(18,4)")
    return rows.withColumns({
        **_labels(client, "VSS", origin), "business_mode": F.when(C("business_mode_130") == "1", "Acquirer").when(C("business_mode_130") == "2", "Issuer").otherwise(""),
        "jurisdiction": classify.jurisdiction_of_settlement(C("jurisdiction_code_130"), C("source_country_code_130"), C("destination_country_code_130")),
        "settlement_currency": F.lit(None).cast("string"), "reversal_indicator": C("reversal_indicator_130"), "fee_descriptor": F.trim("fee_level_descriptor"),
        "__code": C("settlement_currency_code_130").cast("string"), "__count": C("count_130").cast("decimal(18,0)"),
        "__amount": C("interchange_amount_settlement_currency_130").cast("decimal(18,4)"), "__fee": fee.cast("decimal(18,4)"),
    }).select(*TEXT_DIMS, *MEASURES)


def _converted(rate: str, value: str) -> Column:
    """Sum in the report currency; a missing rate is 1."""
    fx = F.coalesce(C(rate).cast(numbers.RATE), F.lit(1).cast(numbers.RATE))
    return F.sum((fx * C(value)).cast("decimal(28,10)"))


def text_quality(drafts, summaries, types, cycles, rates, client: Client, modes: tuple[str, ...] = ("A", "I"), origin: str = "default") -> DataFrame:
    """Drafts and settlement summaries by the twelve dimensions.

    Each source is read once: roles are a column, and the tagged rows of both meet the rates of their day in one lookup and
    are summed in one grouping.
    """
    rows = sets.union_by_name([_draft_rows(drafts, types, cycles, client, modes, origin), _summary_rows(summaries, types, cycles, client, modes, origin)])
    wanted = rates.where(C("to_ccy") == client.report_currency).withColumn("from_code", C("from_code").cast("string"))
    one_each = wanted.groupBy("rate_date", "from_code").agg(F.max("rate").alias("rate"), F.min("from_ccy").alias("from_ccy"))
    rows = lookup_join(rows, one_each, {"app_processing_date": "rate_date", "__code": "from_code"}, {"rate": "__rate", "from_ccy": "__alpha"})
    alpha = F.coalesce("__alpha", F.lit(client.report_currency))
    settled = classify.local_or_foreign(alpha, F.lit(client.local_currency))
    rows = rows.withColumn("settlement_currency", F.when(C("data_source") == "VSS", settled).otherwise(C("settlement_currency")))
    two = lambda value: F.round(value.cast("decimal(38,10)"), 2).cast("decimal(18,2)")
    return rows.groupBy(*TEXT_DIMS).agg(
        two(F.sum("__count")).alias("trx_count"), two(_converted("__rate", "__amount")).alias("trx_amt"), two(_converted("__rate", "__fee")).alias("itx_amt")
    )


def _total_rows(totals: DataFrame, client: Client, extra: bool, origin: str) -> DataFrame:
    """Reconciliation totals (class 1644, function 685) with their dimensions, lookup keys and what is summed."""
    get = lambda name: optional(totals, name)
    rows = totals.where(
        (C("type_mti").cast("string") == "1644") & (C("function_code").cast("string") == "685")
        & C("reconciled_transaction_function_1_pds_372_1").cast("string").isin("1240", "1442")
    )
    blank = F.lit("")
    return rows.withColumns({
        **_labels(client, "Settlement Data", origin), "app_processing_date": dates.parse_file_date(C("file_dt")),
        "app_message_type": C("reconciled_transaction_function_1_pds_372_1").cast("string"),
        "business_mode": aggregates.mode_of_member(C("reconciled_member_activity_pds_302")),
        "jurisdiction": aggregates.jurisdiction_of_activity(C("settlement_indicator_1_pds_165_1"), C("reconciled_business_activity_2_pds_358_2")),
        "settlement_currency": F.lit(None).cast("string"), "ird": C("reconciled_business_activity_4_pds_358_4").cast("string"),
        "rule_id": blank, "message_reason_code": get("message_reason_code_de_25").cast("string") if extra else blank,
        "electronic_commerce_indicator": get("electronic_commerce_indicator_3_pds_52_3").cast("string") if extra else blank,
        "reconciled_file_flg": get("reconciled_file_pds_300").cast("string") if extra else blank,
        "__processing": C("reconciled_processing_code_pds_374").cast("string"), "__code": C("currency_code_reconciliation_de_50").cast("bigint"),
        "__count": C("total_transaction_number_pds_402").cast("decimal(18,0)"),
        "__amount": C("amount_net_transaction_in_reconciliation_currency_2_pds_394_2").cast("decimal(18,4)"),
        "__fee": C("amount_net_fee_in_reconciliation_currency_2_pds_395_2").cast("decimal(18,4)"),
    }).select(*[c for c in MESSAGE_DIMS if c != "trx_type"], "__processing", *MEASURES)


def _transaction_rows(messages: DataFrame, client: Client, mode: str, extra: bool, unmask: bool, origin: str) -> DataFrame:
    """Transactions of classes 1240 and 1442 in the shape of ``_total_rows``; amount, fee and currency depend on the direction."""
    get = lambda name: optional(messages, name)
    incoming = mode == "I"
    rows = messages.where(C("type_mti").cast("string").isin("1240", "1442") & (C("file_type") == ("IN" if incoming else "OUT")))
    money = ("amount_reconciliation_de_5", "amounts_transaction_fee_7_pds_146_7", "currency_code_reconciliation_de_50") if incoming else (
        "amount_transaction_de_4", "calculated_value", "currency_code_transaction_de_49")
    blank = F.lit("")
    own = C("settlement_indicator_1_pds_165_1") == "C"
    return rows.withColumns({
        **_labels(client, "Transactional Data", origin), "app_processing_date": dates.parse_file_date(C("file_dt")), "app_message_type": C("type_mti").cast("string"),
        "business_mode": F.lit("Issuer" if incoming else "Acquirer"), "jurisdiction": F.when(own, "on-us").otherwise(C("jurisdiction")),
        "settlement_currency": classify.local_or_foreign(C("settlement_report_currency_code"), F.lit(client.report_currency)),
        "ird": get("business_activity_4_pds_158_4").cast("string"), "rule_id": get("rule_id").cast("string"),
        "message_reason_code": get("message_reason_code_de_25").cast("string") if extra else blank,
        "electronic_commerce_indicator": get("electronic_commerce_indicator_3_pds_52_3").cast("string") if extra else blank, "reconciled_file_flg": blank,
        "__processing": text.processing_code(C("processing_code_de_3"), get("business_activity_4_pds_158_4").cast("string"), unmask).cast("string"),
        "__code": C(money[2]).cast("bigint"), "__count": F.lit(1).cast("decimal(18,0)"),
        "__amount": C(money[0]).cast("decimal(18,4)"), "__fee": C(money[1]).cast("decimal(18,4)"),
    }).select(*[c for c in MESSAGE_DIMS if c != "trx_type"], "__processing", *MEASURES)


def message_quality(totals, messages, types, currency, rates, client: Client, mode: str, extra: bool = False, unmask: bool = False, origin: str = "default") -> DataFrame:
    """Settlement and transactional parts over the whole range: one scan per source, one set of lookups, one grouping."""
    rows = sets.union_by_name([_total_rows(totals, client, extra, origin), _transaction_rows(messages, client, mode, extra, unmask, origin)])
    rows = lookup_join(rows, types, {"__processing": "type_key"}, {"transaction_type_id": "trx_type"})
    wanted = rates.where(C("to_ccy") == client.report_currency)
    rows = joins.join_rate(rows, wanted, {"app_processing_date": "rate_date", "__code": "from_code"}, "rate", "__rate")
    codes = currency.select(C("currency_numeric_code").cast("bigint").alias("num"), "currency_alphabetic_code")
    rows = lookup_join(rows, codes, {"__code": "num"}, {"currency_alphabetic_code": "__alpha"})
    settled = classify.local_or_foreign(C("__alpha"), F.lit(client.report_currency))
    rows = rows.withColumn("settlement_currency", F.when(C("data_source") == "Settlement Data", settled).otherwise(C("settlement_currency")))
    return rows.groupBy(*MESSAGE_DIMS).agg(
        F.sum("__count").cast("decimal(38,6)").alias("trx_count"), _converted("__rate", "__amount").cast("decimal(38,6)").alias("trx_amt"),
        _converted("__rate", "__fee").cast("decimal(38,6)").alias("itx_amt"),
    )
