"""Calculated fields of messages: range, jurisdiction, settlement amount, exclusion."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clearspan.functions import classify, dates, numbers, text
from clearspan.operators import joins, ranges
from clearspan.operators.columns import optional
from clearspan.operators.lookup import lookup_join
from clearspan.plans.visa_calculate import Client, _listed

C = F.col
KEYS = ["file_id", "file_idn", "ref_id"]
# Ranges have 18 digits; an account's first nine digits stand for an interval as wide as 10^9.
LEVELS = tuple(range(9, 19))
OUTPUT = [
    "file_id", "ref_id", "file_idn", "client_id", "file_dt", "type_mti", "business_mode", "jurisdiction",
    "jurisdiction_country", "jurisdiction_region", "funding_source", "gcms_product_identifier", "card_program_identifier",
    "jurisdiction_assigned", "settlement_report_currency_code", "settlement_report_amount", "iar_country", "exclude_flag",
    "content_hash",
]


def active_ranges(master: DataFrame, products: DataFrame) -> DataFrame:
    """Active range versions with product category, and the day each is superseded."""
    typed = master.where(F.trim("active_inactive_code") == "A").select(
        F.substring(F.trim(C("low_range").cast("string")), 1, 18).try_cast("bigint").alias("range_low"),
        F.substring(F.trim(C("high_range").cast("string")), 1, 18).try_cast("bigint").alias("range_high"),
        C("app_date_valid").cast("string").try_cast("timestamp").cast("date").alias("range_from"),
        C("card_program_priority").try_cast("int").alias("range_priority"),
        C("card_country_alpha").alias("range_country"), C("licensed_product_id").alias("range_licensed"),
        C("card_program_identifier").alias("range_program"),
    ).where("range_low IS NOT NULL AND range_high IS NOT NULL AND range_from IS NOT NULL")
    listed = products.where(F.trim("active_inactive_code") == "A")
    rows = lookup_join(typed, listed, {"range_licensed": "licensed_product_id"}, {"gcms_product_id": "range_product", "product_category": "range_funding"})
    best = [C("range_priority").asc_nulls_last(), C("range_high").desc(), C("range_licensed"), C("range_product")]
    return ranges.version_intervals(rows, "range_low", "range_from", best)


def settlement_rates(rows: DataFrame, currency: DataFrame, rates: DataFrame, client: Client) -> DataFrame:
    """Rates from the transaction's currency to the client's settlement and local currency; same currency is 1.

    ``rates`` has ``rate_date``, ``from_code`` (numeric), ``to_ccy`` and ``rate``.
    """
    codes = currency.select(C("currency_numeric_code").cast("bigint").alias("num"), F.upper("currency_alphabetic_code").alias("alpha"))
    rows = lookup_join(rows, codes, {"currency_code_transaction_de_49": "num"}, {"alpha": "transaction_ccy"})
    for name, target in (("settlement_rate", client.settlement_currency), ("local_rate", client.local_currency)):
        wanted = rates.where(F.upper("to_ccy") == target.upper())
        rows = joins.join_rate(rows, wanted, {"proc_date": "rate_date", "currency_code_transaction_de_49": "from_code"}, "rate", name)
        one = F.lit(1).cast(numbers.RATE)
        rows = rows.withColumn(name, F.when(C("transaction_ccy") == target.upper(), one).otherwise(C(name).cast(numbers.RATE)))
    return rows


def message_fields(
    messages: DataFrame, active: DataFrame, country: DataFrame, region: DataFrame, currency: DataFrame, rates: DataFrame,
    cited: DataFrame, client: Client,
) -> DataFrame:
    """Calculated columns of messages of all files; ``cited`` lists excluded (file_idn, message number)."""
    get = lambda name: optional(messages, name)
    rows = messages.withColumns({
        "proc_date": dates.parse_file_date(C("file_dt")),
        "pan9": F.nullif(text.leading_digits(C("pan_de_2").cast("string"), 9), F.lit("")).try_cast("bigint"),
        "currency_code_transaction_de_49": C("currency_code_transaction_de_49").cast("bigint"),
    })
    wide = F.lit(10**9).cast("bigint")
    rows = ranges.best_range(
        rows, active, ["pan9", "proc_date"], C("pan9") * wide, "range_low", "range_high",
        [C("range_from").desc(), C("range_high").desc(), C("range_low")],
        {"range_country": "iar_country", "range_funding": "funding_source", "range_product": "gcms_product_identifier", "range_program": "card_program_identifier"},
        point_end=C("pan9") * wide + F.lit(10**9 - 1).cast("bigint"), also=ranges.valid_version("range_from", "proc_date"), levels=LEVELS,
    )
    dim = country.select("country_code_alternative", "country_code", "mastercard_region_code")
    rows = lookup_join(rows, dim, {"card_acceptor_country_code_de_43_6": "country_code_alternative"}, {"mastercard_region_code": "merchant_region"})
    rows = lookup_join(rows, dim, {"iar_country": "country_code_alternative"}, {"mastercard_region_code": "issuer_region", "country_code": "jurisdiction_country"})
    rows = lookup_join(rows, region, {"issuer_region": "region_code"}, {"region_code": "jurisdiction_region"})

    incoming = C("file_type") == "IN"
    same = C("card_acceptor_country_code_de_43_6") == C("iar_country")
    collection = F.upper(F.coalesce(get("settlement_indicator_1_pds_165_1").cast("string"), F.lit(""))) == "C"
    acquirer = _listed(F.substring(get("acquirer_reference_data_de_31").cast("string"), 2, 6), client.acquiring_bins)
    pan = C("pan9").cast("string")
    cards = _listed(F.substring(pan, 1, 6), client.issuing_bins_6) | _listed(F.substring(pan, 1, 8), client.issuing_bins_8)
    own = F.when(incoming, collection | acquirer).when(C("file_type") == "OUT", collection | cards).otherwise(F.lit(False))
    kind = classify.jurisdiction(same, own, C("issuer_region"), C("merchant_region"), F.lit(None).cast("string"))
    rows = rows.withColumns({"jurisdiction": kind, "business_mode": classify.business_mode_of_direction(C("file_type"))})

    rows = settlement_rates(rows, currency, rates, client)
    codes = currency.select(C("currency_numeric_code").cast("bigint").alias("num"), "currency_alphabetic_code")
    rows = rows.withColumn("__rec", get("currency_code_reconciliation_de_50").cast("bigint"))
    rows = lookup_join(rows, codes, {"__rec": "num"}, {"currency_alphabetic_code": "reconciled_ccy"})
    local = C("jurisdiction").isin("on-us", "off-us") & (C("transaction_ccy") == client.local_currency.upper())
    use_local = F.coalesce(local, F.lit(False))
    known = C("type_mti").cast("string").isin("1240", "1442")
    rows = rows.withColumns({
        "settlement_report_currency_code": F.when(known, numbers.settlement_currency(
            incoming, C("reconciled_ccy"), use_local, F.lit(client.local_currency), F.lit(client.settlement_currency))),
        "settlement_report_amount": F.when(known, numbers.settlement_amount(
            incoming, get("amount_reconciliation_de_5"), C("amount_transaction_de_4"), use_local, C("local_rate"), C("settlement_rate"))),
        "jurisdiction_assigned": classify.jurisdiction_assigned_of(C("jurisdiction"), C("jurisdiction_country").cast("string"), C("jurisdiction_region").cast("string")),
        "client_id": F.lit(client.code),
        "__msg": get("message_number_de_71").cast("string"),
    })
    rows = joins.flag_listed(rows, cited, {"file_idn": "cited_file_idn", "__msg": "cited_message"}, "exclude_flag")
    if "content_hash" not in rows.columns:
        rows = rows.withColumn("content_hash", F.lit(None).cast("string"))
    return rows.select(*OUTPUT)
