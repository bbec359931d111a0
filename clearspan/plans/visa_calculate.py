"""Calculated fields of text clearing records: drafts, single messages, settlement summaries."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clearspan.functions import classify, dates, numbers, text
from clearspan.operators import joins, ranges
from clearspan.operators.columns import optional
from clearspan.operators.lookup import lookup_join

C = F.col


@dataclass
class Client:
    """Configuration of one client."""

    code: str = ""
    local_currency: str = ""
    settlement_currency: str = ""
    report_currency: str = "USD"
    country: str = ""
    issuing_bins_6: list[str] = field(default_factory=list)
    issuing_bins_8: list[str] = field(default_factory=list)
    acquiring_bins: list[str] = field(default_factory=list)
    duplicate_on_us: bool = False


# Range columns copied to the output, under their output names.
RANGE_COLUMNS = {
    "ardef_country": "ardef_country",
    "b2b_program_id": "b2b_program_id",
    "fast_funds": "fast_funds",
    "account_funding_source": "funding_source",
    "country": "issuer_country",
    "nnss_indicator": "nnss_indicator",
    "product_id": "product_id",
    "product_subtype": "product_subtype",
    "technology_indicator": "technology_indicator",
    "travel_indicator": "travel_indicator",
}
DRAFT_OUTPUT = [
    "content_hash", "record", "ardef_country", "authorization_code_valid", "b2b_program_id", "business_application_id",
    "business_format_code", "business_mode", "business_transaction_type", "business_transaction_cycle", "fast_funds",
    "funding_source", "issuer_bin_8", "issuer_country", "issuer_region", "jurisdiction", "jurisdiction_assigned",
    "jurisdiction_country", "jurisdiction_region", "message_reason_code", "network_identification_code", "nnss_indicator",
    "product_id", "product_subtype", "reversal_indicator", "settlement_report_currency_code",
    "source_currency_code_alphabetic", "surcharge_amount", "technology_indicator", "timeliness", "token_requestor_id",
    "travel_indicator", "type_of_purchase",
]
MESSAGE_OUTPUT = [
    "content_hash", "record", "acquirer_bin", "ardef_country", "authorization_code_valid", "b2b_program_id", "business_mode",
    "business_transaction_type", "business_transaction_cycle", "fast_funds", "funding_source", "issuer_bin_8",
    "issuer_country", "issuer_region", "jurisdiction", "jurisdiction_assigned", "jurisdiction_country",
    "jurisdiction_region", "nnss_indicator", "processing_code_transaction_type", "product_id", "product_subtype",
    "reversal_indicator", "source_amount", "source_currency_code_alphabetic", "technology_indicator", "timeliness",
    "transaction_code_sms", "travel_indicator",
]


def active_ranges(ranges_table: DataFrame) -> DataFrame:
    """Range versions that are not deleted, typed, with the day each is superseded."""
    typed = ranges_table.where(C("delete_indicator") == " ").select(
        C("low_key_for_range").cast("bigint").alias("range_low"),
        C("table_key").cast("bigint").alias("range_high"),
        F.try_to_date(C("effective_date").cast("string"), "yyyyMMdd").alias("range_from"),
        optional(ranges_table, "valid_until").cast("string").try_cast("date").alias("range_until"),
        *[optional(ranges_table, c).cast("string").alias(f"range_{c}") for c in RANGE_COLUMNS],
    )
    return ranges.version_intervals(typed, "range_low", "range_from", [C("range_high").desc(), C("range_country")])


def attach_range(rows: DataFrame, active: DataFrame, account: str, day: str) -> DataFrame:
    """Columns of the account's best range on the file's day: newest, then widest."""
    holds = ranges.valid_version("range_from", day) & (C("range_until").isNull() | (C("range_until") >= C(day)))
    clean = rows.drop(*[c for c in RANGE_COLUMNS.values() if c in rows.columns])
    return ranges.best_range(
        clean, active, [account, day], text.account9(C(account)), "range_low", "range_high",
        [C("range_from").desc(), C("range_high").desc(), C("range_low")],
        {f"range_{c}": name for c, name in RANGE_COLUMNS.items()}, also=holds,
    )


def _regions(rows: DataFrame, country: DataFrame, merchant: str) -> DataFrame:
    dim = country.select("country_code", "visa_region_code")
    for key, name in (("issuer_country", "issuer_region"), (merchant, "jurisdiction_region"), ("ardef_country", "ardef_region")):
        rows = lookup_join(rows, dim, {key: "country_code"}, {"visa_region_code": name})
    return rows


def _listed(c: Column, values: list[str]) -> Column:
    return F.coalesce(c.isin(values), F.lit(False)) if values else F.lit(False)


def _own_cards(account: str, client: Client) -> Column:
    return _listed(text.prefix(C(account), 6), client.issuing_bins_6) | _listed(text.prefix(C(account), 8), client.issuing_bins_8)


def draft_fields(drafts: DataFrame, active: DataFrame, country: DataFrame, currency: DataFrame, client: Client) -> DataFrame:
    """Calculated columns of drafts; ``file_type`` and ``file_date`` come with the rows."""
    get = lambda name: optional(drafts, name)
    rows = attach_range(drafts, active, "account_number", "file_date")
    rows = _regions(rows, country, "merchant_country_code")
    rows = lookup_join(rows, currency, {"source_currency_code": "currency_numeric_code"}, {"currency_alphabetic_code": "source_currency_code_alphabetic"})
    incoming = C("file_type") == "IN"
    same = C("merchant_country_code") == C("ardef_country")
    collection = F.coalesce(get("collection_only_flag") == "C", F.lit(False))
    acquirer = _listed(F.lpad(get("account_reference_number_acquiring_identifier").cast("string"), 6, "0"), client.acquiring_bins)
    own = collection | F.when(incoming, acquirer).otherwise(_own_cards("account_number", client))

    def variants(name: str, *suffixes: str) -> Column:
        return text.first_non_blank(*[get(f"{name}_{s}").cast("string") for s in suffixes])

    rows = rows.withColumns({
        "issuer_bin_8": text.prefix(C("account_number"), 8),
        "authorization_code_valid": text.code_validity(get("authorization_code").cast("string")),
        "business_application_id": variants("business_application_id", "fl", "cr", "ft"),
        "business_format_code": variants("business_format_code", "cr", "fl", "ft", "df", "pd", "sd", "sp"),
        "message_reason_code": variants("message_reason_code", "df", "sd", "sp"),
        "network_identification_code": variants("network_identification_code", "df", "sd", "sp"),
        "type_of_purchase": variants("type_of_purchase", "fl", "ft"),
        "surcharge_amount": numbers.largest(*[get(f"surcharge_amount_{s}").cast("decimal(18,4)") for s in ("df", "sd", "sp")]).cast("decimal(18,4)"),
        "token_requestor_id": classify.token_requestor(get("token_requestor_id_sd").cast("bigint"), get("token_requestor_id_sp").cast("bigint")),
        "business_mode": classify.business_mode(C("draft_code"), incoming),
        "business_transaction_type": classify.transaction_type(
            C("draft_code"), get("merchant_category_code").cast("int"), get("usage_code").cast("int"),
            get("special_condition_indicator_merchant_draft_indicator").cast("string"), get("draft_code_qualifier_0").cast("int"), incoming,
        ),
        "business_transaction_cycle": classify.transaction_cycle(C("draft_code"), get("usage_code").cast("int")),
        "reversal_indicator": classify.reversal_of_code(C("draft_code")),
        "jurisdiction_country": C("merchant_country_code"),
        "jurisdiction": classify.jurisdiction(same, own, C("jurisdiction_region"), C("ardef_region")),
        "jurisdiction_assigned": classify.jurisdiction_assigned(
            C("merchant_country_code"), C("ardef_country"), C("jurisdiction_region"), C("ardef_region")
        ),
        "timeliness": dates.timeliness(F.to_date("purchase_date"), F.to_date("central_processing_date")),
    })
    rows = rows.withColumn(
        "settlement_report_currency_code",
        classify.settlement_report_currency(
            C("jurisdiction"), get("settlement_flag").cast("int"), F.lit(client.local_currency), F.lit(client.settlement_currency)
        ),
    )
    return rows.select(*DRAFT_OUTPUT)


def message_fields(messages: DataFrame, active: DataFrame, country: DataFrame, currency: DataFrame, client: Client) -> DataFrame:
    """Calculated columns of single messages."""
    get = lambda name: optional(messages, name)
    rows = attach_range(messages, active, "card_number", "file_date")
    rows = _regions(rows, country, "card_acceptor_country")
    rows = lookup_join(rows, currency, {"draft_currency_code": "currency_numeric_code"}, {"currency_alphabetic_code": "source_currency_code_alphabetic"})
    # The merchant's country counts only when the country table knows it.
    merchant = F.when(C("jurisdiction_region").isNotNull(), C("card_acceptor_country"))
    same = merchant == C("ardef_country")
    side = C("issuer_acquirer_indicator")
    acquirer = _listed(F.lpad(get("acquiring_institution_id_1").cast("string"), 6, "0"), client.acquiring_bins)
    own = ((side == "A") & _own_cards("card_number", client)) | ((side == "I") & acquirer)
    request, response = C("request_message_type"), C("response_code")
    rows = rows.withColumns({
        "acquirer_bin": F.substring(get("retrieval_reference_number").cast("string"), 1, 6),
        "issuer_bin_8": text.prefix(C("card_number"), 8),
        "authorization_code_valid": text.code_validity(get("authorization_id_resp_code").cast("string")),
        "processing_code_transaction_type": F.substring("processing_code", 1, 2),
        "source_amount": C("draft_amount"),
        "business_mode": classify.business_mode_of_indicator(side),
        "business_transaction_type": classify.transaction_type_of_message(
            request, response, C("processing_code"), get("pos_condition_code").cast("string"), get("merchant's_type").cast("int")
        ),
        "business_transaction_cycle": F.lit(None).cast("int"),
        "reversal_indicator": classify.reversal_of_message(request, response),
        "jurisdiction_country": C("card_acceptor_country"),
        "jurisdiction": classify.jurisdiction(same, F.coalesce(own, F.lit(False)), C("jurisdiction_region"), C("ardef_region")),
        "jurisdiction_assigned": classify.jurisdiction_assigned(merchant, C("ardef_country"), C("jurisdiction_region"), C("ardef_region")),
        "timeliness": dates.plain_timeliness(F.to_date("local_draft_date"), F.to_date("settlement_date_sms")),
    })
    rows = rows.withColumn("transaction_code_sms", classify.code_of_type(C("business_transaction_type"), C("reversal_indicator")))
    return rows.select(*MESSAGE_OUTPUT)


def summary_fields(summaries: DataFrame, report_type: str) -> DataFrame:
    """Report type and hierarchy level of settlement summaries."""
    leveled = joins.flag_hierarchy(
        summaries, f"rollup_to_sre_identifier_{report_type}", f"reporting_for_sre_identifier_{report_type}", "vss_aggregation_level"
    )
    return leveled.select("content_hash", "record", F.lit(int(report_type)).cast("bigint").alias("vss_report_type"), "vss_aggregation_level")
