"""Reference masters: rates, account ranges of both schemes, fee rules."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clearspan.functions import dates, text
from clearspan.operators import aggregates, filters, joins, versions
from clearspan.operators.lookup import lookup_join
from clearspan.sources import sinks

C = F.col

# Text range line, field -> (first position from 1, length).
TEXT_RANGE_LAYOUT = {
    "table_type": (1, 2), "table_mnemonic": (3, 8), "record_type": (11, 1), "table_key": (12, 12), "effective_date": (24, 8),
    "delete_indicator": (32, 1), "low_key_for_range": (33, 12), "issuer_identifier": (45, 6), "check_digit_algorithm": (51, 1),
    "account_number_length": (52, 2), "token_indicator": (54, 1), "clearing_only_indicator": (55, 1), "base_ii_cib": (56, 6),
    "domain": (62, 1), "region": (63, 1), "country": (64, 2), "large_ticket": (66, 1), "technology_indicator": (67, 1),
    "ardef_region": (68, 1), "ardef_country": (69, 2), "commercial_card_level_2_data_indicator": (71, 1),
    "commercial_card_level_3_enhanced_data_indicator": (72, 1), "commercial_card_pos_prompting_indicator": (73, 1),
    "commercial_card_electronic_vat_evidence_indicator": (74, 1), "original_credit": (75, 1),
    "account_level_processing_indicator": (76, 1), "original_credit_money_transfer": (77, 1),
    "original_credit_online_gambling": (78, 1), "product_id": (79, 2), "combo_card": (81, 1), "fast_funds": (82, 1),
    "travel_indicator": (83, 1), "b2b_program_id": (84, 2), "program_indicator": (86, 1), "rr12": (87, 2),
    "multi_account_access_indicator": (89, 1), "account_funding_source": (90, 1), "settlement_match": (91, 1),
    "travel_account_data": (92, 1), "account_restricted_use": (93, 1), "nnss_indicator": (94, 1), "product_subtype": (95, 2),
    "alternate_atm": (97, 1), "reserved_1": (98, 1), "reserved_2": (99, 2),
}
TEXT_RANGE_NUMBERS = ["table_key", "low_key_for_range"]
RANGE_KEYS = ["table_key", "low_key_for_range", "delete_indicator"]
# Message range record, field -> (first position from 1, length), as far as the jobs read it.
MESSAGE_RANGE_LAYOUT = {
    "effective_timestamp": (1, 7), "active_inactive_code": (8, 1), "table_id": (9, 3), "low_range": (12, 19), "gcms_product": (31, 3),
    "high_range": (34, 19), "card_program_identifier": (53, 3), "card_program_priority": (56, 2), "member_id": (58, 11),
    "product_type": (69, 1), "endpoint": (70, 7), "card_country_alpha": (77, 3), "card_country_numeric": (80, 3), "region": (83, 1),
    "product_class": (84, 3), "licensed_product_id": (91, 3),
}
MESSAGE_RANGE_TABLE = "IP0040T1"
# Required and numeric columns of rule sheets, and the columns that identify a rule.
TEXT_RULES_REQUIRED = [
    "JURISDICTION", "GUIDE_DATE", "VALID_FROM", "FEE_PROGRAM", "RULE_ID", "FPI", "FEE_DESCRIPTOR", "FEE_DESCRIPTION", "COD_HIERARCHY",
]
TEXT_RULES_NUMBERS = ["FEE_FIXED", "FEE_MIN", "FEE_CAP", "FEE_VARIABLE"]
MESSAGE_RULES_REQUIRED = ["JURISDICTION", "GUIDE_DATE", "VALID_FROM", "RULE_ID", "IRD"]
MESSAGE_RULES_NUMBERS = ["RATE_FIXED", "RATE_MIN", "RATE_CAP"]
MESSAGE_RULES_ACTIVE_NUMBERS = ["RATE_VARIABLE"]
RULE_KEYS = ["jurisdiction", "guide_date", "valid_from", "rule_id"]
RULE_DATES = ["guide_date", "valid_from", "valid_until"]
MISSING_TIER = "S/I"


def enriched_rates(rates: DataFrame, currency: DataFrame) -> DataFrame:
    return joins.codes_of_pair(rates, currency)


def _sliced(lines: DataFrame, line: str, layout: dict[str, tuple[int, int]]) -> DataFrame:
    rows = [{"source": line, "name": n, "position": p, "length": w} for n, (p, w) in layout.items()]
    return lines.select("*", *text.fixed_fields(rows))


def text_range_delivery(lines: DataFrame) -> DataFrame:
    """Typed range rows of delivered files (``file_id``, ``line_no``, ``line``) with each file's newest header."""
    trimmed = lines.withColumn("lines", F.rtrim("line"))
    is_header = (F.substring("lines", 1, 8) == "AAACTRNG") & (F.substring("lines", 11, 7) == "AEPACRN")
    headers = trimmed.where(is_header).select(
        "file_id", F.substring("lines", 64, 4).alias("ardef_version"), F.try_to_date(F.substring("lines", 24, 8), "yyyyMMdd").alias("ardef_header_date")
    )
    newest = aggregates.latest_header(headers, ["file_id"], "ardef_version", ["ardef_header_date"])
    ranges = trimmed.where((F.substring("lines", 1, 2) == "VL") & ~C("lines").contains("C****"))
    sliced = _sliced(ranges, "lines", TEXT_RANGE_LAYOUT)
    typed = {n: F.trim(n).try_cast("bigint") for n in TEXT_RANGE_NUMBERS}
    typed |= {n: F.trim(n) for n in TEXT_RANGE_LAYOUT if n not in TEXT_RANGE_NUMBERS and n not in ("effective_date", "delete_indicator")}
    typed["effective_date"] = dates.parse_any(C("effective_date"), "yyyyMMdd", "yyyy-MM-dd", "ddMMyyyy")
    rows = lookup_join(sliced.withColumns(typed), newest, ["file_id"], ["ardef_version", "ardef_header_date"])
    return rows.select("file_id", "ardef_version", "ardef_header_date", "lines", *TEXT_RANGE_LAYOUT)


def merged_text_ranges(master: DataFrame, lines: DataFrame) -> DataFrame:
    """Range master after a delivery."""
    return versions.merge_versions(master, text_range_delivery(lines), RANGE_KEYS, "effective_date", "valid_until", "lines")


def message_range_master(details: DataFrame, catalog: DataFrame, table_id: str = MESSAGE_RANGE_TABLE) -> DataFrame:
    """Versioned ranges of one sub-table: ``app_date_valid`` to ``app_date_end`` per range start and product."""
    rows = joins.subtable_records(details, catalog, table_id)
    rows = _sliced(rows, "record_raw", MESSAGE_RANGE_LAYOUT)
    rows = rows.withColumns({n: F.nullif(F.trim(n), F.lit("")) for n in MESSAGE_RANGE_LAYOUT})
    rows = rows.withColumn("started", dates.parse_day_hour(C("effective_timestamp")))
    keys = ["low_range", "gcms_product", "effective_timestamp", "record_raw"]
    rows = aggregates.distinct_by(rows, keys, [C("file_id").desc(), C("record_sequence").desc()])
    closed = versions.close_versions(rows, ["low_range", "gcms_product"], "started", "ended")
    return closed.withColumns({"app_date_valid": dates.timestamp_text(C("started")), "app_date_end": dates.timestamp_text(C("ended"))}).drop("started", "ended")


def text_rules(sheet: DataFrame) -> DataFrame:
    """Validated rules of text records; raises on absent or null required cells and on bad numbers."""
    renamed = sheet.withColumnsRenamed({"DYNAMIC_CURRENCY_INDICATOR": "DYNAMIC_CURRENCY_CONVERSION_INDICATOR"})
    filters.require(renamed, TEXT_RULES_REQUIRED, TEXT_RULES_NUMBERS)
    typed = {c: C(c).try_cast("decimal(18,8)") for c in TEXT_RULES_NUMBERS if c in renamed.columns}
    rows = renamed.withColumns(typed)
    rows = rows.toDF(*[c.lower() for c in rows.columns])
    return rows.withColumn("transaction_code", text.expand_code_family(C("transaction_code"))) if "transaction_code" in rows.columns else rows


def message_rules(sheet: DataFrame, today: Column) -> DataFrame:
    """Validated rules of messages; the variable rate must parse only for rules still in force."""
    until = C("VALID_UNTIL").try_cast("date")
    filters.require(sheet, MESSAGE_RULES_REQUIRED, MESSAGE_RULES_NUMBERS)
    filters.require(sheet, [], MESSAGE_RULES_ACTIVE_NUMBERS, until.isNull() | (until >= today))
    rows = sheet.withColumns({c: C(c).try_cast("decimal(18,8)") for c in MESSAGE_RULES_NUMBERS})
    rows = rows.toDF(*[c.lower() for c in rows.columns])
    category = F.trim(F.coalesce("category", F.lit("")))
    label = F.when(C("payment_product").isNull(), category).otherwise(F.concat(category, F.lit(" "), C("payment_product")))
    return rows.withColumns({"fee_category": label, "fee_tier": F.coalesce("fee_tier", F.lit(MISSING_TIER))}).drop("category", "payment_product")


def refresh_rules(new: DataFrame, root: str, stamp: str) -> DataFrame | None:
    """Publish validated rules as a new version and return the difference to the replaced ones.

    A table far smaller than the current one is refused and nothing changes.
    """
    spark = new.sparkSession
    path = sinks.current_version(spark, root)
    diff = None
    if path:
        current = spark.read.parquet(path)
        aggregates.check_row_ratio(new.count(), current.count())
        diff = aggregates.table_diff(new, current, RULE_KEYS, RULE_DATES)
        sinks.write_small_report(diff, f"{root}/diffs/{stamp}")
        diff = spark.read.parquet(f"{root}/diffs/{stamp}")
    sinks.publish_version(new, root, stamp)
    return diff
