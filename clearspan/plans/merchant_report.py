"""Monthly merchant report of message transactions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clearspan.functions import classify, dates, numbers, text
from clearspan.operators import aggregates, filters, joins
from clearspan.operators.columns import first_existing, optional
from clearspan.operators.lookup import lookup_join

C = F.col
# Dimensions of the monthly table and which template column each one meets.
TRANSACTION_DIMS = [
    "MCT_CD", "FND_SRC_ID", "ARG_CTRY_ID", "PRD_ID", "TXN_SCP_ID", "TXN_TYP_ID", "TXN_CYC_ID", "TXN_RVSL_FLG_ID",
    "TXN_CRNCY_LCL_FLG_ID", "TXN_CRD_PRS_FLG_ID", "TXN_ACS_FEE_FLG_ID", "SUB_SCH_ID", "SCH_ID", "RG_MCT_AMT_ID",
]
TEMPLATE_DIMS = {
    "SUB_SCH_ID": "t_SUB_SCH_ID", "TXN_SCP_ID": "t_TXN_SCP_ID", "FND_SRC_ID": "t_FND_SRC_ID", "TXN_TYP_ID": "t_TXN_TYP_ID",
    "TXN_RVSL_FLG_ID": "t_TXN_RVSL_FLG_ID", "TXN_CRNCY_LCL_FLG_ID": "t_TXN_CRNCY_LCL_FLG_ID", "SCH_FEE_REG_ID": "t_SCH_FEE_REG_ID",
    "PRG_ID": "t_TXN_PRG_ID", "TXN_ACS_FEE_FLG_ID": "t_TXN_ACS_FEE_FLG_ID", "TXN_CRD_PRS_FLG_ID": "t_TXN_CRD_PRS_FLG_ID",
    "RG_MCT_AMT_ID": "t_RG_MCT_AMT_ID",
}
REPORT_DIMS = ["SET_MTH", "SUB_SCH_ID", "TXN_CRD_PRS_FLG_ID", "PRG_ID", "FND_SRC_ID", "TXN_SCP_ID", "ARG_CTRY_ID"]
MEASURES = ["TXN_CNT", "TXN_AMT", "TXN_IRF"]
FEE_AMOUNTS = [f"{f}_AMT" for f in aggregates.FEE_FAMILIES]
ALL_AMOUNTS = [*MEASURES, *FEE_AMOUNTS, "TOT_PLUS_1_AMT", "TOT_AMT"]
PRINTED = [
    "TXN_CRD_PRS_FLG_ID", "SUB_SCH_LDSC", "SCH_FEE_CAT_CD", "SCH_FEE_CAT_DSC", "TXN_AMT", "TXN_CNT", "TXN_IRF", "TXN_PERC_IRF",
    "QRT_AMT", "QRT_FEE", "FND_AMT", "FND_FEE", "AUTH_AMT", "AUTH_FEE", "CLR_AMT", "CLR_FEE", "CRSB_AMT", "CRSB_FEE", "OTH_AMT",
    "OTH_FEE", "TOT_PLUS_1_AMT", "TOT_PLUS_1_FEE", "TOT_AMT", "TOT_FEE",
]
REPORTED_TYPES = [1, 8]
SERVICE_COLUMNS = ["biz_svc_typ_id", "business_service_type_id", "business_service_id", "business_service_type", "biz_service_type_id"]


def transactions(messages: DataFrame, products: DataFrame, types: DataFrame, country: DataFrame, buckets: DataFrame) -> DataFrame:
    """Reportable transactions with all report dimensions.

    ``country`` has ``country_id``, ``numeric``, ``alpha2`` and ``alpha3``; ``buckets`` has ``id``, ``low`` and ``high``.
    """
    names = lambda *n, default=None: first_existing(messages, n, default)
    product = names("gcms_product_identifier", "licensed_product_identifier_pds_3", "gcms_product_identifier_pds_2", "card_program_identifier")
    indicator = F.trim(optional(messages, "settlement_indicator_1_pds_165_1").cast("string"))
    has_service = any(c in messages.columns for c in SERVICE_COLUMNS)
    service = names(*SERVICE_COLUMNS).cast("string").try_cast("int")
    excluded = optional(messages, "exclude_flag", 0).cast("int")
    rows = messages.withColumns({"__product": F.upper(F.trim(product.cast("string"))), "__service": service, "__indicator": indicator})
    rows = rows.where(filters.clearing_population(C("__indicator"), excluded, C("__product"), C("__service") if has_service else None))
    dim = products.groupBy(F.upper(F.trim("product_code")).alias("code")).agg(
        F.min("legacy_product_id").alias("l"), F.min("rng_fnd_id").alias("f"), F.min("range_program_id").alias("p")
    )
    rows = lookup_join(rows, dim, {"__product": "code"}, {"l": "PRD_ID", "f": "FND_SRC_ID", "p": "PRG_ID"})
    rows = rows.withColumn("__type", F.lpad(F.trim(optional(messages, "cardholder_transaction_type_de_3_1").cast("string")), 2, "0"))
    labels = types.groupBy(F.lpad(F.trim("business_transaction_type_id"), 2, "0").alias("code")).agg(F.min("transaction_type_id").alias("label"))
    rows = lookup_join(rows, labels, {"__type": "code"}, {"label": "__label"})
    place = names("jurisdiction_country", "iar_country", "region_country_code", "card_acceptor_country_code_de_43_6")
    area = country.withColumn("in_area", F.upper("alpha2").isin(classify.ECONOMIC_AREA).cast("int"))
    rows = joins.join_any_key(rows, area, place, ["country_id", "numeric", "alpha2", "alpha3"], {"country_id": "ARG_CTRY_ID", "in_area": "__area"}, [C("country_id")])
    local = F.trim(names("currency_code_transaction_de_49", "currency_code_reconciliation_de_50").cast("string")) == F.trim(
        names("settlement_report_currency_id", "settlement_report_currency_code", "currency_code_reconciliation_de_50").cast("string"))
    present = F.trim(optional(messages, "card_present_data_de_22_6").cast("string")) != "0"
    reversal = F.substring(F.trim(F.coalesce(optional(messages, "message_reversal_indicator_pds_25").cast("string"), F.lit(" "))), 1, 1) == "R"
    program = F.trim(names("card_program_identifier", "licensed_product_identifier_pds_3").cast("string"))
    zero = F.lit(0).cast("decimal(28,6)")
    rows = rows.withColumns({
        "SET_DT": F.to_date(names("date", "file_dt", "file_processing_date")),
        "MCT_CD": F.lpad(F.trim(optional(messages, "card_acceptor_id_code_de_42").cast("string")), 11, "0"),
        "TXN_SCP_ID": classify.report_scope(C("__service"), C("__indicator"), F.lower(F.trim(optional(messages, "jurisdiction", "").cast("string"))), C("ARG_CTRY_ID"), C("__area")),
        "TXN_TYP_ID": classify.type_id_of_label(C("__label"), C("__type")), "TXN_CYC_ID": F.lit(255), "TXN_RVSL_FLG_ID": F.when(reversal, 1).otherwise(0),
        "TXN_CRNCY_LCL_FLG_ID": F.when(local, 1).otherwise(0), "TXN_CRD_PRS_FLG_ID": F.when(present, 1).otherwise(0), "TXN_ACS_FEE_FLG_ID": F.lit(0),
        "SUB_SCH_ID": F.when(program.isin("MSI", "CIR"), 2).otherwise(1), "SCH_ID": F.lit(1), "TXN_CNT": F.lit(1).cast("bigint"),
        "TXN_AMT": F.coalesce(numbers.plain_decimal(names("settlement_report_amount", "amount_reconciliation_de_5", "amount_transaction", default="0")), zero),
        "TXN_IRF": F.coalesce(numbers.plain_decimal(names("amounts_transaction_fee_7_pds_146_7", "calculated_value", default="0")), zero),
        "ARG_CTRY_ID": F.coalesce("ARG_CTRY_ID", F.lit(255)),
    })
    rows = joins.join_bucket(rows, buckets, {}, C("TXN_AMT"), "low", "high", "id", "RG_MCT_AMT_ID", 255, half_open=False)
    return rows.select("SET_DT", *TRANSACTION_DIMS, "PRG_ID", *MEASURES)


def monthly(rows: DataFrame) -> DataFrame:
    """Month totals: transaction grain first, then with program instead of product."""
    month = dates.month_key(C("SET_DT")).cast("int")
    base = rows.where(C("TXN_TYP_ID").isin(REPORTED_TYPES)).withColumn("SET_MTH", month).where("SET_MTH IS NOT NULL")
    by_product = aggregates.sums(base, ["SET_MTH", *TRANSACTION_DIMS, "PRG_ID"], MEASURES)
    by_product = by_product.withColumns({"BUS_ID": F.lit(1), "SCH_FEE_REG_ID": F.lit(255), "PRG_ID": F.coalesce("PRG_ID", F.lit(0)).cast("int")})
    dims = [d for d in TRANSACTION_DIMS if d != "PRD_ID"]
    return aggregates.sums(by_product, ["SET_MTH", "BUS_ID", "SCH_FEE_REG_ID", "PRG_ID", *dims], MEASURES)


def printed_report(month_totals: DataFrame, template: DataFrame, country: DataFrame, sub_schemes: DataFrame, categories: DataFrame, month: int) -> DataFrame:
    """Detail rows of the printed report of one month."""
    rows = month_totals.where((C("SET_MTH") == month) & (C("TXN_TYP_ID") == 1))
    totals = rows.groupBy(*REPORT_DIMS).agg(*[F.sum(m).alias(m) for m in MEASURES])
    exact = {"BUS_ID": "t_BUS_ID", "SCH_ID": "t_SCH_ID"}
    base = rows.groupBy(*dict.fromkeys([*REPORT_DIMS, *exact, *TEMPLATE_DIMS])).agg(F.sum("TXN_CNT").alias("TXN_CNT"), F.sum("TXN_AMT").alias("TXN_AMT"))
    in_use = template.where((C("t_CTRY_ID") == classify.HOME_COUNTRY_ID) & (C("t_STA") == 1) & (C("t_FEE_DSC") == "Total"))
    fee_columns = [f"{k}_{f}_FEE" for f in aggregates.FEE_FAMILIES for k in ("FIX", "VAR")]
    matched = joins.join_wildcard(base, in_use, TEMPLATE_DIMS, exact, fee_columns)
    fees = aggregates.fee_components(matched, REPORT_DIMS, "TXN_CNT", "TXN_AMT")
    joined = lookup_join(totals, fees, {d: d for d in REPORT_DIMS}, {a: a for a in FEE_AMOUNTS}, null_safe=True)
    joined = joined.withColumns({a: F.coalesce(C(a), F.lit(0).cast("decimal(28,8)")) for a in FEE_AMOUNTS})
    joined = aggregates.fee_totals(joined)
    area = country.groupBy("country_id").agg(F.max(F.upper("alpha2").isin(classify.ECONOMIC_AREA).cast("int")).alias("in_area"))
    joined = lookup_join(joined, area, {"ARG_CTRY_ID": "country_id"}, ["in_area"])
    scope = classify.merchant_report_scope(C("TXN_SCP_ID"), C("ARG_CTRY_ID"), C("in_area"))
    scoped = joined.withColumn("TXN_SCP_ID", scope).groupBy(*[d for d in REPORT_DIMS if d != "ARG_CTRY_ID"]).agg(*[F.sum(a).alias(a) for a in ALL_AMOUNTS])
    labels = sub_schemes.groupBy("SUB_SCH_ID").agg(F.min(F.trim("SUB_SCH_LDSC")).alias("SUB_SCH_LDSC"))
    kinds = categories.groupBy("TXN_PRG_ID", "TXN_FND_SRC_ID", "TXN_SCP_ID").agg(
        F.min(F.lpad(F.trim("SCH_FEE_CAT_CD"), 2, "0")).alias("SCH_FEE_CAT_CD"), F.min(F.trim("SCH_FEE_CAT_DSC")).alias("SCH_FEE_CAT_DSC")
    )
    named = lookup_join(scoped, labels, ["SUB_SCH_ID"], ["SUB_SCH_LDSC"])
    named = lookup_join(named, kinds, {"PRG_ID": "TXN_PRG_ID", "FND_SRC_ID": "TXN_FND_SRC_ID", "TXN_SCP_ID": "TXN_SCP_ID"}, ["SCH_FEE_CAT_CD", "SCH_FEE_CAT_DSC"])
    report = named.groupBy(*PRINTED[:4]).agg(*[F.sum(a).alias(a) for a in ALL_AMOUNTS])
    flag = F.when(C("TXN_CRD_PRS_FLG_ID") == 0, 1).when(C("TXN_CRD_PRS_FLG_ID") == 1, 0)
    return aggregates.fee_ratios(report).withColumn("TXN_CRD_PRS_FLG_ID", flag).select(*PRINTED)
