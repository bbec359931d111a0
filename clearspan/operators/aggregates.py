"""Report aggregations, control totals and table comparison."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clearspan.functions import numbers
from clearspan.functions.text import normalised_cell
from clearspan.operators.filters import InputError

MIN_ROW_RATIO = 0.5
# Dimensions of the fee report, in output order.
FEE_REPORT_DIMS = [
    "report_currency", "app_customer_code", "bank_country", "business_mode_id", "transaction_brand", "size_ticket",
    "product_id", "range_program_id", "account_funding_source", "business_transaction_type_id", "jurisdiction",
    "reversal_indicator", "currency_local_indicator", "motoec_indicator", "account_number", "merchant_country_code",
    "switch_code", "travel_program_indicator", "greece_micropayment_indicator", "key_entered_tpe",
]
COST_COLUMNS = [
    "transaction_scheme_fee_cost", "unitary_scheme_fee_cost", "estimated_scheme_fee_cost",
    "unitary_estimated_scheme_fee_cost",
]
FEE_FAMILIES = ["QRT", "FND", "AUTH", "CLR", "CRSB", "OTH"]


def quality_summary(df: DataFrame, dims: list[str], amount: str, fee: str, rate: str) -> DataFrame:
    """Count and converted sums; a missing rate is 1, a missing amount 0."""
    fx = F.coalesce(F.col(rate).cast("decimal(18,10)"), F.lit(1).cast("decimal(18,10)"))
    zero = F.lit(0).cast("decimal(18,4)")

    def total(c: str) -> Column:
        return F.sum((fx * F.coalesce(F.col(c).cast("decimal(18,4)"), zero)).cast("decimal(28,10)")).cast("decimal(38,10)")

    return df.groupBy(*dims).agg(
        F.count("*").alias("trx_count"), total(amount).alias("trx_amt"), total(fee).alias("itx_amt")
    )


def settlement_summary(df: DataFrame, dims: list[str], count: str, amount: str, credits: str, debits: str, rate: str) -> DataFrame:
    """Sums over pre-summed rows, two decimals; a row without credits or debits adds no fee."""
    fx = F.coalesce(F.col(rate).cast("decimal(18,10)"), F.lit(1).cast("decimal(18,10)"))

    def total(value: Column) -> Column:
        return F.round(F.sum(value), 2).cast("decimal(18,2)")

    fee = F.col(credits).cast("decimal(18,4)") + F.col(debits).cast("decimal(18,4)")
    return df.groupBy(*dims).agg(
        total(F.col(count).cast("decimal(18,0)")).alias("trx_count"),
        total((F.col(amount).cast("decimal(18,4)") * fx).cast("decimal(28,10)")).alias("trx_amt"),
        total((fee.cast("decimal(18,4)") * fx).cast("decimal(28,10)")).alias("itx_amt"),
    )


def mode_of_member(activity: Column) -> Column:
    return F.when(activity == "A", F.lit("Acquirer")).when(activity == "I", F.lit("Issuer")).otherwise(F.lit("Unknown"))


def jurisdiction_of_activity(indicator: Column, activity: Column) -> Column:
    service = activity.try_cast("int")
    return (
        F.when(indicator == "C", F.lit("on-us"))
        .when(service == 4, F.lit("off-us"))
        .when(service.isin(2, 3), F.lit("intraregional"))
        .when(service.isin(1, 8), F.lit("interregional"))
    )


def directional_totals(df: DataFrame, dims: list[str], incoming: Column, in_cols: tuple, out_cols: tuple) -> DataFrame:
    """Count, amount and fee where the columns read depend on the direction: (amount, fee, rate)."""
    amount, fee, rate = [F.when(incoming, F.col(i)).otherwise(F.col(o)) for i, o in zip(in_cols, out_cols)]
    picked = df.withColumns({"__amount": amount, "__fee": fee, "__rate": rate})
    return quality_summary(picked, dims, "__amount", "__fee", "__rate")


def fee_report(detail: DataFrame, dims: list[str], amount: str, label: str | None = None) -> DataFrame:
    """Count and amount per group; the label shown is the smallest one, so it does not depend on row order."""
    measures = [F.count("*").alias("transaction_count"), F.sum(amount).alias("transaction_amount")]
    if label:
        measures.append(F.min(label).alias(label))
    report = detail.groupBy(*dims).agg(*measures)
    return report.withColumns({c: F.lit(0).cast("decimal(24,6)") for c in COST_COLUMNS})


def distinct_terminals(df: DataFrame, merchant: str, terminal: str, approximate: bool = False) -> DataFrame:
    count = F.approx_count_distinct(terminal) if approximate else F.countDistinct(terminal)
    return df.groupBy(merchant).agg(count.alias("count_terminal"))


def sums(df: DataFrame, dims: list[str], measures: list[str]) -> DataFrame:
    """Sums with nulls as 0."""
    return df.groupBy(*dims).agg(*[F.sum(F.coalesce(F.col(m), F.lit(0))).alias(m) for m in measures])


def fee_components(df: DataFrame, dims: list[str], count: str, amount: str) -> DataFrame:
    """fix * count + var * amount summed per fee family (columns FIX_x_FEE, VAR_x_FEE)."""
    def part(f: str) -> Column:
        zero = F.lit(0).cast("decimal(12,6)")
        fixed = F.coalesce(F.col(f"FIX_{f}_FEE").cast("decimal(12,6)"), zero) * F.col(count).cast("decimal(12,0)")
        variable = F.coalesce(F.col(f"VAR_{f}_FEE").cast("decimal(12,6)"), zero) * F.col(amount).cast("decimal(18,2)")
        return F.sum((fixed + variable).cast("decimal(28,8)")).cast("decimal(28,8)").alias(f"{f}_AMT")

    return df.groupBy(*dims).agg(*[part(f) for f in FEE_FAMILIES])


def fee_totals(df: DataFrame, interchange: str = "TXN_IRF") -> DataFrame:
    families = sum((F.col(f"{f}_AMT") for f in FEE_FAMILIES[1:]), F.col(f"{FEE_FAMILIES[0]}_AMT"))
    return df.withColumn("TOT_PLUS_1_AMT", families.cast("decimal(28,8)")).withColumn(
        "TOT_AMT", (F.col("TOT_PLUS_1_AMT") + F.col(interchange).cast("decimal(26,8)")).cast("decimal(28,8)")
    )


def fee_ratios(df: DataFrame, amount: str = "TXN_AMT", interchange: str = "TXN_IRF", scale: int = 12) -> DataFrame:
    """Fee shares of the amount from two-decimal values; 0 when the amount is 0."""
    two = lambda c: F.round(F.col(c).cast("decimal(28,8)"), 2).cast("decimal(24,2)")
    families = sum((two(f"{f}_AMT") for f in FEE_FAMILIES[1:]), two(f"{FEE_FAMILIES[0]}_AMT")).cast("decimal(24,2)")
    parts = {"TXN_PERC_IRF": two(interchange), **{f"{f}_FEE": two(f"{f}_AMT") for f in FEE_FAMILIES}}
    parts["TOT_PLUS_1_FEE"] = families
    parts["TOT_FEE"] = (families + two(interchange)).cast("decimal(24,2)")
    return df.withColumns({name: numbers.ratio(value, two(amount), scale) for name, value in parts.items()})


def report_totals(detail: DataFrame, amounts: list[str], counts: list[str]) -> DataFrame:
    """Trailer row: sums of the rounded detail values."""
    return detail.agg(
        F.count("*").alias("detail_rows"),
        *[F.sum(F.round(F.col(a).cast("decimal(28,8)"), 2).cast("decimal(24,2)")).alias(a) for a in amounts],
        *[F.sum(c).alias(c) for c in counts],
    )


def table_diff(new: DataFrame, current: DataFrame, keys: list[str], dates: list[str] = ()) -> DataFrame:
    """Rows added, removed, common and changed, and changes per column, in one pass.

    Cells are compared as normalised text. Of rows with equal keys the smallest counts.
    """
    values = [c for c in new.columns if c in current.columns and c not in keys]

    def normalised(df: DataFrame) -> DataFrame:
        cells = {c: normalised_cell(F.col(c), c in dates) for c in [*keys, *values]}
        body = F.struct(*[cells[c].alias(c) for c in values])
        return df.select(*[cells[k].alias(k) for k in keys], body.alias("v")).groupBy(*keys).agg(F.min("v").alias("v"))

    n, c = normalised(new).withColumnRenamed("v", "n"), normalised(current).withColumnRenamed("v", "c")
    joined = n.join(c, keys, "full")
    common = F.col("n").isNotNull() & F.col("c").isNotNull()
    counts = [
        F.count_if(F.col("c").isNull()).alias("added"),
        F.count_if(F.col("n").isNull()).alias("removed"),
        F.count_if(common).alias("common"),
        F.count_if(common & (F.col("n") != F.col("c"))).alias("changed"),
    ]
    per_column = [F.count_if(common & (F.col(f"n.{v}") != F.col(f"c.{v}"))).alias(f"changed_{v}") for v in values]
    return joined.agg(*counts, *per_column)


def check_totals(actual: int, expected: int, what: str) -> None:
    if actual != expected:
        raise InputError(f"{what}: {actual} rows, the run summary says {expected}")


def check_row_ratio(new_rows: int, current_rows: int, least: float = MIN_ROW_RATIO) -> None:
    """Refuse a table far smaller than the one it replaces."""
    if current_rows and new_rows / current_rows < least:
        raise InputError(f"new table has {new_rows} rows, current has {current_rows}")


def control_totals(summary: DataFrame, counts: dict[str, DataFrame]) -> DataFrame:
    """Expected and actual rows per name, as a table (columns of ``summary`` are the names)."""
    parts = None
    for name, df in counts.items():
        one = df.agg(F.count("*").alias("actual")).withColumn("total", F.lit(name))
        parts = one if parts is None else parts.unionByName(one)
    expected = summary.select(F.explode(F.map_from_arrays(
        F.array(*[F.lit(n) for n in counts]), F.array(*[F.col(n).cast("bigint") for n in counts])
    )).alias("total", "expected"))
    return parts.join(F.broadcast(expected), "total").withColumn("agrees", F.col("actual") == F.col("expected"))


def missing_dates(df: DataFrame, column: str, first: Column, last: Column) -> DataFrame:
    """Days of a range without any row."""
    present = df.select(F.col(column).cast("date").alias("day")).distinct()
    days = df.sparkSession.range(1).select(F.explode(F.sequence(first, last)).alias("day"))
    return days.join(present, "day", "left_anti")


def latest_header(df: DataFrame, group: list[str], version: str, payload: list[str]) -> DataFrame:
    """Header fields of the highest numeric version; versions that are no number rank lowest."""
    rank = F.coalesce(F.when(F.col(version).rlike("^[0-9]+$"), F.col(version).try_cast("int")), F.lit(-1))
    best = F.max(F.struct(rank.alias("__rank"), F.col(version), *payload)).alias("h")
    return df.groupBy(*group).agg(best).select(*group, f"h.{version}", *[f"h.{p}" for p in payload])


def distinct_by(df: DataFrame, keys: list[str], best_first: list[Column] | None = None) -> DataFrame:
    """Distinct rows by key; with an order the survivor is the first."""
    if best_first is None:
        return df.dropDuplicates(keys)
    from pyspark.sql.window import Window

    order = Window.partitionBy(*keys).orderBy(*best_first)
    return df.withColumn("__n", F.row_number().over(order)).where("__n = 1").drop("__n")


def count_by_source(outputs: dict[str, DataFrame], file_column: str) -> DataFrame:
    """Rows per output type and file."""
    parts = None
    for kind, df in outputs.items():
        one = df.groupBy(file_column).agg(F.count("*").alias("records")).withColumn("output_type", F.lit(kind))
        parts = one if parts is None else parts.unionByName(one)
    return parts
