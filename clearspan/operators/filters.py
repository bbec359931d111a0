"""Row filters and input checks."""

from __future__ import annotations

import re
import warnings
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from clearspan.operators.lookup import lookup_join

# Settlement summary rows that count, and clearing populations.
SUMMARY_LEVEL = "10"
SUMMARY_TYPES = ["100", "110", "120", "200", "210", "300", "310", "330"]
CLEARING_INDICATORS = ["C", "M"]
EXCLUDED_PRODUCT = "GCP"
REPORTED_GROUPS = ["PUR", "CRD", "CSH"]
REPORTED_CODES = ["05", "06", "07", "25", "26", "27"]
# Landing-file names by origin.
FILE_NAME_PARTS = {
    "VI": {"brand": ["VISA_Outward", "VISA_Inward"], "local": ["Local_VISA_"]},
    "MC": {"brand": ["MasterCard_Inward", "MasterCard_Outward"], "local": ["Local_MasterCard"]},
}
COLLECTION_FILES = {"MC": ["MasterCard_CPS_Collections_File"]}


class InputError(ValueError):
    """An input table breaks a rule the job depends on."""


def by_date_range(df: DataFrame, column: str, first: str, last: str) -> DataFrame:
    """Both ends included; no filter when the dataset has no such column."""
    if column not in df.columns:
        return df
    return df.where(F.to_date(F.col(column)).between(F.lit(first).cast("date"), F.lit(last).cast("date")))


def effective_on(valid_from: Column, valid_until: Column, day: Column) -> Column:
    """Valid on a day; an open end is valid."""
    return (valid_from <= day) & (F.coalesce(valid_until, day) >= day)


def effective_rows(df: DataFrame, day: Column, valid_from="valid_from", valid_until="valid_until", active: Column | None = None):
    kept = df.where(effective_on(F.col(valid_from), F.col(valid_until), day))
    return kept.where(active) if active is not None else kept


def in_list(df: DataFrame, listed: DataFrame, keys: dict[str, str] | list[str], fail_if_empty: bool = False) -> DataFrame:
    """Rows whose keys are listed. An empty list keeps nothing, or raises."""
    if fail_if_empty and listed.isEmpty():
        raise InputError("the list of files is empty; check the file ledger for these dates")
    names = list(keys.values()) if isinstance(keys, dict) else keys
    return lookup_join(df, listed.select(*names).distinct(), keys, {}, how="left_semi")


_IN_CONDITION = re.compile(r"(\w+)\s+in\s+\(([^)]+)\)", re.IGNORECASE)


def condition_column(texts: Iterable[str], columns: Iterable[str]) -> Column | None:
    """Conditions of the form ``column IN ('a','b')``; other forms do not filter."""
    columns, folded = set(columns), None
    for text in texts:
        found = _IN_CONDITION.search(text or "")
        if not found or found.group(1) not in columns:
            continue
        one = F.col(found.group(1)).cast("string").isin(re.findall(r"'([^']+)'", found.group(2)))
        folded = one if folded is None else folded & one
    return folded


def client_conditions(conditions: DataFrame, **where: str) -> list[str]:
    """Condition texts of one client; a configuration lookup, so its rows come to the driver."""
    for name, value in where.items():
        conditions = conditions.where(F.col(name).cast("string") == value)
    return sorted(r[0] for r in conditions.where("condition IS NOT NULL").select("condition").distinct().collect())


# Column names that condition texts cite.
ACTIVITY_CONDITION, FILE_CONDITION = "reconciled_member_activity", "app_hash_file"


def by_condition_table(df: DataFrame, conditions: DataFrame, strict: bool = False, **where: str) -> DataFrame:
    """Rows that meet the conditions of one client.

    A condition of a form that no filter reads does not filter: it is reported by a warning or, if ``strict``, raised.
    """
    texts = client_conditions(conditions, **where)
    unread = [t for t in texts if t.strip() and not (_IN_CONDITION.search(t) or ACTIVITY_CONDITION in t or FILE_CONDITION in t)]
    if unread and strict:
        raise InputError(f"conditions of an unknown form: {unread[:5]}")
    if unread:
        warnings.warn(f"conditions of an unknown form do not filter: {unread[:5]}", stacklevel=2)
    predicate = condition_column(texts, df.columns)
    return df if predicate is None else df.where(predicate)


def by_member_activity(df: DataFrame, conditions: DataFrame, column: str, role: str, **where: str) -> DataFrame:
    """Rows of one role, issuer or acquirer, if a condition of the client cites the member activity."""
    cited = any(ACTIVITY_CONDITION in text for text in client_conditions(conditions, **where))
    return df.where(F.col(column).cast("string") == role) if cited and column in df.columns else df


def by_listed_files(
    df: DataFrame, conditions: DataFrame, files: DataFrame, column: str, day: str, **where: str
) -> DataFrame:
    """Rows whose file is among the ``files`` (same two columns) of its day, if a condition of the client cites files.

    A day without listed files keeps no row.
    """
    if column not in df.columns or not any(FILE_CONDITION in text for text in client_conditions(conditions, **where)):
        return df
    return lookup_join(df, files.select(column, day).distinct(), [column, day], {}, how="left_semi")


def summary_detail(level: Column, aggregation: Column, no_data: Column, kind: Column, mode: Column, wanted_mode: str) -> Column:
    """Settlement summary rows at leaf level that carry data."""
    return (
        (level == SUMMARY_LEVEL)
        & (aggregation == 0)
        & (no_data != "Y")
        & kind.isin(SUMMARY_TYPES)
        & (mode == wanted_mode)
    )


def clearing_population(indicator: Column, excluded: Column, product: Column, service: Column | None = None) -> Column:
    """Settled rows that are not excluded and carry a reportable product."""
    kept = (
        indicator.isin(CLEARING_INDICATORS)
        & (F.coalesce(excluded, F.lit(0)) == 0)
        & product.isNotNull()
        & (F.upper(product) != EXCLUDED_PRODUCT)
    )
    return kept if service is None else kept & service.isNotNull()


def reported_draft(group: Column, code: Column) -> Column:
    return group.isin(REPORTED_GROUPS) & code.isin(REPORTED_CODES)


def ledger_files(
    ledger: DataFrame, client: str, brand: str, first: str, last: str, origin: str, collections: bool = False
) -> DataFrame:
    """Ledger rows of a client's files by date range and origin, told from the landing file name."""
    parts = list(FILE_NAME_PARTS[brand][origin]) + (COLLECTION_FILES.get(brand, []) if collections else [])
    named = F.lit(False)
    for part in parts:
        named = named | F.col("landing_file_name").contains(part)
    return ledger.where(
        (F.col("client_id") == client)
        & (F.col("brand_id") == brand)
        & F.col("file_processing_date").between(F.lit(first).cast("date"), F.lit(last).cast("date"))
        & (F.coalesce(F.col("content_hash"), F.lit("")) != "")
        & named
    )


EXAMPLES = 5


def column_problems(df: DataFrame, required: Iterable[str], numeric: Iterable[str], numeric_rows: Column | None = None) -> DataFrame:
    """Nulls in required columns and text that is no number, with the five smallest examples each.

    Only bad values leave the scan, summed up by value.
    """
    required, numeric = list(required), [c for c in numeric if c in df.columns]
    missing = [c for c in required if c not in df.columns]
    if missing:
        raise InputError(f"required columns are absent: {missing}")
    applies = F.lit(True) if numeric_rows is None else numeric_rows
    tests = [(c, "null", F.col(c).isNull()) for c in required]
    for c in numeric:
        filled = F.col(c).isNotNull() & (F.trim(F.col(c).cast("string")) != "")
        tests.append((c, "not a number", applies & filled & F.col(c).cast("string").try_cast("double").isNull()))
    cells = [
        F.when(bad, F.struct(F.lit(c).alias("column"), F.lit(kind).alias("problem"), F.coalesce(F.col(c).cast("string"), F.lit("")).alias("value")))
        for c, kind, bad in tests
    ]
    if not cells:
        return df.sparkSession.createDataFrame([], "column string, problem string, rows long, examples array<string>")
    found = df.select(F.explode(F.array_compact(F.array(*cells))).alias("p")).select("p.*")
    counts = found.groupBy("column", "problem", "value").agg(F.count("*").alias("n"))
    place = F.row_number().over(Window.partitionBy("column", "problem").orderBy("value"))
    first = counts.withColumn("place", place).where(F.col("place") <= EXAMPLES)
    examples = first.groupBy("column", "problem").agg(F.sort_array(F.collect_list("value")).alias("examples"))
    return counts.groupBy("column", "problem").agg(F.sum("n").alias("rows")).join(examples, ["column", "problem"])


def require(df: DataFrame, required: Iterable[str], numeric: Iterable[str] = (), numeric_rows: Column | None = None) -> None:
    """Raise when a required column is absent or null, or a number does not parse."""
    found = column_problems(df, required, numeric, numeric_rows).collect()
    if found:
        raise InputError("; ".join(f"{r['column']}: {r['rows']} rows {r['problem']}, e.g. {r['examples']}" for r in found))
