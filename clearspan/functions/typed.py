"""Casting whole records by a field catalog."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clearspan.functions import dates, numbers, text

# Scale flags of the message catalog and the currency column each one reads.
SCALE_PREFIXED = -1
SCALE_FROM_CURRENCY = {
    -2: "currency_code_transaction_de_49",
    -3: "currency_code_reconciliation_de_50",
    -4: "currency_code_cardholder_billing_de_51",
}


def catalog_schema(catalog: Iterable[dict], default_scale: int = 2) -> T.StructType:
    """Schema declared by catalog rows (``name``, ``type``, ``decimals``)."""
    return T.StructType([T.StructField(r["name"], catalog_type(r, default_scale), True) for r in catalog])


def catalog_type(row: dict, default_scale: int = 2) -> T.DataType:
    plain = {
        "int64": T.LongType(),
        "integer": T.LongType(),
        "int32": T.IntegerType(),
        "double": T.DoubleType(),
        "float": T.DoubleType(),
        "date": T.DateType(),
        "timestamp": T.TimestampType(),
    }
    if row["type"] == "decimal":
        scale = row.get("decimals")
        scale = default_scale if scale is None else int(scale)
        if scale == SCALE_PREFIXED:
            return T.DecimalType(18, 9)
        return T.DecimalType(18, 4 if scale in SCALE_FROM_CURRENCY else scale)
    return plain.get(row["type"], T.StringType())


def text_record_columns(catalog: Iterable[dict], file_date: Column) -> list[Column]:
    """Fixed-width record fields: failed numbers become 0, empty text one blank, bad dates null."""
    out = []
    for row in catalog:
        name, kind = row["name"], row["type"]
        c = F.col(f"`{name}`")
        if kind == "int":
            value = F.coalesce(F.trim(c).try_cast("decimal(24,4)").try_cast("bigint"), F.lit(0).cast("bigint"))
        elif kind == "float":
            value = text.overpunch_amount(c, int(row.get("decimals", 2)))
        elif kind == "date":
            value = dates.parse_clearing_date(c, row["format"], file_date)
        else:
            value = text.blank_to_space(c)
            if row.get("digits_only"):
                value = text.non_digits_to_zero(value)
        out.append(value.alias(name))
    return out


def message_columns(
    df: DataFrame, catalog: Iterable[dict], currency_decimals: str = "decimals_of", default_scale: int = 2
) -> list[Column]:
    """Message fields: anything that does not parse becomes null.

    ``currency_decimals`` is a map column from the three-digit currency code to its decimals.
    """
    out = []
    for row in catalog:
        name, kind = row["name"], row["type"]
        if name not in df.columns:
            continue
        c = F.col(f"`{name}`")
        digits = F.regexp_replace(F.trim(c.cast("string")), r"\.0$", "")
        if kind in ("int64", "int32"):
            value = F.trim(c.cast("string")).try_cast("decimal(24,4)").try_cast("bigint" if kind == "int64" else "int")
        elif kind == "date":
            padded = F.lpad(digits, 6, "0")
            stamp = F.concat(dates.full_year(F.substring(padded, 1, 2)), F.substring(padded, 3, 4))
            value = F.when(stamp.rlike("^[0-9]{8}$"), F.try_to_date(stamp, "yyyyMMdd"))
        elif kind == "timestamp":
            padded = F.lpad(digits, 12, "0")
            stamp = F.concat(dates.full_year(F.substring(padded, 1, 2)), F.substring(padded, 3, 10))
            value = F.when(stamp.rlike("^[0-9]{14}$"), F.try_to_timestamp(stamp, F.lit("yyyyMMddHHmmss")))
        elif kind == "time":
            padded = F.lpad(digits, 6, "0")
            value = F.concat_ws(":", *[F.substring(padded, p, 2) for p in (1, 3, 5)])
            value = F.when(c.isNotNull(), value)
        elif kind == "decimal":
            scale = row.get("decimals")
            scale = default_scale if scale is None else int(scale)
            if scale == SCALE_PREFIXED:
                value = numbers.scale_prefixed(c.cast("string")).cast("decimal(18,9)")
            elif scale in SCALE_FROM_CURRENCY:
                source = SCALE_FROM_CURRENCY[scale]
                if source in df.columns:
                    code = F.lpad(F.trim(F.col(source).cast("string")), 3, "0")
                    found = F.try_element_at(F.col(currency_decimals), code)
                    value = numbers.currency_scaled(c.cast("string"), found, default_scale)
                else:
                    value = F.lit(None).cast("decimal(18,4)")
            else:
                value = numbers.implied_decimal(c.cast("string"), scale).cast(f"decimal(18,{scale})")
        else:
            value = c.cast("string")
            if row.get("digits_only"):
                value = text.non_digits_to_zero(value)
        out.append(value.alias(name))
    return out
