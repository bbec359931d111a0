"""Projections that depend on which columns a dataset has."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def project(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    """Fixed, ordered output list."""
    return df.select(*columns)


def optional(df: DataFrame, name: str, default=None) -> Column:
    """The column if the dataset has it, else a literal."""
    return F.col(f"`{name}`") if name in df.columns else F.lit(default)


def first_existing(df: DataFrame, names: Iterable[str], default=None, ignore_case: bool = False) -> Column:
    """First non-null value over those of the named columns that exist."""
    spelled = {c.upper() if ignore_case else c: c for c in df.columns}
    present = [spelled[key] for key in (n.upper() if ignore_case else n for n in names) if key in spelled]
    return F.coalesce(*[F.col(f"`{c}`") for c in present]) if present else F.lit(default)


def align(df: DataFrame, schema: T.StructType | str) -> DataFrame:
    """Exactly the target columns: missing ones null, order and types as declared."""
    schema = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    aligned = []
    for f in schema:
        value = optional(df, f.name).cast("string")
        if f.name in df.columns:
            same = df.schema[f.name].dataType == f.dataType
            value = F.col(f"`{f.name}`") if same else F.col(f"`{f.name}`").try_cast(f.dataType)
        aligned.append(value.cast(f.dataType).alias(f.name))
    return df.select(*aligned)


def rename_from_catalog(df: DataFrame, catalog: Iterable[dict], drop: Iterable[str] = ()) -> DataFrame:
    """Technical to business names; the first catalog row of a technical name counts."""
    names: dict[str, str] = {}
    for row in catalog:
        names.setdefault(row["technical"], row["name"])
    present = {old: new for old, new in names.items() if old in df.columns}
    return df.drop(*drop).withColumnsRenamed(present)


def order_by_layout(df: DataFrame, first: Iterable[str], layout: dict[str, list[str]]) -> DataFrame:
    """First columns, then each layout field followed by its sub-fields, then all others."""
    wanted = list(first)
    for parent, children in layout.items():
        wanted += [parent, *children]
    present = [c for c in dict.fromkeys(wanted) if c in df.columns]
    return df.select(*present, *[c for c in df.columns if c not in present])


def extra_fields(df: DataFrame, fields: dict[str, Column], enabled: bool) -> DataFrame:
    """Optional output fields: real values for clients with an override, else empty text."""
    for name, value in fields.items():
        df = df.withColumn(name, value.cast("string") if enabled else F.lit(""))
    return df


def copy_columns(df: DataFrame, copies: dict[str, str], constants: dict[str, object] | None = None) -> DataFrame:
    """Renamed copies and constant columns."""
    new = {name: F.col(source) for name, source in copies.items()}
    new.update({name: F.lit(value) for name, value in (constants or {}).items()})
    return df.withColumns(new)
