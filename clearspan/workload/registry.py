"""Queries over the base tables and the SQL they are checked against."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import Column, DataFrame, SparkSession

from clearspan import fixtures
from clearspan.session import ship

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def with_views(sql: str, views: tuple[str, ...], more: str = "") -> str:
    """Put the named views, then further CTEs, in front of a SELECT."""
    parts = [f"{v} AS ({fixtures.ORACLE_VIEWS[v]})" for v in views]
    if more:
        parts.append(more.strip().rstrip(","))
    return f"WITH {', '.join(parts)} {sql}" if parts else sql


def query(name: str, sql: str | None = None, views: tuple[str, ...] = (), more: str = ""):
    """Register ``fn(spark, sf_dir)`` under a name, with its oracle if it has one."""

    def add(fn):
        assert name not in QUERIES, name

        @wraps(fn)
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            ship(spark)
            return fn(spark, sf_dir)

        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = with_views(sql, views, more)
        return fn

    return add


def scalar(
    name: str,
    inputs: dict[str, str],
    build: Callable[[], list[Column]],
    sql: dict[str, str],
    view: str = "txn",
    key: str = "record",
):
    """Register a row-level query: input columns as shared SQL text, outputs built in each engine."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        base = getattr(fixtures, view)(spark, sf_dir)
        return base.selectExpr(key, *[f"{e} AS {c}" for c, e in inputs.items()]).select(key, *build())

    inner = ", ".join(f"{e} AS {c}" for c, e in inputs.items())
    outer = ", ".join(f"{e} AS {c}" for c, e in sql.items())
    text = f"SELECT {key}, {outer} FROM (SELECT {key}{', ' + inner if inner else ''} FROM {view}) t"
    query(name, text, (view,))(run)
