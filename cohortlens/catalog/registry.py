"""Registry of the queries and, where SQL can express them, the SQL that must give the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def add(fn: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"query '{name}' is registered twice")
        QUERIES[name] = fn
        if sql is not None:
            SQL[name] = sql
        return fn

    return add


def with_(views: str, body: str) -> str:
    return f"WITH {views.strip()}\n{body.strip()}"


def r6(c: str | Column, name: str | None = None) -> Column:
    """Rounded to 6 decimals, so that the order of addition does not show."""
    col = F.col(c) if isinstance(c, str) else c
    return F.round(col, 6).alias(name or c)


def r9(c: str | Column, name: str | None = None) -> Column:
    """Rounded to 9 decimals: for means of rounded values, which often end exactly half-way at 6."""
    col = F.col(c) if isinstance(c, str) else c
    return F.round(col, 9).alias(name or c)
