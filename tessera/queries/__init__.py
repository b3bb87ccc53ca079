"""Registered queries: one Spark function and (where SQL can say the same
thing) one DuckDB SQL twin per operator key.

Each family module decorates its functions with :func:`query`; importing
:mod:`tessera.queries.all` loads every family.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QueryFn = Callable[[SparkSession, str], DataFrame]

REGISTRY: dict[str, QueryFn] = {}
SQL: dict[str, str] = {}


def query(key: str, sql: str | None = None):
    """Register ``fn(spark, sf_dir) -> DataFrame`` under ``key``."""
    def deco(fn: QueryFn) -> QueryFn:
        if key in REGISTRY:
            raise KeyError(f"duplicate query key {key}")
        REGISTRY[key] = fn
        if sql is not None:
            SQL[key] = sql.strip()
        return fn
    return deco
