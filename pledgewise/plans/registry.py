"""Where queries register themselves, with their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable:
    """Registers ``f(tables)`` as ``name``; ``tables`` gives the given tables and those derived from them."""

    def register(f: Callable) -> Callable:
        from .substrate import Tables

        QUERIES[name] = lambda spark, sf_dir: f(Tables(spark, sf_dir))
        if sql:
            ORACLE_SQL[name] = sql
        return f

    return register
