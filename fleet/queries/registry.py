"""Registered queries with the SQL that gives the same rows."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession

from fleet.session import ship_package

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None):
    """Register a function of (session, table folder) under its name."""

    def register(fn: Callable[[SparkSession, str], DataFrame]):
        @wraps(fn)
        def run(spark: SparkSession, folder: str) -> DataFrame:
            ship_package(spark)
            return fn(spark, folder)

        QUERIES[fn.__name__] = run
        if sql:
            SQL[fn.__name__] = sql
        return fn

    return register


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


def sql_uniform(seed: int | str, *keys: str, start: int = 1) -> str:
    """The reproducible draw of ``fleet.functions.draws.uniform`` in SQL."""
    parts = ", ".join(f"CAST({k} AS VARCHAR)" for k in keys)
    return f"(CAST('0x' || substr(md5(concat_ws('|', '{seed}', {parts})), {start}, 13) AS BIGINT) / 4503599627370496.0)"
