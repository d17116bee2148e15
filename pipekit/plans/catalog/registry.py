"""Where catalogue queries register: name, operators shown, Spark form, SQL form."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}
OPERATORS: dict[str, list[str]] = {}


def query(name: str, ops: str, sql: str | None = None):
    """Register a query; ``ops`` lists operator ids, ``sql`` gives the same rows."""
    def add(build: Callable[[SparkSession, str], DataFrame]):
        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")
        QUERIES[name], OPERATORS[name] = build, ops.split()
        if sql is not None:
            ORACLES[name] = sql
        return build
    return add


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def money(column: Column | str) -> Column:
    """Exact decimal for sums and products."""
    return (F.col(column) if isinstance(column, str) else column).cast("decimal(14,2)")


def dbl(column: Column | str) -> Column:
    return (F.col(column) if isinstance(column, str) else column).cast("double")


def day(column: Column | str) -> Column:
    return F.date_format(column, "yyyy-MM-dd")
