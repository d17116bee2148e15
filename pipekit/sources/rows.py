"""Literal rows and row generators."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


def from_tuples(spark: SparkSession, rows: Sequence[tuple], columns: Sequence[str] | str) -> DataFrame:
    """Rows from tuples with column names, or a typed schema text."""
    return spark.createDataFrame(rows, columns if isinstance(columns, str) else list(columns))


def from_dicts(spark: SparkSession, rows: Sequence[Mapping], schema: T.StructType | str | None = None,
               ) -> DataFrame:
    """Rows from dicts. A schema keeps the column order and makes nested dicts structs, not maps."""
    if schema is not None:
        return spark.createDataFrame([dict(r) for r in rows], schema)
    return spark.createDataFrame([dict(r) for r in rows])


def generate(spark: SparkSession, n: int, name: str = "seq") -> DataFrame:
    """``n`` rows numbered from 0, made by the executors."""
    return spark.range(n).toDF(name)
