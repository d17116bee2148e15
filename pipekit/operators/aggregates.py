"""Aggregations and latest-row picks. All combine map-side before the shuffle."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pipekit.functions.text import tolerant_number


def row_count(df: DataFrame, name: str = "row_count") -> DataFrame:
    """Global row count as one row."""
    return df.agg(F.count(F.lit(1)).alias(name))


def group_summary(df: DataFrame, by: Sequence[str], measure: str | Column) -> DataFrame:
    """Count, sum, average, minimum and maximum of a measure per group."""
    return df.groupBy(*by).agg(
        F.count(F.lit(1)).alias("row_count"), F.sum(measure).alias("total"),
        F.avg(measure).alias("average"), F.min(measure).alias("lowest"), F.max(measure).alias("highest"))


def count_by(df: DataFrame, *by: str | Column, name: str = "row_count") -> DataFrame:
    """Row count per value."""
    return df.groupBy(*by).agg(F.count(F.lit(1)).alias(name))


def tolerant_sum(df: DataFrame, column: str | Column, name: str = "total") -> DataFrame:
    """Sum of text values; those that do not parse are skipped."""
    return df.agg(F.coalesce(F.sum(tolerant_number(column)), F.lit(0.0)).alias(name))


def latest_row(df: DataFrame, order: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """The row with the highest ``order`` values, overall or per group. No window: each side
    of the shuffle sorts by the group and keeps one row of it."""
    key = F.struct(*order) if len(order) > 1 else F.col(order[0])
    rest = [c for c in df.columns if c not in by]
    best = df.groupBy(*by).agg(F.max_by(F.struct(*rest), key).alias("__row"))
    return best.where(F.col("__row").isNotNull()).select(*by, "__row.*")


def top_n(df: DataFrame, n: int, *order: Column) -> DataFrame:
    """First ``n`` rows of an order; each task keeps ``n`` rows only."""
    return df.orderBy(*order).limit(n)


def union_blocks(*blocks: DataFrame) -> DataFrame:
    """UNION ALL by name; a column that a block lacks is NULL there."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), blocks)


def table_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """One row per table with its row count."""
    return union_blocks(*[
        row_count(df).select(F.lit(name).alias("table_name"), "row_count") for name, df in tables.items()])
