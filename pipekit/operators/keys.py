"""Dense keys without a one-task window."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pipekit.functions.text import coded_label
from pipekit.session import durable

# monotonically_increasing_id keeps the partition number above this bit and the row number below it.
_ROW_BITS = 33


def dense_keys(df: DataFrame, order_by: Sequence[str | Column], name: str = "key",
               start: int | Column = 1) -> DataFrame:
    """Number all rows ``start, start+1, …`` in the given order, which must be total.

    Rows are range-partitioned and sorted once, kept in reliable storage so that partition and
    position cannot change between the two uses, and shifted by the row counts of the partitions
    before theirs. Only one count per partition is ever brought together.
    """
    placed = durable(
        df.repartitionByRange(*order_by).sortWithinPartitions(*order_by)
        .withColumn("__id", F.monotonically_increasing_id()))
    part = F.shiftright("__id", _ROW_BITS).alias("__part")
    row = F.col("__id").bitwiseAND(F.lit((1 << _ROW_BITS) - 1))
    sizes = placed.groupBy(part).agg((F.max(row) + 1).alias("__rows"))
    # One row per partition, so this window is as small as the partition count.
    earlier = Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    before = sizes.select("__part", F.coalesce(F.sum("__rows").over(earlier), F.lit(0)).alias("__before"))
    first = start if isinstance(start, Column) else F.lit(start)
    return (
        placed.withColumn("__part", part).join(F.broadcast(before), "__part")
        .withColumn(name, (first + F.col("__before") + row).cast("bigint"))
        .drop("__part", "__id", "__before"))


def next_id(df: DataFrame, column: str) -> DataFrame:
    """One row with the next free id: highest id plus one, 1 for an empty table."""
    return df.agg((F.coalesce(F.max(column), F.lit(0)) + 1).cast("bigint").alias("next_id"))


def append_keys(members: DataFrame, existing: DataFrame | None, order_by: Sequence[str],
                name: str) -> DataFrame:
    """Give new members the numbers after the highest existing key."""
    start = F.lit(1) if existing is None else next_id(existing, name).scalar()
    return dense_keys(members, order_by, name, start)


def coded_keys(df: DataFrame, column: str, prefix: str, name: str = "code", width: int = 2,
               ) -> DataFrame:
    """Coded key (``CY01``…) for each distinct non-NULL value, in sorted order."""
    members = df.select(column).where(F.col(column).isNotNull()).distinct()
    ranked = dense_keys(members, [column], "__rank")
    return ranked.select(coded_label(prefix, "__rank", width).alias(name), column)
