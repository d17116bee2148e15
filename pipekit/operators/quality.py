"""Row validation, null and duplicate removal, duplicate report."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import cached_property

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pipekit.functions.text import row_digest
from pipekit.operators.joins import HEAVY_SHARE, SMALL_ROWS, lookup_join
from pipekit.session import durable


def error_reason(rules: Sequence[tuple[Column, str]]) -> Column:
    """Reason of the first rule whose *failing* condition is true, NULL for a valid row."""
    reasons = [F.when(bad, F.lit(reason)) for bad, reason in rules]
    return F.coalesce(*reasons) if len(reasons) > 1 else reasons[0]


def required(column: str) -> tuple[Column, str]:
    return F.col(column).isNull(), f"{column} is required"


def in_range(column: str, low, high) -> tuple[Column, str]:
    return (F.col(column) < F.lit(low)) | (F.col(column) > F.lit(high)), f"{column} out of range"


def max_length(column: str, size: int) -> tuple[Column, str]:
    return F.length(column) > size, f"{column} longer than {size}"


def validate(df: DataFrame, rules: Sequence[tuple[Column, str]]) -> DataFrame:
    """Add ``error_reason``; filter on it for the valid rows and the rejects."""
    return df.withColumn("error_reason", error_reason(rules))


def split_valid(df: DataFrame, rules: Sequence[tuple[Column, str]]) -> tuple[DataFrame, DataFrame]:
    """Valid rows and rejects."""
    checked = validate(df, rules)
    return (checked.where(F.col("error_reason").isNull()).drop("error_reason"),
            checked.where(F.col("error_reason").isNotNull()))


def drop_nulls(df: DataFrame, subset: Sequence[str] | None = None) -> DataFrame:
    """Remove rows with a NULL in any of the columns."""
    return df.na.drop(subset=list(subset) if subset else None)


def drop_duplicates(df: DataFrame, keys: Sequence[str], order_by: Sequence[str] | None = None,
                    ) -> DataFrame:
    """One row per key: the first by ``order_by``, else any. Keys with text in them meet by a digest, so no text is
    sorted or hashed again and again as a group key."""
    kinds = {c: df.schema[c].dataType for c in keys}
    # Zero has one sign here, as in any grouping.
    parts = [F.col(c) + F.lit(0).cast(kind) if isinstance(kind, (T.DoubleType, T.FloatType)) else F.col(c)
             for c, kind in kinds.items()]
    texts = any(isinstance(kind, (T.StringType, T.BinaryType)) for kind in kinds.values())
    group = [row_digest(parts).alias("__set")] if texts else list(keys)
    order = None if not order_by else F.struct(*order_by) if len(order_by) > 1 else F.col(order_by[0])
    row = F.struct(*df.columns)
    best = df.groupBy(*group).agg((F.first(row) if order is None else F.min_by(row, order)).alias("__row"))
    return best.select("__row.*")


def max_length_violations(df: DataFrame, limits: Mapping[str, int]) -> DataFrame:
    """Rows whose text exceeds a declared column length."""
    return validate(df, [max_length(c, n) for c, n in limits.items()]).where("error_reason is not null")


class DuplicateReport:
    """First row of each set of identical rows, the later ones, and totals.

    Rows are identical when their ``columns`` are (NULL equals NULL); ``order_by`` must be unique and
    gives the input order. Sets are counted by a 256-bit digest, combined map-side, so a set that holds
    a third of all rows moves as one small row per task. Only sets with copies are kept; rows meet them
    by broadcast when they prove small, else by a join that never shuffles the heavy sets.
    """

    def __init__(self, df: DataFrame, columns: Sequence[str], order_by: Sequence[str],
                 measure: str | None = None, small_rows: int = SMALL_ROWS):
        self._rows = df.withColumn("__set", row_digest(columns))
        self._order = F.struct(*order_by) if len(order_by) > 1 else F.col(order_by[0])
        self._measure, self._small_rows = measure, small_rows

    @cached_property
    def _copied_sets(self) -> DataFrame:
        sets = self._rows.groupBy("__set").agg(
            F.min(self._order).alias("__first"), F.count(F.lit(1)).alias("occurrences"))
        return durable(sets.where(F.col("occurrences") > 1), "copied-sets")

    @cached_property
    def _heavy_sets(self) -> DataFrame:
        """Sets with more than a thousandth of all copies: fewer than a thousand."""
        total = self._copied_sets.agg(F.sum("occurrences")).first()[0] or 0
        return self._copied_sets.where(F.col("occurrences") * HEAVY_SHARE > total).select("__set")

    def _marked(self, how: str) -> DataFrame:
        return lookup_join(self._rows, self._copied_sets, "__set", how, skewed=True,
                           heavy=self._heavy_sets, small_rows=self._small_rows)

    @property
    def clean(self) -> DataFrame:
        """First occurrence of every row, with ``occurrences``."""
        first = F.col("__first").isNull() | (self._order == F.col("__first"))
        return (self._marked("left").where(first)
                .withColumn("occurrences", F.coalesce("occurrences", F.lit(1).cast("bigint")))
                .drop("__set", "__first"))

    @property
    def duplicates(self) -> DataFrame:
        """Later occurrences, with ``occurrences`` of their set."""
        return self._marked("inner").where(self._order != F.col("__first")).drop("__set", "__first")

    @property
    def summary(self) -> DataFrame:
        """One row: clean rows, duplicate rows, and the tolerant total of ``measure`` (one of the
        identity columns) over the clean rows."""
        value = ([F.first(F.col(self._measure).try_cast("double")).alias("__value")] if self._measure else [])
        sets = self._rows.groupBy("__set").agg(F.count(F.lit(1)).alias("n"), *value)
        total = ([F.coalesce(F.sum("__value"), F.lit(0.0)).alias("measure_total")] if self._measure else [])
        return sets.agg(F.count(F.lit(1)).alias("clean_rows"),
                        F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("duplicate_rows"), *total)


def duplicate_report(df: DataFrame, columns: Sequence[str], order_by: Sequence[str],
                     measure: str | None = None) -> DuplicateReport:
    """Clean rows, duplicate rows and totals of a table; see :class:`DuplicateReport`."""
    return DuplicateReport(df, columns, order_by, measure)
