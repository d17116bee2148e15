"""Slowly changing dimensions, types 1 and 2."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pipekit.functions.times import as_of_column
from pipekit.operators.joins import outer_join
from pipekit.operators.merge import assert_unique, upsert

OPEN_END = "9999-12-31 23:59:59"


def _open_end() -> Column:
    return F.lit(OPEN_END).cast("timestamp_ntz")


def scd2_initial(source: DataFrame, as_of: dt.datetime | Column) -> DataFrame:
    """Every source row as the current version from ``as_of`` on."""
    return (source.withColumn("valid_from", as_of_column(as_of))
            .withColumn("valid_to", _open_end()).withColumn("is_current", F.lit(True)))


def scd2_expire(history: DataFrame, where: Column, as_of: dt.datetime | Column) -> DataFrame:
    """Close the current versions that meet a condition."""
    hit = F.coalesce(where, F.lit(False)) & F.col("is_current")
    return (history
            .withColumn("valid_to", F.when(hit, as_of_column(as_of)).otherwise(F.col("valid_to")))
            .withColumn("is_current", F.when(hit, F.lit(False)).otherwise(F.col("is_current"))))


def scd2_add(history: DataFrame, rows: DataFrame, as_of: dt.datetime | Column) -> DataFrame:
    """Add rows as current versions."""
    return history.unionByName(scd2_initial(rows, as_of).select(*history.columns))


def scd2_changes(open_rows: DataFrame, source: DataFrame, keys: Sequence[str],
                 as_of: dt.datetime | Column) -> DataFrame:
    """Open versions after meeting the source: unchanged ones, closed ones and their successors.

    Both sides hold one row per key, so the join has no hot key.
    """
    keys = list(keys)
    tracked = [c for c in source.columns if c not in keys]
    now = as_of_column(as_of)
    old = open_rows.select(*keys, F.struct(*open_rows.columns).alias("__old"))
    new = source.select(*keys, F.struct(*tracked).alias("__new"))
    both = outer_join(old, new, keys)
    same = F.lit(True)
    for c in tracked:
        same = same & F.col(f"__old.{c}").eqNullSafe(F.col(f"__new.{c}"))

    opened = {"valid_from": now, "valid_to": _open_end(), "is_current": F.lit(True)}
    closed = {"valid_to": now, "is_current": F.lit(False)}

    def new_version(name: str) -> Column:
        if name in opened:
            return opened[name]
        if name in keys:
            return F.col(name)
        return F.col(f"__new.{name}") if name in tracked else F.lit(None)

    def version(pick: Callable[[str], Column]) -> Column:
        return F.struct(*[pick(f.name).cast(f.dataType).alias(f.name) for f in open_rows.schema.fields])

    fresh = version(new_version)
    kept = version(lambda name: F.col(f"__old.{name}"))
    ended = version(lambda name: closed.get(name, F.col(f"__old.{name}")))
    rows = (F.when(F.col("__old").isNull(), F.array(fresh))
            .when(F.col("__new").isNull() | same, F.array(kept))
            .otherwise(F.array(ended, fresh)))
    return both.select(F.explode(rows).alias("__row")).select("__row.*")


def scd2_apply(history: DataFrame, source: DataFrame, keys: Sequence[str],
               as_of: dt.datetime | Column, check: bool = True) -> DataFrame:
    """Close changed keys and add the new versions of changed and new keys, with one ``as_of``.

    Closed versions never enter the join, however long the history is.
    """
    if check:
        assert_unique(source, keys)
    closed = history.where(~F.coalesce(F.col("is_current"), F.lit(False)))
    return closed.unionByName(scd2_changes(history.where(F.col("is_current")), source, keys, as_of))


def scd1_apply(target: DataFrame, source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Old values replaced, no history."""
    return upsert(target, source, keys)


def current_rows(history: DataFrame) -> DataFrame:
    return history.where(F.col("is_current"))


def rows_as_of(history: DataFrame, as_of: dt.datetime | Column) -> DataFrame:
    """Versions valid at a point in time (start inclusive, end exclusive)."""
    now = as_of_column(as_of)
    return history.where((F.col("valid_from") <= now) & (F.col("valid_to") > now))


def key_history(history: DataFrame, where: Column) -> DataFrame:
    """All versions of the selected keys, oldest first."""
    return history.where(where).orderBy("valid_from")
