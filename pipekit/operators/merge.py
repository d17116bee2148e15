"""Upsert, keyed update and keyed delete as joins."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pipekit.operators.joins import SMALL_ROWS, is_small, outer_join


class DuplicateKeyError(ValueError):
    """A merge or lookup side holds more than one row for a key."""


def assert_unique(df: DataFrame, keys: Sequence[str], what: str = "source") -> None:
    """Fail with a few sample keys when a key repeats. NULL keys never match and may repeat."""
    repeated = (df.na.drop(subset=list(keys)).groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
                .where("n > 1").limit(5).collect())
    if repeated:
        raise DuplicateKeyError(f"{what} has repeated keys: {[tuple(r)[:-1] for r in repeated]}")


def upsert(target: DataFrame, source: DataFrame, keys: Sequence[str],
           stamp: Mapping[str, Column] | None = None, check: bool = True,
           small_rows: int = SMALL_ROWS, null_keys: bool = True) -> DataFrame:
    """MERGE: matched rows take the source values, new keys are added, the rest stays.

    ``stamp`` sets columns on every touched row (for example an update date). A source of at most
    ``small_rows`` rows and 64 MB is broadcast and the target is not shuffled; a larger one meets the
    target in one full outer join, which deals rows with a NULL key over all partitions. ``null_keys=False`` says that
    there are none, so that sides laid out by the bare key meet as they lie.
    """
    keys, stamp = list(keys), dict(stamp or {})
    if check:
        assert_unique(source, keys)
    values = [c for c in target.columns if c not in keys]
    given = [c for c in values if c in source.columns and c not in stamp]
    side = source.select(*keys, *[F.col(c).alias(f"__s_{c}") for c in given],
                         F.lit(True).alias("__src"))

    def new_value(name: str) -> Column:
        if name in stamp:
            return F.when(F.col("__src"), stamp[name]).otherwise(F.col(name)).alias(name)
        if name in given:
            return F.when(F.col("__src"), F.col(f"__s_{name}")).otherwise(F.col(name)).alias(name)
        return F.col(name)

    columns = [new_value(c) if c in values else F.col(c) for c in target.columns]
    if not small_rows or not is_small(side, small_rows):
        joined = outer_join(target, side, keys) if null_keys else target.join(side, keys, "full_outer")
        return joined.select(*columns)

    updated = target.join(F.broadcast(side), keys, "left").select(*columns)
    matched = target.select(*keys).join(F.broadcast(side.select(*keys)), keys, "left_semi").distinct()
    fresh = source.join(matched, keys, "left_anti")
    inserted = fresh.select(*[
        (stamp[c] if c in stamp else F.col(c) if c in keys + given
         else F.lit(None).cast(target.schema[c].dataType)).alias(c)
        for c in target.columns])
    return updated.unionByName(inserted)


def update_rows(df: DataFrame, where: Column, values: Mapping[str, Column]) -> DataFrame:
    """Set columns on the rows where the condition is true."""
    hit = F.coalesce(where, F.lit(False))
    return df.select(*[
        F.when(hit, values[f.name].cast(f.dataType)).otherwise(F.col(f.name)).alias(f.name)
        if f.name in values else F.col(f.name) for f in df.schema.fields])


def delete_rows(df: DataFrame, where: Column) -> DataFrame:
    """Remove the rows where the condition is true; NULL keeps the row."""
    return df.where(~F.coalesce(where, F.lit(False)))
