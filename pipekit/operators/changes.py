"""Change feeds from snapshots, and applying them."""

from __future__ import annotations

import math
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pipekit.functions.text import row_digest
from pipekit.operators.joins import SMALL_ROWS, is_small, outer_join
from pipekit.session import durable

LEAF_ROWS = 1024
MANY_LEAVES = 1_000_000
META = ("change_action", "is_update", "row_id")


def diff_snapshots(before: DataFrame, after: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Row changes between two snapshots that are unique on ``keys``.

    An insert gives one INSERT, a delete one DELETE, an update a DELETE of the old image and an INSERT
    of the new one, both flagged ``is_update``. Rows present and equal on both sides give nothing, so
    the first snapshot is the starting point of the feed.
    """
    keys = list(keys)
    names = after.columns
    values = [c for c in names if c not in keys]
    old = before.select(*keys, F.struct(*names).alias("__old"))
    new = after.select(*keys, F.struct(*names).alias("__new"))
    both = outer_join(old, new, keys)
    same = F.lit(True)
    for c in values:
        same = same & F.col(f"__old.{c}").eqNullSafe(F.col(f"__new.{c}"))

    def change(image: str, action: str, update: bool) -> Column:
        return F.struct(F.col(image).alias("image"), F.lit(action).alias("change_action"),
                        F.lit(update).alias("is_update"))

    rows = (F.when(F.col("__old").isNull(), F.array(change("__new", "INSERT", False)))
            .when(F.col("__new").isNull(), F.array(change("__old", "DELETE", False)))
            .otherwise(F.array(change("__old", "DELETE", True), change("__new", "INSERT", True))))
    changed = F.col("__old").isNull() | F.col("__new").isNull() | ~same
    return (both.where(changed).select(F.explode(rows).alias("__c"))
            .select("__c.image.*", "__c.change_action", "__c.is_update")
            .withColumn("row_id", F.lower(F.hex(row_digest(keys)))))


def _image(sign: int, df: DataFrame, names: Sequence[str]) -> list[Column]:
    """Count and two independent hashes of each row, signed; their sums do not depend on the order of rows."""
    columns = [F.col(c) for c in names]
    return [F.lit(sign).cast("decimal(38,0)").alias("n"),
            (F.xxhash64(*columns).cast("decimal(38,0)") * sign).cast("decimal(38,0)").alias("h1"),
            (F.xxhash64(F.lit(1), *columns).cast("decimal(38,0)") * sign).cast("decimal(38,0)").alias("h2")]


def differing_buckets(before: DataFrame, after: DataFrame, bucket: Column, names: Sequence[str]) -> DataFrame:
    """Buckets whose rows are not the same on both sides. Sums are combined before they move, so a task sends one row
    for each bucket, whatever its rows."""
    signed = before.select(bucket.alias("bucket"), *_image(-1, before, names)).union(
        after.select(bucket.alias("bucket"), *_image(1, after, names)))
    sums = signed.groupBy("bucket").agg(*[F.sum(c).alias(c) for c in ("n", "h1", "h2")])
    return sums.where("n != 0 or h1 != 0 or h2 != 0").select("bucket")


def changed_rows(before: DataFrame, after: DataFrame, keys: Sequence[str], leaf_rows: int = LEAF_ROWS,
                 ) -> tuple[DataFrame, DataFrame]:
    """The rows of both snapshots that a digest tree cannot rule out as unchanged.

    Keys are dealt over buckets of some ``leaf_rows`` rows. Level one compares digests of groups of buckets, as many
    groups as a group has buckets; level two those of the buckets in groups that differ. Only rows of buckets that
    differ come back, and rows with a NULL key, which equal none. Equal digests are taken as equal rows (128 bits).
    """
    names = after.columns
    if [before.schema[c].dataType for c in names] != [after.schema[c].dataType for c in names]:
        raise ValueError("snapshots must have the same columns and types")
    fan = max(1, math.isqrt(max(before.count(), after.count()) // leaf_rows) + 1)
    any_null = reduce(lambda a, b: a | b, [F.col(k).isNull() for k in keys])
    leaf = F.when(any_null, F.lit(-1).cast("bigint")).otherwise(F.pmod(F.xxhash64(*keys), F.lit(fan * fan)))
    group = F.when(any_null, F.lit(-1).cast("bigint")).otherwise(F.floor(leaf / fan).cast("bigint"))
    always = before.sparkSession.range(1).select(F.lit(-1).cast("bigint").alias("bucket"))
    groups = durable(differing_buckets(before, after, group, names).union(always).distinct(), "digest-groups")

    def within(df: DataFrame, bucket: Column, wanted: DataFrame) -> DataFrame:
        return df.withColumn("bucket", bucket).join(wanted, "bucket", "left_semi").select(*names)

    some = F.broadcast(groups)  # at most ``fan`` and one rows
    leaves = differing_buckets(within(before, group, some), within(after, group, some), leaf, names).union(always)
    leaves = durable(leaves.distinct(), "digest-leaves")
    wanted = F.broadcast(leaves) if leaves.count() <= MANY_LEAVES else leaves
    return within(before, leaf, wanted), within(after, leaf, wanted)


def diff_by_digest(before: DataFrame, after: DataFrame, keys: Sequence[str], leaf_rows: int = LEAF_ROWS) -> DataFrame:
    """:func:`diff_snapshots` for large snapshots with few changes: rows of :func:`changed_rows` only are shuffled, so
    what moves grows with the changes. Both sides are scanned three times."""
    return diff_snapshots(*changed_rows(before, after, keys, leaf_rows), keys)


def net_changes(changes: DataFrame, keys: Sequence[str], seq: str | None = None) -> DataFrame:
    """Last change per key. Within one ``seq`` the new image of an update wins over the old one."""
    keys = list(keys)
    rank = F.when(F.col("change_action") == "INSERT", F.lit(1)).otherwise(F.lit(0))
    order = F.struct(F.col(seq), rank) if seq else rank
    rest = [c for c in changes.columns if c not in keys]
    last = changes.groupBy(*keys).agg(F.max_by(F.struct(*rest), order).alias("__last"))
    return last.select(*keys, "__last.*")


def apply_changes(target: DataFrame, changes: DataFrame, keys: Sequence[str], seq: str | None = None,
                  small_rows: int = SMALL_ROWS) -> DataFrame:
    """Target after a change feed: deleted keys go, changed and new keys take their last image.

    The net changes are computed once and kept. If they prove small they are broadcast and the target is
    not shuffled; else both meet in one full outer join.
    """
    keys = list(keys)
    net = durable(net_changes(changes, keys, seq), "net-changes")
    if small_rows and is_small(net, small_rows):
        kept = target.join(F.broadcast(net.select(*keys)), keys, "left_anti")
        return kept.unionByName(net.where(F.col("change_action") == "INSERT").select(*target.columns))
    old = target.select(*keys, F.struct(*target.columns).alias("__old"))
    new = net.select(*keys, "change_action", F.struct(*target.columns).alias("__new"))
    both = outer_join(old, new, keys).where(F.coalesce("change_action", F.lit("KEEP")) != "DELETE")
    image = F.when(F.col("change_action").isNull(), F.col("__old")).otherwise(F.col("__new"))
    return both.select(image.alias("__row")).select("__row.*")
