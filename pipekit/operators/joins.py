"""Joins that stay balanced when one key holds a large share of the rows."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pipekit.session import durable

HEAVY_SHARE = 1000
SALTS = 64
SMALL_ROWS = 100_000
SMALL_BYTES = 64 * 1024 * 1024


def _any_null(columns: Sequence[str]) -> Column:
    return reduce(lambda a, b: a | b, [F.col(c).isNull() for c in columns])


def is_small(df: DataFrame, rows: int = SMALL_ROWS, size: int = SMALL_BYTES) -> bool:
    """True when ``df`` is within both bounds, rows and bytes of its values. Takes sizes partition by
    partition and stops at the bound; only the sizes come to the driver."""
    sizes = df.select(F.octet_length(F.to_json(F.struct(*df.columns))).alias("b")).take(rows + 1)
    return len(sizes) <= rows and sum(r["b"] for r in sizes) <= size


def broadcast_if_small(df: DataFrame, rows: int = SMALL_ROWS) -> DataFrame:
    """Broadcast hint behind a size check; a larger side is left to Spark's shuffle joins."""
    return F.broadcast(df) if is_small(df, rows) else df


def heavy_keys(df: DataFrame, keys: Sequence[str], share: int = HEAVY_SHARE) -> DataFrame:
    """Keys that hold more than 1/``share`` of all rows: fewer than ``share`` rows by counting.

    Found in one narrow pass with map-side counts, and kept, so that its users do not count again.
    """
    total = df.count()
    counts = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("__n"))
    heavy = counts.where((F.col("__n") * F.lit(share) > F.lit(total)) & ~_any_null(keys))
    return durable(heavy.select(*keys), "heavy")


def heavy_hashes(df: DataFrame, keysets: Sequence[Sequence[str]], share: int = HEAVY_SHARE) -> list[list[int]]:
    """For each set of key columns the ``xxhash64`` of keys that hold more than 1/``share`` of all rows.

    One pass over the key columns serves all sets: frequent-item sketches of bounded size (ten counters for each key
    asked) are merged, so nothing is shuffled by key and at most ``share`` hashes a set reach the driver. A key missed
    or named too much costs balance, never rows.
    """
    if not keysets:
        return []
    hashed = df.select(*[F.xxhash64(*keys).alias(f"k{i}") for i, keys in enumerate(keysets)])
    found = hashed.agg(F.count(F.lit(1)).alias("n"), *[
        F.expr(f"approx_top_k(k{i}, {share}, {10 * share})").alias(f"k{i}") for i in range(len(keysets))]).first()
    return [[r["item"] for r in found[f"k{i}"] or [] if r["count"] * share > found["n"]] for i in range(len(keysets))]


def row_hash(df: DataFrame) -> Column:
    """A hash of all columns that can be hashed."""
    plain = [f.name for f in df.schema.fields if "map<" not in f.dataType.simpleString()
             and "variant" not in f.dataType.simpleString()]
    return F.xxhash64(*[F.col(f"`{c}`") for c in plain])


def salted_star_join(fact: DataFrame, dims: Sequence[tuple[DataFrame, Sequence[str] | str]], how: str = "inner",
                     share: int = HEAVY_SHARE, salts: int = SALTS, null_safe: bool = False,
                     heavy: Sequence[Sequence[int]] | None = None) -> DataFrame:
    """Fact joined to any number of dimensions, each unique on its key columns, with keys of any skew.

    The fact is read once by the join, and its key columns once before, to find heavy keys (``heavy``: their hashes, if
    known). Rows of a heavy key, and rows whose key holds a NULL and so finds nothing, are dealt over ``salts`` parts by
    their keys and the partition of the bare fact they come from, so no column is read for it and a task that runs again
    deals its rows the same way; the fewer than ``share`` dimension rows they look for stand in every part. With
    ``null_safe`` NULL equals NULL. Key columns have one type on both sides.
    """
    if how not in ("inner", "left"):
        raise ValueError("salted_star_join supports inner and left")
    sets = [[on] if isinstance(on, str) else list(on) for _, on in dims]
    for (dim, _), on in zip(dims, sets, strict=True):
        other = [c for c in on if dim.schema[c].dataType != fact.schema[c].dataType]
        if other:
            raise ValueError(f"key columns {other} have another type in the lookup side; cast one of them")
    heavy = heavy_hashes(fact, sets, share) if heavy is None else heavy
    names = list(fact.columns)
    part = F.pmod(F.xxhash64(F.spark_partition_id(), *dict.fromkeys(c for on in sets for c in on)), F.lit(salts)).cast("int")
    out = fact.select("*", *[
        F.when(F.xxhash64(*on).isin(*some) | (F.lit(False) if null_safe else _any_null(on)), part).otherwise(0).alias(f"__salt{i}")
        for i, (on, some) in enumerate(zip(sets, heavy, strict=True))])
    for i, ((dim, _), on, some) in enumerate(zip(dims, sets, heavy, strict=True)):
        copies = F.when(F.xxhash64(*on).isin(*some), F.sequence(F.lit(0), F.lit(salts - 1))).otherwise(F.array(F.lit(0)))
        side = dim.withColumn(f"__salt{i}", F.explode(copies))
        key = [*on, f"__salt{i}"]
        if null_safe:
            # Structs compare NULL fields as equal, so one struct key does what several null-safe ones would.
            side, key = side.withColumn("__key", F.struct(*on)).drop(*on), ["__key", f"__salt{i}"]
            out = out.withColumn("__key", F.struct(*on))
        new = [c for c in dim.columns if c not in on]
        out = out.join(side, key, how).select(*names, *new, *[f"__salt{j}" for j in range(i + 1, len(dims))])
        names += new
    return out.select(*names)


def lookup_join(left: DataFrame, right: DataFrame, on: Sequence[str] | str, how: str = "inner",
                skewed: bool = False, heavy: DataFrame | None = None, share: int = HEAVY_SHARE,
                small_rows: int = SMALL_ROWS, null_safe: bool = False) -> DataFrame:
    """Equi-join of many rows to a side that is unique on the key.

    Without ``skewed`` this is a plain join: Spark broadcasts the right side when its size allows, else
    shuffles and splits skewed partitions at run time. With ``skewed``, a right side that proves small
    is broadcast. Beyond that, rows of heavy keys (``heavy`` if already known) are salted as in
    :func:`salted_star_join`. All ways give the same rows. With ``null_safe`` NULL equals NULL.
    """
    on = [on] if isinstance(on, str) else list(on)
    if how not in ("inner", "left"):
        raise ValueError("lookup_join supports inner and left")
    small = skewed and small_rows and is_small(right, small_rows)
    if skewed and not small:
        known = None if heavy is None else [[r[0] for r in heavy.select(F.xxhash64(*on)).collect()]]
        out = salted_star_join(left, [(right, on)], how, share, null_safe=null_safe, heavy=known)
        return out.select(*on, *[c for c in out.columns if c not in on])
    if null_safe:
        # As in missing_from: one struct key, never NULL itself.
        key = F.struct(*on)
        right = right.withColumn("__key", key).drop(*on)
        out = left.withColumn("__key", key).join(F.broadcast(right) if small else right, "__key", how)
        return out.select(*on, *[c for c in out.columns if c not in ("__key", *on)])
    return left.join(F.broadcast(right) if small else right, on, how)


def star_join(fact: DataFrame, dims: Sequence[tuple[DataFrame, Sequence[str] | str]],
              how: str = "inner", skewed: bool = False) -> DataFrame:
    """Fact joined to several dimensions, each unique on its key columns; ``skewed`` as in :func:`salted_star_join`."""
    if skewed:
        return salted_star_join(fact, dims, how)
    out = fact
    for dim, on in dims:
        out = lookup_join(out, dim, on, how)
    return out


def outer_join(left: DataFrame, right: DataFrame, on: Sequence[str]) -> DataFrame:
    """Full outer equi-join whose rows with a NULL in the key, which find no partner, are dealt over all partitions by
    their content in place of meeting in one."""
    def dealt(side: DataFrame) -> DataFrame:
        return side.withColumn("__deal", F.when(_any_null(on), row_hash(side)).otherwise(F.lit(0)))
    return dealt(left).join(dealt(right), [*on, "__deal"], "full_outer").drop("__deal")


def missing_from(left: DataFrame, right: DataFrame, on: Sequence[str], null_safe: bool = False,
                 ) -> DataFrame:
    """Rows of ``left`` without a partner in ``right`` (NOT EXISTS).

    As in SQL, a NULL key has no partner; with ``null_safe`` NULL equals NULL.
    """
    if not null_safe:
        return left.join(right.select(*on).distinct(), list(on), "left_anti")
    # Structs compare NULL fields as equal, so one struct key does what several null-safe ones would.
    keys = right.select(F.struct(*on).alias("__key")).distinct()
    return left.withColumn("__key", F.struct(*on)).join(keys, "__key", "left_anti").drop("__key")


def cross_values(df: DataFrame, column: str, values: Sequence) -> DataFrame:
    """Each row once per listed value: a cross join with an inline list, done in place."""
    return df.withColumn(column, F.explode(F.array(*[F.lit(v) for v in values])))
