"""Dimension and fact builders."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from contextvars import copy_context
from dataclasses import dataclass
from functools import partial

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pipekit.operators.joins import lookup_join, missing_from, salted_star_join
from pipekit.operators.keys import append_keys, coded_keys
from pipekit.operators.merge import assert_unique


def side_by_side(builds: Mapping[str, Callable[[], DataFrame]], parallel: int = 4) -> dict[str, DataFrame]:
    """Run independent builds a few at a time, so that one fills the executors the other leaves idle."""
    with ThreadPoolExecutor(max_workers=parallel) as pool:
        # Each build runs in a copy of this thread's context, so its working tables belong to the caller's block.
        futures = {name: pool.submit(copy_context().run, build) for name, build in builds.items()}
        return {name: future.result() for name, future in futures.items()}


def distinct_members(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Distinct attribute rows."""
    return df.select(*columns).distinct()


def new_members(staged: DataFrame, dimension: DataFrame, columns: Sequence[str],
                null_safe: bool = False) -> DataFrame:
    """Members of the staged rows that the dimension lacks.

    With plain SQL equality a member with a NULL column counts as new on every run; ``null_safe``
    avoids that.
    """
    return missing_from(distinct_members(staged, columns), dimension, columns, null_safe)


def load_dimension(staged: DataFrame, columns: Sequence[str], key: str,
                   existing: DataFrame | None = None, only_new: bool = True,
                   null_safe: bool = True) -> DataFrame:
    """Rows to append: new members with the next surrogate keys, in the order of their columns.

    ``only_new=False`` appends every distinct member again, as a run-once load does.
    """
    if existing is not None and only_new:
        members = new_members(staged, existing, columns, null_safe)
    else:
        members = distinct_members(staged, columns)
    return append_keys(members, existing, columns, key).select(key, *columns)


@dataclass(frozen=True)
class DimensionSpec:
    """A coded dimension over one column of a flat table."""

    name: str
    column: str
    code: str
    prefix: str
    width: int = 2


def dimensions_from_flat(flat: DataFrame, specs: Sequence[DimensionSpec],
                         ) -> dict[str, DataFrame]:
    """One coded dimension per spec, built side by side."""
    return side_by_side({s.name: partial(coded_keys, flat, s.column, s.prefix, s.code, s.width) for s in specs})


def fact_from_flat(flat: DataFrame, dims: Mapping[str, DataFrame], specs: Sequence[DimensionSpec],
                   columns: Sequence[str]) -> DataFrame:
    """Fact rows with the dimension codes in place of the descriptive columns; a value without a
    member keeps its row with a NULL code."""
    out = flat
    for spec in specs:
        out = lookup_join(out, dims[spec.name], spec.column, "left")
    return out.select(*columns, *[s.code for s in specs])


def load_fact(staged: DataFrame, lookups: Sequence[tuple[DataFrame, Sequence[str]]],
              columns: Mapping[str, Column], existing: DataFrame | None = None,
              on: Sequence[str] = (), how: str = "inner", skewed: bool = False,
              check: bool = True, null_safe: bool = False) -> DataFrame:
    """Fact rows by key lookups. With ``existing``, rows whose ``on`` columns are already there are
    left out before the lookups, so a second run adds nothing. ``null_safe`` finds members with NULL
    columns too, as :func:`load_dimension` adds them. ``skewed`` reads the rows once for all lookups, whatever share
    of them a member holds."""
    rows = staged if existing is None else missing_from(staged, existing, on)
    for dim, keys in lookups:
        if check:
            # A struct is never NULL itself, so members with NULL columns are checked too where they can be found.
            assert_unique(dim.select(F.struct(*keys).alias("key")) if null_safe else dim,
                          ["key"] if null_safe else keys, "lookup side")
        if not skewed:
            rows = lookup_join(rows, dim, keys, how, null_safe=null_safe)
    if skewed:
        rows = salted_star_join(rows, lookups, how, null_safe=null_safe)
    return rows.select(*[c.alias(name) for name, c in columns.items()])
