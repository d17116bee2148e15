"""Projection helpers: bands, mappings, classification, nested fields."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pipekit.functions.text import _col


def band(value: Column | str, limits: Sequence[tuple[float, str]], default: str) -> Column:
    """First label whose lower limit the value reaches; NULL and lower values get ``default``.

    ``limits`` run from high to low, for example ``[(100000, "HIGH"), (70000, "MEDIUM")]``.
    """
    lows = [low for low, _ in limits]
    if lows != sorted(lows, reverse=True):
        raise ValueError("band limits must run from high to low")
    value = _col(value)
    out = F.lit(default)
    for low, label in reversed(limits):
        out = F.when(value >= F.lit(low), F.lit(label)).otherwise(out)
    return out


def map_values(value: Column | str, mapping: Mapping[str, str]) -> Column:
    """Replace listed values, pass others through."""
    value = _col(value)
    out = value
    for old, new in mapping.items():
        out = F.when(value == F.lit(old), F.lit(new)).otherwise(out)
    return out


def classify(value: Column | str, cut: float, above: str = "PASS", below: str = "FAIL", *,
             inclusive: bool) -> Column:
    """Two-way split on a cut-off; ``inclusive`` decides about the cut-off itself."""
    value = _col(value)
    hit = value >= F.lit(cut) if inclusive else value > F.lit(cut)
    return F.when(hit, F.lit(above)).otherwise(F.lit(below))


def mark_status(df: DataFrame, status: str = "PROCESSED", column: str = "status") -> DataFrame:
    """Stamp every row with a status."""
    return df.withColumn(column, F.lit(status))


def rename_by_position(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """Name all columns by position."""
    return df.toDF(*names)


def pick(df: DataFrame, columns: Mapping[str, str]) -> DataFrame:
    """Select and rename: ``{"out": "a.b"}``."""
    return df.select(*[F.col(path).alias(name) for name, path in columns.items()])


def flatten(df: DataFrame, sep: str = "_") -> DataFrame:
    """Every struct field at any depth as a top-level column; arrays and maps stay whole.

    A field keeps its own name when that is unique, else the joined path.
    """
    leaves: list[tuple[list[str], T.DataType]] = []

    def walk(schema: T.StructType, path: list[str]) -> None:
        for field in schema.fields:
            if isinstance(field.dataType, T.StructType):
                walk(field.dataType, path + [field.name])
            else:
                leaves.append((path + [field.name], field.dataType))

    walk(df.schema, [])
    last = [path[-1] for path, _ in leaves]
    columns = []
    for path, _ in leaves:
        name = path[-1] if last.count(path[-1]) == 1 else sep.join(path)
        columns.append(F.col(".".join(f"`{p}`" for p in path)).alias(name))
    return df.select(*columns)


def schema_rows(df: DataFrame) -> DataFrame:
    """The schema as data: position, name, type and nullability of each column."""
    rows = [(i, f.name, f.dataType.simpleString(), f.nullable) for i, f in enumerate(df.schema.fields, 1)]
    return df.sparkSession.createDataFrame(rows, "position int, name string, type string, nullable boolean")
