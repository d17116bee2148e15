"""Write modes, staged replacement and exports."""

from __future__ import annotations

import re
from collections.abc import Callable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pipekit.functions.text import is_safe_name
from pipekit.operators.joins import broadcast_if_small
from pipekit.session import durable, working_tables
from pipekit.sinks.files import delete_path, list_files, make_dirs, path_exists, rename
from pipekit.sources.formats import FileFormat

MODES = ("overwrite", "append", "error", "errorifexists", "ignore")
LAYOUTS = ("file", "parts")


def write(df: DataFrame, path: str, mode: str = "error", kind: str = "parquet",
          fmt: FileFormat = FileFormat(), partition_by: Sequence[str] = ()) -> None:
    """Save with one of the write modes."""
    if mode not in MODES:
        raise ValueError(f"mode must be one of {MODES}")
    writer = df.write.mode(mode)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if kind == "csv":
        writer = writer.options(**fmt.writer_options())
    writer.format(kind).save(path)


def replace(df: DataFrame, path: str, kind: str = "parquet", fmt: FileFormat = FileFormat(),
            partition_by: Sequence[str] = (), check: Callable[[DataFrame], bool] | None = None) -> None:
    """Replace a folder by ``df``, which may read that very folder.

    The new rows go to a sibling folder first; the old folder is kept until the swap is done, and
    :func:`recover` brings it back after a crash in between.
    """
    spark, path = df.sparkSession, path.rstrip("/")
    recover(spark, path)
    fresh, old = f"{path}__new", f"{path}__old"
    write(df, fresh, "overwrite", kind, fmt, partition_by)
    if check is not None:
        reader = spark.read.options(**fmt.reader_options()) if kind == "csv" else spark.read
        if not check(reader.format(kind).load(fresh)):
            raise ValueError(f"check of the new content of {path} failed; the old one stays")
    if path_exists(spark, path):
        rename(spark, path, old)
    rename(spark, fresh, path)
    delete_path(spark, old)


def recover(spark: SparkSession, path: str) -> None:
    """Finish or undo a swap that was cut short."""
    path = path.rstrip("/")
    if path_exists(spark, f"{path}__old"):
        if path_exists(spark, path):
            delete_path(spark, f"{path}__old")
        else:
            rename(spark, f"{path}__old", path)


def rewrite_partitions(spark: SparkSession, path: str, partition_by: Sequence[str], touched: DataFrame,
                       change: Callable[[DataFrame], DataFrame], schema: T.StructType | None = None) -> None:
    """Apply ``change`` to the partitions listed in ``touched`` and leave all others alone.

    Only those partitions are read (pruned by the values) and overwritten. The result is written to the
    shared folder first, so the table is never read and replaced by one job. ``change`` must keep rows
    inside the touched partitions; a partition that ends up empty is removed. ``schema`` is the table's
    where it does not exist yet and ``touched`` does not have all its columns.
    """
    with working_tables(spark):
        _rewrite(spark, path, list(partition_by), touched, change, schema)


def _rewrite(spark: SparkSession, path: str, partition_by: list[str], touched: DataFrame,
             change: Callable[[DataFrame], DataFrame], schema: T.StructType | None) -> None:
    values = durable(touched.select(*partition_by).distinct(), "touched")
    if not values.where(" or ".join(f"`{c}` is null" for c in partition_by)).isEmpty():
        raise ValueError("a partition column is NULL in the touched rows")
    if path_exists(spark, path):
        # Folder names alone do not tell '01' from 1, so the touched rows give the partition types.
        types = {c: touched.schema[c].dataType for c in partition_by}
        have = spark.read.parquet(path).schema
        typed = T.StructType([T.StructField(f.name, types.get(f.name, f.dataType)) for f in have.fields])
        table = spark.read.schema(typed).parquet(path)
        rows = table.join(broadcast_if_small(values), partition_by, "left_semi")
    else:
        rows = spark.createDataFrame([], schema or touched.schema)
    result = durable(change(rows), "rewritten")
    (result.hint("rebalance", *partition_by).write.mode("overwrite")
     .option("partitionOverwriteMode", "dynamic").partitionBy(*partition_by).parquet(path))
    emptied = values.join(result.select(*partition_by).distinct(), partition_by, "left_anti")
    # As text in Spark's own form, which the folder names have too.
    for row in emptied.select([F.col(c).cast("string").alias(c) for c in partition_by]).toLocalIterator():
        delete_path(spark, "/".join([path.rstrip("/"), *[f"{c}={_folder_value(row[c])}" for c in partition_by]]))


def _folder_value(value) -> str:
    """A partition value as its folder name shows it."""
    return re.sub(r"[\x00-\x1f\x7f\"#%'*/:=?\\{\[\]^]", lambda m: f"%{ord(m.group()):02X}", str(value))


def accumulate(df: DataFrame, path: str, kind: str = "csv", fmt: FileFormat = FileFormat(),
               single_file: bool = True) -> None:
    """Old output plus new rows by column name, rewritten as one file set.

    Rewrites everything on each call; ``write(mode="append")`` is the cheap way to add rows. With
    ``single_file`` one task writes all rows, so large outputs should be called without.
    """
    spark = df.sparkSession
    recover(spark, path)
    if path_exists(spark, path) and list_files(spark, path):
        old = _read_back(spark, path, kind, fmt, df.schema)
        df = old.unionByName(df)
    if single_file:
        df = df.coalesce(1)
    replace(df, path, kind, fmt)


def _read_back(spark: SparkSession, path: str, kind: str, fmt: FileFormat, schema: T.StructType) -> DataFrame:
    """Earlier output with the types of the new rows; columns are found by name."""
    if kind != "csv":
        return spark.read.format(kind).load(path)
    reader = spark.read.options(**fmt.reader_options())
    if not fmt.header:
        return reader.schema(schema).csv(path)
    text = reader.csv(path)
    types = {f.name: f.dataType for f in schema.fields}
    return text.select(*[F.col(f"`{c}`").cast(types.get(c, T.StringType())).alias(c) for c in text.columns])


def save_table(df: DataFrame, name: str, mode: str = "errorifexists", path: str | None = None) -> None:
    """CREATE TABLE AS SELECT; fails when the table exists unless told otherwise."""
    writer = df.write.mode(mode).format("parquet")
    (writer.option("path", path) if path else writer).saveAsTable(name)


def append_rows(df: DataFrame, path: str) -> None:
    """INSERT … SELECT with a strict by-name check against what is there."""
    spark = df.sparkSession
    if path_exists(spark, path):
        have = spark.read.parquet(path)
        want = [(f.name, f.dataType) for f in have.schema.fields]
        got = {f.name: f.dataType for f in df.schema.fields}
        if [(n, got.get(n)) for n, _ in want] != want or len(got) != len(want):
            raise ValueError(f"schema drift: have {have.schema.simpleString()}, got {df.schema.simpleString()}")
        df = df.select(*have.columns)
    df.write.mode("append").parquet(path)


def reload(df: DataFrame, path: str) -> None:
    """Truncate and load a staging folder."""
    df.write.mode("overwrite").parquet(path)


def write_counted(df: DataFrame, path: str, mode: str = "overwrite", partition_by: Sequence[str] = ()) -> int:
    """Write Parquet and give the number of rows, observed by the tasks that wrote them; nothing is read back.

    The count is taken in the last stage, where a task counts once however often it runs.
    """
    seen = Observation()
    writer = df.observe(seen, F.count(F.lit(1)).alias("rows")).write.mode(mode)
    (writer.partitionBy(*partition_by) if partition_by else writer).parquet(path)
    return seen.get["rows"]


def load_targets(df: DataFrame, targets: Mapping[str, tuple[str, Sequence[str]]], mode: str = "append",
                 keep: bool = False) -> None:
    """One row set into several targets: ``{name: (path, columns)}``.

    Each target scans only its own columns of a columnar staging table. ``keep`` holds the rows on the
    executors instead, for a row set that is costly to compute.
    """
    df = df.persist() if keep else df
    try:
        for path, columns in targets.values():
            df.select(*columns).write.mode(mode).parquet(path)
    finally:
        if keep:
            df.unpersist()


@dataclass(frozen=True)
class Export:
    """One export: rows, place, optional projection and filter."""

    df: DataFrame
    path: str
    columns: Sequence[str] | None = None
    where: Column | None = None


def export(df: DataFrame, path: str, fmt: FileFormat = FileFormat(header=False),
           columns: Sequence[str] | None = None, where: Column | None = None, clear: bool = False) -> None:
    """Unload to delimited files, in parallel. Refuses a folder that has files unless ``clear``."""
    out = df if where is None else df.where(where)
    out = out if columns is None else out.select(*columns)
    write(out, path, "overwrite" if clear else "errorifexists", "csv", fmt)
    _drop_empty_first(df.sparkSession, path, fmt)


def _drop_empty_first(spark: SparkSession, path: str, fmt: FileFormat) -> None:
    """Spark's first task writes a file even without rows, others do not; beside files with rows it is no empty export.

    Lines are counted, not parsed rows, so whatever a scan would skip stays.
    """
    files = list_files(spark, path)
    for first in [f for f in files if "/part-00000-" in f and len(files) > 1]:
        if spark.read.text(first).limit(2).count() <= int(fmt.header):
            delete_path(spark, first)


def export_many(exports: Mapping[str, Export], fmt: FileFormat = FileFormat(), clear: bool = False,
                parallel: int = 4) -> list[str]:
    """Several exports, each to its own place, a few at a time."""
    def one(item: Export) -> str:
        export(item.df, item.path, fmt, item.columns, item.where, clear)
        return item.path
    with ThreadPoolExecutor(max_workers=parallel) as pool:
        return list(pool.map(one, exports.values()))


def export_under(tables: Mapping[str, DataFrame], root: str, fmt: FileFormat = FileFormat(),
                 clear: bool = False) -> list[str]:
    """One sub-folder per table below a root."""
    return export_many({n: Export(df, f"{root.rstrip('/')}/{n}") for n, df in tables.items()}, fmt, clear)


def export_named(df: DataFrame, folder: str, name: str, fmt: FileFormat = FileFormat(),
                 layout: str = "file") -> str:
    """A file with a given name, replacing an earlier one.

    The caller names the layout: ``file`` is one file, written by one task; ``parts`` is a folder of that
    name with part files, for results too large for a task.
    """
    if layout not in LAYOUTS:
        raise ValueError(f"layout must be one of {LAYOUTS}")
    if not is_safe_name(name):
        raise ValueError(f"unsafe file name: {name!r}")
    spark, target = df.sparkSession, f"{folder.rstrip('/')}/{name}"
    fresh = f"{folder.rstrip('/')}/_{name}.parts"
    single = layout == "file"
    write(df.coalesce(1) if single else df, fresh, "overwrite", "csv", fmt)
    make_dirs(spark, folder)
    if path_exists(spark, target):
        delete_path(spark, target)
    if single:
        parts = [f for f in list_files(spark, fresh) if "/part-" in f]
        rename(spark, parts[0], target)
        delete_path(spark, fresh)
    else:
        rename(spark, fresh, target)
    return target


def stamped_name(prefix: str, as_of, ext: str = ".csv") -> str:
    """``prefix_20240131_235959.csv`` for a given run time."""
    return f"{prefix}_{as_of:%Y%m%d_%H%M%S}{ext}"


def export_check(spark: SparkSession, path: str, fmt: FileFormat = FileFormat()) -> DataFrame:
    """Exported files with size and row count; a file without rows is flagged."""
    from pipekit.sources.provenance import inventory, source_path
    files = inventory(spark, path)
    rows = (spark.read.options(**fmt.reader_options()).option("recursiveFileLookup", True).csv(path)
            .select(source_path().alias("path")).groupBy("path")
            .agg(F.count(F.lit(1)).alias("row_count")))
    return files.join(rows, "path", "left").select("file_name", "length", F.coalesce("row_count", F.lit(0)).alias("row_count"),
                         F.when(F.coalesce("row_count", F.lit(0)) == 0, F.lit("EMPTY"))
                         .otherwise(F.lit("OK")).alias("status"))
