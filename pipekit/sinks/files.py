"""Small file-system calls through Hadoop, so any store that Spark can reach works."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    where = jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), where


def path_exists(spark: SparkSession, path: str) -> bool:
    fs, where = _fs(spark, path)
    return fs.exists(where)


def delete_path(spark: SparkSession, path: str) -> bool:
    fs, where = _fs(spark, path)
    return fs.delete(where, True)


def make_dirs(spark: SparkSession, path: str) -> None:
    fs, where = _fs(spark, path)
    fs.mkdirs(where)


def rename(spark: SparkSession, source: str, target: str) -> None:
    fs, where = _fs(spark, source)
    if not fs.rename(where, spark.sparkContext._jvm.org.apache.hadoop.fs.Path(target)):
        raise OSError(f"cannot rename {source} to {target}")


def list_files(spark: SparkSession, path: str) -> list[str]:
    """Visible files directly in a folder, in name order. For folders of a size Spark itself lists."""
    fs, where = _fs(spark, path)
    if not fs.exists(where):
        return []
    names = [s.getPath().toString() for s in fs.listStatus(where) if s.isFile()]
    return sorted(n for n in names if not n.rsplit("/", 1)[-1].startswith(("_", ".")))


def list_dirs(spark: SparkSession, path: str) -> list[str]:
    """Visible sub-folders, in name order."""
    fs, where = _fs(spark, path)
    if not fs.exists(where):
        return []
    names = [s.getPath().toString() for s in fs.listStatus(where) if s.isDirectory()]
    return sorted(n for n in names if not n.rsplit("/", 1)[-1].startswith(("_", ".")))


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """A small marker or pointer file; readers see the old content or the new, never a part."""
    fs, where = _fs(spark, path)
    folder, name = path.rsplit("/", 1)
    part = f"{folder}/_{name}.part"
    out = fs.create(_fs(spark, part)[1], True)
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()
    jvm = spark.sparkContext._jvm
    kind = getattr(jvm.org.apache.hadoop.fs, "Options$Rename")
    options = spark.sparkContext._gateway.new_array(kind, 1)
    options[0] = kind.OVERWRITE
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(
        where.toUri(), spark.sparkContext._jsc.hadoopConfiguration())
    context.rename(_fs(spark, part)[1], where, options)  # one step: there is no moment without the file


def _remove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    from pyarrow import fs
    for batch in batches:
        gone = 0
        for path in batch.column("path").to_pylist():
            store, where = fs.FileSystem.from_uri(path.replace("s3a://", "s3://", 1)) if "://" in path else (
                fs.LocalFileSystem(), path.removeprefix("file:"))
            if store.get_file_info(where).type != fs.FileType.NotFound:
                store.delete_file(where)
                gone += 1
        yield pa.RecordBatch.from_arrays([pa.array([gone], pa.int64())], names=["gone"])


def remove_files(paths: DataFrame) -> int:
    """Delete the files of a column ``path`` in tasks; gives how many were there. Files already gone are no error, so a
    task may run again."""
    from pyspark.sql import functions as F
    done = paths.select("path").distinct().mapInArrow(_remove, "gone bigint")
    return done.agg(F.coalesce(F.sum("gone"), F.lit(0))).first()[0]
