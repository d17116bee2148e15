"""Where a row came from: file, position, change time, content key."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from pipekit.functions.text import plain_path
from pipekit.sinks.files import path_exists


def source_file() -> Column:
    """Name of the file a scanned row comes from."""
    return plain_path("_metadata.file_name")


def source_path() -> Column:
    """Full path of the file a scanned row comes from."""
    return plain_path("_metadata.file_path")


def with_source_file(df: DataFrame) -> DataFrame:
    """File name and change time of each scanned row."""
    return df.select("*", source_file().alias("source_file"),
                     F.col("_metadata.file_modification_time").cast("timestamp_ntz").alias("file_modified"))


def number_rows(scan: DataFrame, first: int, first_row: Column | None = None) -> DataFrame:
    """``row_in_file`` for a text scan with ``__file`` and ``__block``.

    Each file split numbers its own lines, and the line counts of the splits before it are added, so a file of any size
    is numbered in place: lines are not shuffled and one summary row for each split moves. Lines must come straight
    from a text scan, which drops none. ``first_row`` adds a column of that name, the place of the file's first line
    for which it holds.
    """
    rows = scan.withColumn("__id", F.monotonically_increasing_id())
    file = Window.partitionBy("__file")
    earlier = file.orderBy("__block").rowsBetween(Window.unboundedPreceding, -1)
    found = F.lit(None).cast("bigint") if first_row is None else F.min(F.when(first_row, F.col("__id")))
    splits = (rows.groupBy("__file", "__block")
              .agg(F.min("__id").alias("__start"), F.count(F.lit(1)).alias("__rows"), found.alias("__found"))
              .withColumn("__before", F.coalesce(F.sum("__rows").over(earlier), F.lit(0)))
              .drop("__rows"))
    place = F.col("__before") - F.col("__start") + F.lit(first)
    extra = []
    if first_row is not None:
        splits = splits.withColumn("first_row", F.min(place + F.col("__found")).over(file))
        extra = ["first_row"]
    return (rows.join(splits.drop("__found"), ["__file", "__block"])
            .withColumn("row_in_file", place + F.col("__id"))
            .select(*[c for c in scan.columns if c not in ("__file", "__block")], "row_in_file", *extra))


def inventory(spark: SparkSession, path: str | Sequence[str], glob: str | None = None,
              recursive: bool = True) -> DataFrame:
    """Files of a stage: path, name, size, change time. File contents are not read."""
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", recursive)
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    files = reader.load(path if isinstance(path, str) else list(path))
    return files.select(source_path().alias("path"), F.substring_index("path", "/", -1).alias("file_name"), "length",
                        F.col("modificationTime").cast("timestamp_ntz").alias("modified"))


def content_keys(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    """A key per file that changes with its content, the same way for files of every size.

    Each line is hashed with its position, and the splits of a file add their hashes up, so no task holds
    a whole file and the order of lines counts. Empty files are not listed, as in any Spark scan.
    """
    files = inventory(spark, path).select("path", "length")
    scan = spark.read.option("recursiveFileLookup", True).text(path if isinstance(path, str) else list(path)).select(
        "*", source_path().alias("path"), F.col("_metadata.file_path").alias("__file"),
        F.col("_metadata.file_block_start").alias("__block"))
    lines = number_rows(scan, 1).select(
        "path", *[F.xxhash64("row_in_file", "value", F.lit(seed)).cast("decimal(38,0)").alias(f"h{seed}") for seed in (1, 2)])
    sums = lines.groupBy("path").agg(F.count(F.lit(1)).alias("n"), F.sum("h1").alias("h1"), F.sum("h2").alias("h2"))
    return files.join(sums, "path", "left").select("path", F.md5(F.concat_ws(
        ":", "length", "n", "h1", "h2").cast("binary")).alias("content_key"))


def rows_per_file(df: DataFrame) -> DataFrame:
    """Record count per input file."""
    return (df.select(source_file().alias("source_file"))
            .groupBy("source_file").agg(F.count(F.lit(1)).alias("row_count")))


@dataclass(frozen=True)
class ContentIndex:
    """Content keys that outlast a run, kept at ``path`` by file path, length and change time.

    A run scans only files it has not seen as they are now. Keys are added, never changed, so a run that is cut short
    and begun again adds the same rows; the last ones found are as good as the first.
    """

    spark: SparkSession
    folder: str
    path: str

    def _known(self) -> DataFrame:
        if path_exists(self.spark, self.path):
            return self.spark.read.parquet(self.path)
        return self.spark.createDataFrame([], "path string, length bigint, modified timestamp_ntz, content_key string")

    def refresh(self) -> int:
        """Scan files without a key and save theirs; gives their number."""
        files = inventory(self.spark, self.folder).select("path", "length", "modified")
        fresh = files.join(self._known(), ["path", "length", "modified"], "left_anti")
        paths = [r["path"] for r in fresh.select("path").collect()]  # a file list, as every Spark read makes on the driver
        if paths:
            keys = content_keys(self.spark, paths)
            fresh.join(keys, "path").select("path", "length", "modified", "content_key").write.mode("append").parquet(self.path)
        return len(paths)

    def keys(self) -> DataFrame:
        """(path, content_key) of the files that are there now."""
        self.refresh()
        files = inventory(self.spark, self.folder).select("path", "length", "modified")
        known = self._known().groupBy("path", "length", "modified").agg(F.min("content_key").alias("content_key"))
        return files.join(known, ["path", "length", "modified"]).select("path", "content_key")
