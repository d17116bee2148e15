"""A zone map: the least and greatest key of each file, so that a lookup by key reads only files that can hold it."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pipekit.operators.joins import missing_from
from pipekit.sinks.files import path_exists
from pipekit.sinks.writers import write_counted
from pipekit.sources.provenance import inventory, source_path

RANGES = 1000


@dataclass(frozen=True)
class ZoneMap:
    """Zones of a Parquet folder by one column, kept as a small table at ``path``.

    Files are known by path, length and change time. A zone row without its file is never used, and a file without a
    zone row is read in any case, so an old map costs time and never rows.
    """

    spark: SparkSession
    folder: str
    path: str
    column: str

    def _files(self) -> DataFrame:
        return inventory(self.spark, self.folder, "*.parquet").select("path", "length", "modified")

    def _zones(self) -> DataFrame:
        if path_exists(self.spark, self.path):
            return self.spark.read.parquet(self.path)
        kind = self.spark.read.parquet(self.folder).schema[self.column].dataType
        schema = T.StructType(self._files().schema.fields + [T.StructField(c, kind) for c in ("lo", "hi")])
        return self.spark.createDataFrame([], schema)

    def refresh(self) -> int:
        """Add zones of files that have none; only those files are scanned, and of them only the column. Gives their
        number."""
        if not path_exists(self.spark, self.folder):
            return 0
        fresh = missing_from(self._files(), self._zones(), ["path", "length", "modified"])
        paths = [r["path"] for r in fresh.select("path").collect()]  # a file list, as every Spark read makes on the driver
        if not paths:
            return 0
        keys = self.spark.read.parquet(*paths).select(F.col(self.column).alias("key"), source_path().alias("path"))
        span = keys.groupBy("path").agg(F.min("key").alias("lo"), F.max("key").alias("hi"))
        # A file without rows has no span and holds nothing.
        return write_counted(fresh.join(span, "path", "left").select("path", "length", "modified", "lo", "hi"), self.path, "append")

    def files_for(self, ids: DataFrame, ranges: int = RANGES) -> list[str]:
        """Files that can hold one of the ids (column as the map's). The ids are summed up as at most ``ranges`` runs
        in key order, and a file is named if its zone meets one."""
        runs = (ids.select(F.col(self.column).alias("id")).where("id is not null").repartitionByRange(ranges, "id")
                .groupBy(F.spark_partition_id()).agg(F.min("id").alias("a"), F.max("id").alias("b")).select("a", "b").collect())
        if not runs:
            return []
        kind = ids.schema[self.column].dataType
        spans = F.array(*[F.struct(F.lit(r["a"]).cast(kind).alias("a"), F.lit(r["b"]).cast(kind).alias("b")) for r in runs])
        zones = self._files().join(self._zones().withColumn("known", F.lit(True)), ["path", "length", "modified"], "left")
        meets = F.exists(spans, lambda r: (r["a"] <= F.col("hi")) & (r["b"] >= F.col("lo")))
        return sorted({r["path"] for r in zones.where(F.col("known").isNull() | meets).select("path").collect()})

    def missing(self, staged: DataFrame, on: Sequence[str]) -> DataFrame:
        """Staged rows whose ``on`` columns (the map's among them) are not in the folder yet."""
        if not path_exists(self.spark, self.folder):
            return staged
        files = self.files_for(staged)
        if not files:
            return staged
        return missing_from(staged, self.spark.read.parquet(*files), on)
