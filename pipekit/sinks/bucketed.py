"""Tables laid out by key, so that merges into them meet the target where it lies."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pipekit.operators.merge import upsert
from pipekit.sinks.files import delete_path, list_dirs


@dataclass(frozen=True)
class BucketedTable:
    """A catalogue table bucketed and sorted by its keys, and beside it the rows with a NULL in a key.

    Those rows equal no other row, so no merge looks at them: they stay out of the buckets, where they would all share
    one, and lie in files of any number. Each save is a version: ``root/keyed-v…`` and ``root/unkeyed/v=…`` are
    written first, then the table is pointed to the version in one step; what an interrupted save left is written
    over by the next.
    """

    spark: SparkSession
    name: str
    root: str
    keys: Sequence[str]
    buckets: int = 200

    def _nulls(self) -> Column:
        return reduce(lambda a, b: a | b, [F.col(k).isNull() for k in self.keys])

    def version(self) -> int:
        """The version the table points to; 0 before the first save."""
        if not self.spark.catalog.tableExists(self.name):
            return 0
        rows = self.spark.sql(f"DESCRIBE TABLE EXTENDED {self.name}").where("col_name = 'Location'").first()
        return int(rows["data_type"].rsplit("-v", 1)[-1])

    def _keyed(self, version: int) -> str:
        return f"{self.root.rstrip('/')}/keyed-v{version:06d}"

    def _unkeyed(self, version: int) -> str:
        return f"{self.root.rstrip('/')}/unkeyed/v={version:06d}"

    def keyed(self) -> DataFrame:
        """Rows with whole keys, as they lie in the buckets."""
        return self.spark.table(self.name)

    def read(self) -> DataFrame:
        """All rows of the current version."""
        last = self._unkeyed(self.version())
        made = list_dirs(self.spark, last.rsplit("/", 1)[0])
        folders = [f for f in made if f.rsplit("/", 1)[-1] <= last.rsplit("/", 1)[-1]]
        keyed = self.keyed()
        return keyed.unionByName(self.spark.read.schema(keyed.schema).parquet(*folders)) if folders else keyed

    def save(self, df: DataFrame) -> None:
        """Replace the table by ``df``."""
        version = self.version()
        self._save(df.where(~self._nulls()).repartition(self.buckets, *self.keys), df.where(self._nulls()), version + 1)
        for old in range(1, version + 1):
            delete_path(self.spark, self._unkeyed(old))

    def _save(self, keyed: DataFrame, unkeyed: DataFrame, version: int) -> None:
        unkeyed.write.mode("overwrite").parquet(self._unkeyed(version))
        draft = f"{self.name}_draft"
        self.spark.sql(f"DROP TABLE IF EXISTS {draft}")
        first = not self.spark.catalog.tableExists(self.name)
        delete_path(self.spark, self._keyed(version))
        (keyed.write.format("parquet").bucketBy(self.buckets, *self.keys).sortBy(*self.keys)
         .option("path", self._keyed(version)).saveAsTable(self.name if first else draft))
        if not first:
            # The one step that makes the version count.
            self.spark.sql(f"ALTER TABLE {self.name} SET LOCATION '{self._keyed(version)}'")
            self.spark.sql(f"DROP TABLE {draft}")
            self.spark.catalog.refreshTable(self.name)
            delete_path(self.spark, self._keyed(version - 2))  # the one before stays for its readers

    def merged(self, source: DataFrame, stamp: Mapping[str, Column] | None = None, check: bool = True) -> DataFrame:
        """Rows with whole keys after the merge. The source is shuffled to the buckets; the target is read bucket by
        bucket and not shuffled at all."""
        return upsert(self.keyed(), source.where(~self._nulls()), self.keys, stamp, check, small_rows=0, null_keys=False)

    def upsert(self, source: DataFrame, stamp: Mapping[str, Column] | None = None, check: bool = True) -> None:
        """MERGE ``source`` in; its rows with a NULL in a key are new rows, as in SQL."""
        fresh = source.where(self._nulls())
        keyed = self.keyed()
        stamp = dict(stamp or {})
        unkeyed = fresh.select(*[(stamp[f.name] if f.name in stamp else F.col(f.name) if f.name in source.columns
                                  else F.lit(None)).cast(f.dataType).alias(f.name) for f in keyed.schema.fields])
        self._save(self.merged(source, stamp, check), unkeyed, self.version() + 1)
