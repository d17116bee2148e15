"""Loads that remember the files they have read, in a table of their own."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pipekit.operators.audit import load_target_audit
from pipekit.operators.joins import missing_from
from pipekit.sinks.files import path_exists
from pipekit.sinks.writers import write_counted
from pipekit.sources.provenance import inventory

FILES = "path string, length bigint, modified timestamp_ntz, run_id bigint"


@dataclass(frozen=True)
class ConsumedLoad:
    """Rows of a growing staging folder into several targets, each file once.

    A run writes ``root/<target>/run_id=…``, its audit rows, and last the list of the files it read to
    ``log/consumed/run_id=…``: only that makes it count. Readers see complete runs only, so a run that is cut short
    counts not at all; begun again, under its own id or another, it reads the same files. No file is moved or marked.
    """

    spark: SparkSession
    staging: str
    targets: Mapping[str, Sequence[str]]
    root: str
    log: str
    load_id: str = "load_id"

    def consumed(self) -> DataFrame:
        """Files of complete runs."""
        where = f"{self.log}/consumed"
        if not path_exists(self.spark, where):
            return self.spark.createDataFrame([], FILES)
        return self.spark.read.schema(FILES).parquet(where)

    def waiting(self) -> DataFrame:
        """Files of the staging folder that no complete run has read."""
        files = inventory(self.spark, self.staging, "*.parquet").select("path", "length", "modified")
        return missing_from(files, self.consumed(), ["path", "length", "modified"])

    def run(self, run_id: int) -> int | None:
        """Load what waits; the number of rows, or None when there is nothing to load."""
        if path_exists(self.spark, f"{self.log}/consumed/run_id={run_id}/_SUCCESS"):
            raise ValueError(f"run {run_id} is complete")
        if not path_exists(self.spark, self.staging):
            return None
        # A file list, as every Spark read makes on the driver; kept, so that files that arrive meanwhile are not in it.
        found = self.waiting().collect()
        if not found:
            return None
        rows = self.spark.read.option("basePath", self.staging).parquet(*[r["path"] for r in found])
        count, places = 0, {name: f"{self.root}/{name}/run_id={run_id}" for name in self.targets}
        for name, columns in self.targets.items():
            count = write_counted(rows.select(*dict.fromkeys([self.load_id, *columns])), places[name])
        measured = {name: self.spark.read.parquet(path) for name, path in places.items()}
        (load_target_audit(rows, self.load_id, measured).withColumn("status", F.lit("SUCCESS"))
         .write.mode("overwrite").parquet(f"{self.log}/audit/run_id={run_id}"))
        files = self.spark.createDataFrame(found, FILES.rsplit(",", 1)[0])
        files.coalesce(1).write.mode("overwrite").parquet(f"{self.log}/consumed/run_id={run_id}")
        return count

    def _complete(self, folder: str) -> DataFrame:
        done = self.consumed().select("run_id").distinct()
        return self.spark.read.option("basePath", folder).parquet(folder).join(done, "run_id", "left_semi")

    def loaded(self, target: str) -> DataFrame:
        """Rows of a target from complete runs, with ``run_id``."""
        return self._complete(f"{self.root}/{target}")

    def audit(self) -> DataFrame:
        """Audit rows of complete runs, with ``run_id``."""
        return self._complete(f"{self.log}/audit")
