"""File loads that remember what they loaded: by batch run or as a stream."""

from __future__ import annotations

import datetime as dt
import json
import re
import time
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.query import StreamingQuery

from pipekit.functions.text import relative_path
from pipekit.functions.times import as_of_column
from pipekit.operators.audit import utc_now
from pipekit.operators.joins import missing_from
from pipekit.sinks.files import make_dirs, path_exists, remove_files, rename
from pipekit.sinks.writers import write_counted
from pipekit.sources.formats import ON_ERROR, Stage
from pipekit.sources.provenance import ContentIndex, content_keys, inventory, source_path
from pipekit.sources.scans import BAD_RECORD, with_bad_record

HISTORY_SCHEMA = (
    "file_name string, content_key string, status string, rows_parsed bigint, rows_loaded bigint, "
    "errors_seen bigint, first_error string, loaded_at timestamp_ntz, load_id string")
STATUS_SCHEMA = "load_id string, batch_id bigint, at string, input_rows bigint, duration_ms bigint"


@dataclass(frozen=True)
class FileLoad:
    """A load rule: where files land, what they look like, where rows and load history go.

    Rows go to ``target/load_id=…/row_state=ok|bad``; history rows are written last, so a load counts
    only once it is complete, and a repeated load replaces its own folder. ``key="content"`` takes a
    file sent again under the same name with other bytes as new; by default a name is loaded once.
    """

    spark: SparkSession
    stage: Stage
    schema: T.StructType
    target: str
    history: str
    glob: str = "*.csv*"
    key: str = "name"
    on_error: str = "abort"
    purge_to: str | None = None
    #: ``delete`` removes loaded files from the stage once their history is saved.
    purge: str | None = None
    #: Where content keys are kept from run to run; without it every run scans the whole stage for them.
    content_index: str | None = None
    #: Days after which a loaded file is forgotten and may be loaded again; None: never.
    remember_days: int | None = None

    @property
    def status(self) -> str:
        """Where a stream writes one row for each micro-batch."""
        return f"{self.history.rstrip('/')}-status"

    @property
    def _purges(self) -> str:
        return f"{self.history.rstrip('/')}-purge"

    def purge_loaded(self) -> int:
        """Remove files of complete loads that still lie in the stage as they were loaded; gives their number. A file
        sent again since has another time or length and stays. Tasks remove them, so many files take no driver time."""
        if not path_exists(self.spark, self._purges):
            return 0
        done = self.load_history().select("load_id").distinct()
        loaded = self.spark.read.parquet(self._purges).join(done, "load_id", "left_semi")
        here = inventory(self.spark, self.stage.path, self.glob).select("path", "length", "modified")
        return remove_files(here.join(loaded, ["path", "length", "modified"], "left_semi").select("path"))

    def load_history(self) -> DataFrame:
        """One row per loaded file."""
        if not path_exists(self.spark, self.history):
            return self.spark.createDataFrame([], HISTORY_SCHEMA)
        return self.spark.read.schema(HISTORY_SCHEMA).parquet(self.history)

    def pending(self, as_of: dt.datetime | None = None, force: bool = False) -> DataFrame:
        """Files in the stage that are not in the history, or not in that of the last ``remember_days``."""
        files = inventory(self.spark, self.stage.path, self.glob).withColumn(
            "file_name", relative_path("path", self.stage.path))
        if self.key == "content":
            keys = (ContentIndex(self.spark, self.stage.path, self.content_index).keys() if self.content_index
                    else content_keys(self.spark, self.stage.path))
            files = files.join(keys, "path")
        else:
            files = files.withColumn("content_key", F.lit(None).cast("string"))
        if force or not path_exists(self.spark, self.history):
            return files
        known = self.load_history()
        if self.remember_days is not None:
            since = as_of_column(as_of or utc_now()) - F.make_dt_interval(F.lit(self.remember_days))
            known = known.where(F.col("loaded_at") >= since)
        on = ["file_name", "content_key"] if self.key == "content" else ["file_name"]
        return missing_from(files, known, on)

    def run(self, load_id: str, as_of: dt.datetime | None = None, force: bool = False) -> DataFrame:
        """Load the pending files; gives the history rows of this load (none when nothing is new).

        A ``load_id`` counts once: after a cut-short run it may be used again and replaces what that run left,
        but a completed one is refused, since its folder holds rows that would be lost. The list of new paths
        passes the driver, as every file listing of a Spark read does.
        """
        as_of = as_of or utc_now()
        if self.purge == "delete":
            self.purge_loaded()  # what a run left that ended between its history and its removals
        files = self.pending(as_of, force)
        paths = [r["path"] for r in files.select("path").collect()]
        if not paths:
            return self.load_history().where(F.lit(False))
        if path_exists(self.spark, f"{self.history}/load_id={load_id}/_SUCCESS"):
            raise ValueError(f"load {load_id} is complete; new files need a load_id of their own")
        rows = (self.spark.read.schema(self._read_schema()).options(**self.stage.format.reader_options())
                .option("mode", self._mode()).csv([re.sub(r"([\\\[\]{}*?])", r"\\\1", p) for p in paths]))
        keys = files.select("file_name", "content_key")
        if self.purge == "delete":
            files.select("path", "length", "modified").write.mode("overwrite").parquet(f"{self._purges}/load_id={load_id}")
        self._save(self._stamped(rows), load_id, as_of, keys)
        if self.purge == "delete":
            self.purge_loaded()
        if self.purge_to:
            self._archive(paths, load_id)
        return self.load_history().where(F.col("load_id") == load_id)

    def loaded(self) -> DataFrame:
        """Rows of all complete loads, with ``source_file`` and ``load_id``."""
        done = self.load_history().select("load_id").distinct()
        rows = self.spark.read.schema(self._saved_schema()).parquet(self.target)
        return (rows.where(F.col("row_state") == "ok").join(done, "load_id", "left_semi")
                .select(*self.schema.names, "source_file", "load_id"))

    def rejects(self) -> DataFrame:
        """Bad rows of all complete loads."""
        done = self.load_history().select("load_id").distinct()
        rows = self.spark.read.schema(self._saved_schema()).parquet(self.target)
        return (rows.where(F.col("row_state") == "bad").join(done, "load_id", "left_semi")
                .select(BAD_RECORD, "source_file", "load_id"))

    def stream(self, name: str, checkpoint: str, trigger: dict | None = None,
               max_files: int | None = None, after: Callable[[DataFrame, str], None] | None = None,
               ) -> StreamingQuery:
        """The same load as a stream: new files are picked up, loaded ones skipped by the checkpoint.

        The load id is made of the checkpoint's own id and the micro-batch number, so a batch that is run again
        replaces its own rows, and a new checkpoint replaces none. Each batch leaves a row for :func:`ingest_status`.
        ``trigger`` is ``{"availableNow": True}`` (default) or ``{"processingTime": "1 minute"}``;
        ``after`` gets the rows and load id of each non-empty batch.
        """
        make_dirs(self.spark, self.stage.path)
        reader = (self.spark.readStream.schema(self._read_schema())
                  .options(**self.stage.format.reader_options()).option("mode", self._mode())
                  .option("pathGlobFilter", self.glob).option("recursiveFileLookup", True))
        if max_files:
            reader = reader.option("maxFilesPerTrigger", max_files)
        if self.purge_to:
            reader = reader.option("cleanSource", "archive").option("sourceArchiveDir", self.purge_to)
        rows = self._stamped(reader.csv(self.stage.path))

        def save(batch: DataFrame, number: int) -> None:
            started, clock = utc_now(), time.monotonic()
            run = json.loads(self.spark.read.text(f"{checkpoint}/metadata").first()["value"])["id"]
            load_id = f"{name}-{run[:13]}-{number:09d}"
            count = self._save(batch, load_id, utc_now(), None)
            if after is not None:
                fresh = self.loaded().where(F.col("load_id") == load_id)
                if not fresh.isEmpty():
                    after(fresh, load_id)
            status = [(load_id, number, started.isoformat(timespec="milliseconds"), count,
                       int(1000 * (time.monotonic() - clock)))]
            (self.spark.createDataFrame(status, STATUS_SCHEMA).coalesce(1)
             .write.mode("overwrite").parquet(f"{self.status}/load_id={load_id}"))

        return (rows.writeStream.queryName(name).option("checkpointLocation", checkpoint)
                .trigger(**(trigger or {"availableNow": True})).foreachBatch(save).start())

    def _read_schema(self) -> T.StructType:
        return self.schema if self.on_error == "abort" else with_bad_record(self.schema)

    def _saved_schema(self) -> T.StructType:
        return T.StructType(with_bad_record(self.schema).fields + [
            T.StructField(n, T.StringType()) for n in ("source_file", "load_id", "row_state")])

    def _mode(self) -> str:
        return ON_ERROR["abort" if self.on_error == "abort" else "report"]

    def _stamped(self, rows: DataFrame) -> DataFrame:
        bad = F.col(BAD_RECORD) if self.on_error != "abort" else F.lit(None).cast("string")
        return rows.select(*self.schema.names, bad.alias(BAD_RECORD),
                           relative_path(source_path(), self.stage.path).alias("source_file"))

    def _save(self, rows: DataFrame, load_id: str, as_of: dt.datetime, keys: DataFrame | None) -> int:
        """Rows, then the history of their files, whose counts take one more pass over two narrow columns. Gives the
        number of rows, counted while they are written."""
        folder = f"{self.target}/load_id={load_id}"
        state = F.when(F.col(BAD_RECORD).isNull(), F.lit("ok")).otherwise(F.lit("bad"))
        count = write_counted(rows.withColumn("row_state", state), folder, partition_by=["row_state"])
        saved = self.spark.read.schema(self._saved_schema()).parquet(folder)
        bad = F.col(BAD_RECORD)
        result = saved.groupBy("source_file").agg(
            F.count(F.lit(1)).alias("rows_parsed"), F.count_if(bad.isNull()).alias("rows_loaded"),
            F.count_if(bad.isNotNull()).alias("errors_seen"), F.min(bad).alias("first_error"))
        if keys is not None:
            result = keys.join(result, F.col("file_name") == F.col("source_file"), "left")
        else:
            result = result.select("*", F.col("source_file").alias("file_name"),
                                   F.lit(None).cast("string").alias("content_key"))
        status = (F.when(F.coalesce("errors_seen", F.lit(0)) == 0, F.lit("LOADED"))
                  .when(F.col("rows_loaded") == 0, F.lit("LOAD_FAILED")).otherwise(F.lit("PARTIALLY_LOADED")))
        (result.select("file_name", "content_key", status.alias("status"),
                       *[F.coalesce(c, F.lit(0)).alias(c) for c in ("rows_parsed", "rows_loaded", "errors_seen")],
                       "first_error", as_of_column(as_of).alias("loaded_at"))
         .write.mode("overwrite").parquet(f"{self.history}/load_id={load_id}"))
        return count

    def _archive(self, paths: list[str], load_id: str) -> None:
        """Move loaded files away; those of one load share a folder."""
        folder = f"{self.purge_to}/{load_id}"
        make_dirs(self.spark, folder)
        for i, path in enumerate(paths):
            rename(self.spark, path, f"{folder}/{i:06d}-{path.rsplit('/', 1)[-1]}")


def skip_empty(action: Callable[[DataFrame, int], None]) -> Callable[[DataFrame, int], None]:
    """Run a batch action only when the batch has rows."""
    def guarded(batch: DataFrame, number: int) -> None:
        if not batch.isEmpty():
            action(batch, number)
    return guarded


def ingest_status(spark: SparkSession, load: FileLoad) -> DataFrame:
    """Every micro-batch of the load's streams as a row: load id, batch, time, input rows, duration.

    The batches write them as they end, so the rows outlive the query and are not cut to its recent progress.
    """
    if not path_exists(spark, load.status):
        return spark.createDataFrame([], STATUS_SCHEMA)
    return spark.read.schema(STATUS_SCHEMA).parquet(load.status)
