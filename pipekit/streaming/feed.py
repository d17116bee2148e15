"""A change log with consumers, in batch and as a stream."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.query import StreamingQuery

from pipekit.operators.changes import apply_changes, diff_snapshots
from pipekit.sinks.files import path_exists, write_text
from pipekit.session import working_tables
from pipekit.sinks.writers import recover, replace, rewrite_partitions
from pipekit.streaming.loads import skip_empty


class ChangeLog:
    """Versions of changes under ``path/version=…``; each consumer has its own offset.

    Reading leaves the offset alone. ``consume`` moves it after the action has succeeded, so a crash
    repeats the action for the same versions: it must give the same end state when repeated, as
    :func:`apply_to_folder` does.
    """

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def capture(self, before: DataFrame, after: DataFrame, keys: Sequence[str]) -> int:
        """Append the difference of two snapshots as the next version."""
        last = self.last_version()
        diff_snapshots(before, after, keys).write.mode("overwrite").parquet(self._folder(last + 1))
        write_text(self.spark, f"{self.path}/_state/checked", str(last))
        return last + 1

    def last_version(self) -> int:
        """The last version before the first one whose write has not been committed.

        Versions up to the checked one, which each capture moves on, are known to be, so only the few after it are
        looked for, however long the log is."""
        checked = f"{self.path}/_state/checked"
        last = int(self.spark.read.text(checked).first()["value"]) if path_exists(self.spark, checked) else 0
        while path_exists(self.spark, f"{self._folder(last + 1)}/_SUCCESS"):
            last += 1
        return last

    def _folder(self, version: int) -> str:
        return f"{self.path}/version={version:09d}"

    def offset(self, consumer: str) -> int:
        where = f"{self.path}/_offsets/{consumer}"
        if not path_exists(self.spark, where):
            return 0
        return int(self.spark.read.text(where).first()["value"])

    def pending(self, consumer: str, upto: int | None = None) -> DataFrame:
        """Committed changes after the offset, with their ``version``; consumes nothing."""
        after, upto = self.offset(consumer), self.last_version() if upto is None else upto
        folders = [self._folder(v) for v in range(after + 1, upto + 1)]
        nothing = not folders
        rows = self.spark.read.option("basePath", self.path).parquet(*(folders or [self._folder(upto)]))
        return rows.where(F.lit(False)) if nothing else rows

    def has_data(self, consumer: str) -> bool:
        upto = self.last_version()
        return upto > self.offset(consumer) and not self.pending(consumer, upto).isEmpty()

    def consume(self, consumer: str, action: Callable[[DataFrame], None]) -> bool:
        """Run the action on the pending changes, then move the offset. False when there are none."""
        upto = self.last_version()
        if upto <= self.offset(consumer):
            return False
        rows = self.pending(consumer, upto)
        if rows.isEmpty():
            return False
        action(rows)
        write_text(self.spark, f"{self.path}/_offsets/{consumer}", str(upto))
        return True

    def stream(self, name: str, schema: T.StructType, checkpoint: str,
               action: Callable[[DataFrame, int], None], trigger: dict | None = None) -> StreamingQuery:
        """Consume as a stream; the checkpoint is the offset."""
        rows = self.spark.readStream.schema(schema).parquet(self.path)
        return (rows.writeStream.queryName(name).option("checkpointLocation", checkpoint)
                .trigger(**(trigger or {"availableNow": True})).foreachBatch(skip_empty(action)).start())


def apply_to_folder(spark: SparkSession, target: str, keys: Sequence[str], seq: str | None = "version",
                    partition_by: Sequence[str] = ()) -> Callable[..., None]:
    """An action that applies a change batch to a Parquet folder.

    With ``partition_by`` (columns that never change for a key) only the partitions the changes touch
    are read and rewritten; without, the folder is rewritten and swapped.
    """
    def action(changes: DataFrame, _batch: int | None = None) -> None:
        order = seq if seq in changes.columns else None
        with working_tables(spark):
            if partition_by:
                rewrite_partitions(spark, target, partition_by, changes,
                                   lambda rows: apply_changes(rows, changes, keys, order))
            else:
                recover(spark, target)
                replace(apply_changes(spark.read.parquet(target), changes, keys, order), target)
    return action
