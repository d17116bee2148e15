"""Quiet-period checks as a live stream: arrivals are counted in keyed state, timers make the checks."""

from __future__ import annotations

from collections import Counter
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.streaming.query import StreamingQuery

from pipekit.operators.audit import CALL, next_check

STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
CHECKS = T.StructType([T.StructField("series", T.StringType()), T.StructField("check_id", T.LongType()),
                       T.StructField("record_count", T.LongType()), T.StructField("new_record_found", T.StringType()),
                       T.StructField("quiet_checks", T.LongType()), T.StructField("action", T.StringType())])


class QuietChecks(StatefulProcessor):
    """State of a series: rows that wait, and what the last check saw. The first arrival starts a timer; each time it
    runs out the series is checked and, unless its rows are called for, the timer starts again."""

    def __init__(self, every_ms: int, threshold: int):
        self.every_ms, self.threshold = every_ms, threshold

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.seen = handle.getValueState("seen", "waiting bigint, checks bigint, last bigint, quiet bigint, timed boolean")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        waiting, checks, last, quiet, timed = self.seen.get() if self.seen.exists() else (0, 0, None, None, False)
        waiting += sum(r["n"] for r in rows)
        if not timed:
            self.handle.registerTimer(timerValues.getCurrentProcessingTimeInMs() + self.every_ms)
        self.seen.update((waiting, checks, last, quiet, True))
        return iter(())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        waiting, checks, last, quiet, _ = self.seen.get()
        found, quiet, action = next_check(None if last is None else (last, quiet), waiting, self.threshold)
        checks += 1
        if action == CALL:
            # The rows are taken; the series sleeps until more arrive, and its checks go on counting.
            self.seen.update((0, checks, None, None, False))
        else:
            self.seen.update((waiting, checks, waiting, quiet, True))
            self.handle.registerTimer(timerValues.getCurrentProcessingTimeInMs() + self.every_ms)
        yield Row(series=key[0], check_id=checks, record_count=waiting, new_record_found=found, quiet_checks=quiet, action=action)

    def close(self) -> None:
        pass


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    counts: Counter = Counter()
    for batch in batches:
        counts.update(batch.column("series").to_pylist())
    yield pa.RecordBatch.from_arrays([pa.array(counts.keys(), pa.string()), pa.array(counts.values(), pa.int64())],
                                     names=["series", "n"])


def quiet_checks(arrivals: DataFrame, series: str, every_ms: int, threshold: int = 3) -> DataFrame:
    """Checks of each series of a stream of arrivals, as :func:`pipekit.operators.audit.next_check` decides them: every
    ``every_ms`` from its first arrival on, until it was quiet for ``threshold`` checks.

    Arrivals are counted in their own tasks before they move, so a series with a third of all rows sends one row a
    task. The state holds five values for each series, whatever arrives. Needs the RocksDB state store
    (:func:`start_checks` sets it). NULL is a series too.
    """
    counted = arrivals.select(F.col(series).cast("string").alias("series")).mapInArrow(_counted, "series string, n bigint")
    return counted.groupBy("series").transformWithState(
        statefulProcessor=QuietChecks(every_ms, threshold), outputStructType=CHECKS, outputMode="Append",
        timeMode="ProcessingTime")


def start_checks(spark: SparkSession, arrivals: DataFrame, series: str, checkpoint: str, every_ms: int,
                 on_check: Callable[[DataFrame, int], None], threshold: int = 3) -> StreamingQuery:
    """Run :func:`quiet_checks`; ``on_check`` gets the checks of each micro-batch that made some, for a load of the
    series called for. No log of earlier checks is kept or read: the state is the log."""
    old = spark.conf.get("spark.sql.streaming.stateStore.providerClass")
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", STORE)

    def act(rows: DataFrame, number: int) -> None:
        if not rows.isEmpty():
            on_check(rows, number)

    try:
        return (quiet_checks(arrivals, series, every_ms, threshold).writeStream.outputMode("append")
                .option("checkpointLocation", checkpoint).trigger(processingTime=f"{max(100, every_ms // 4)} milliseconds")
                .foreachBatch(act).start())
    finally:
        spark.conf.set("spark.sql.streaming.stateStore.providerClass", old)
