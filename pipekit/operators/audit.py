"""Reconciliation, run audit, run history, quiet-period checks."""

from __future__ import annotations

import datetime as dt
import time
from collections.abc import Callable, Iterator, Mapping, Sequence
from contextlib import contextmanager
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from pipekit.functions.shape import map_values
from pipekit.functions.times import add_time, local_clock, local_date, second_diff
from pipekit.operators.aggregates import latest_row, union_blocks
from pipekit.operators.changes import differing_buckets
from pipekit.operators.joins import cross_values, missing_from

AUDIT_SCHEMA = (
    "run_id string, job string, status string, message string, started timestamp_ntz, "
    "ended timestamp_ntz, duration_seconds bigint, source_count bigint, target_count bigint, "
    "match_status string")

# State names and how a run history shows them.
RUN_STATES = {"SUCCEEDED": "SUCCESS", "EXECUTING": "RUNNING", "FAILED": "FAILED", "SCHEDULED": "SCHEDULED"}

# What a quiet-period check can decide.
IDLE, WAIT, CALL = "IDLE", "WAIT", "CALL SP"


def reconcile(source: DataFrame, target: DataFrame) -> DataFrame:
    """Source and target row counts and MATCH or MISMATCH."""
    counts = union_blocks(
        source.agg(F.count(F.lit(1)).alias("source_count")).withColumn("target_count", F.lit(0)),
        target.agg(F.count(F.lit(1)).alias("target_count")).withColumn("source_count", F.lit(0)))
    both = counts.agg(F.sum("source_count").alias("source_count"), F.sum("target_count").alias("target_count"))
    return both.withColumn("match_status", F.when(
        F.col("source_count") == F.col("target_count"), F.lit("MATCH")).otherwise(F.lit("MISMATCH")))


def reconcile_content(source: DataFrame, target: DataFrame, keys: Sequence[str], buckets: int = 4096) -> DataFrame:
    """Row counts, how many key buckets hold different rows, and MATCH or MISMATCH by content.

    One pass over each side; a task sends a digest for each bucket, no rows. Rows may come in any order, repeated ones
    count.
    """
    bucket = F.pmod(F.xxhash64(*keys), F.lit(buckets))
    names = source.columns
    differ = differing_buckets(source, target.select(*names), bucket, names).agg(F.count(F.lit(1)).alias("buckets_differing"))
    both = union_blocks(reconcile(source, target).drop("match_status"), differ).agg(
        *[F.max(c).alias(c) for c in ("source_count", "target_count", "buckets_differing")])
    return both.withColumn("match_status", F.when(F.col("buckets_differing") == 0, F.lit("MATCH")).otherwise(F.lit("MISMATCH")))


def missing_rows(source: DataFrame, target: DataFrame, on: Sequence[str]) -> DataFrame:
    """How many source rows did not arrive, with the resulting status."""
    lost = missing_from(source, target, on).agg(F.count(F.lit(1)).alias("missing"))
    return lost.withColumn("status", F.when(F.col("missing") > 0, F.lit("FAILURE")).otherwise(F.lit("SUCCESS")))


def load_target_audit(staged: DataFrame, load_id: str, targets: Mapping[str, DataFrame | None],
                      ) -> DataFrame:
    """One row per load and target table: staged rows, and rows measured in the target.

    A target given as None takes the staged count, for targets written one to one in the same run.
    """
    source = staged.groupBy(load_id).agg(F.count(F.lit(1)).alias("source_count"))
    grid = cross_values(source, "target_table", list(targets))
    measured = [df.groupBy(load_id).agg(F.count(F.lit(1)).alias("__measured"))
                .withColumn("target_table", F.lit(name)) for name, df in targets.items() if df is not None]
    known = [name for name, df in targets.items() if df is not None]
    if not measured:
        return grid.withColumn("target_count", F.col("source_count"))
    grid = grid.join(union_blocks(*measured), [load_id, "target_table"], "left")
    count = F.when(F.col("target_table").isin(known), F.coalesce("__measured", F.lit(0)))
    return grid.withColumn("target_count", count.otherwise(F.col("source_count"))).drop("__measured")


def quiet_period(checks: DataFrame, ts: str, count: str, series: Sequence[str] = (),
                 threshold: int = 3, also: Sequence[str] = (), block: str = "day") -> DataFrame:
    """Decide at every check whether the waiting rows have been quiet long enough to load.

    Adds ``new_record_found``, ``quiet_checks`` and ``action``. No rows waiting is IDLE; the first
    check counts 1; an unchanged count adds 1 and loads from ``threshold`` on; a changed count starts
    again at 0. ``also`` names further columns that must be unchanged, so that a swap of equal size is
    seen.

    The check sequence is cut into time blocks. Windows run inside a block, or over one summary row per
    block, so a long sequence is spread over tasks and the result equals a step-by-step fold.
    """
    keys = [*(series or ["__series"]), "__block"]
    watch = [count, *also]
    base = (checks if series else checks.withColumn("__series", F.lit(0))).withColumn(
        "__block", F.date_trunc(block, F.col(ts)).cast("timestamp_ntz"))
    inside = Window.partitionBy(*keys).orderBy(ts)
    over_blocks = Window.partitionBy(*keys[:-1]).orderBy("__block")
    earlier = over_blocks.rowsBetween(Window.unboundedPreceding, -1)
    seen, empty, row = F.struct(*watch), F.col(count) == 0, F.col("__row")

    # Inside a block: position, previous check, last restart so far (the block's first row is open).
    rows = base.withColumn("__row", F.row_number().over(inside)).withColumn("__lag", F.lag(seen).over(inside))
    rows = rows.withColumn("__restart", F.when((row > 1) & (empty | (seen != F.col("__lag"))), row))
    rows = rows.withColumn("__run", F.max("__restart").over(inside.rowsBetween(Window.unboundedPreceding, 0)))

    # Per block: what the block before ended with, and where the last restart before it was.
    ends = rows.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("__rows"), F.min_by(seen, F.col(ts)).alias("__head"),
        F.max_by(seen, F.col(ts)).alias("__tail"), F.max("__restart").alias("__last"))
    ends = ends.withColumn("__before", F.coalesce(F.sum("__rows").over(earlier), F.lit(0))).withColumn(
        "__carry", F.lag("__tail").over(over_blocks))
    opens = (F.col("__carry").isNull() | (F.col("__head") != F.col("__carry")) | (F.col(f"__head.{count}") == 0))
    ends = ends.withColumn("__opens", opens).withColumn("__last_at", F.col("__before") + F.coalesce(
        "__last", F.when(F.col("__opens"), F.lit(1))))
    ends = ends.withColumn("__open_at", F.max("__last_at").over(earlier)).select(
        *keys, "__before", "__carry", "__opens", "__open_at")

    rows = rows.join(ends, keys)
    at, first = F.col("__before") + row, F.col("__carry").isNull() & (row == 1)
    previous = F.when(row == 1, F.col("__carry")).otherwise(F.col("__lag"))
    changed = ~first & (seen != previous)
    start = F.coalesce(F.col("__before") + F.col("__run"),
                       F.when(F.col("__opens"), F.col("__before") + 1).otherwise(F.col("__open_at")))
    quiet = F.when(empty, F.lit(0)).when(start == 1, at).otherwise(at - start).cast("bigint")
    found = F.when(~empty & changed, F.lit("Y")).otherwise(F.lit("N"))
    action = (F.when(empty, F.lit(IDLE)).when(~first & ~changed & (quiet >= threshold), F.lit(CALL))
              .otherwise(F.lit(WAIT)))
    return rows.select(*checks.columns, found.alias("new_record_found"), quiet.alias("quiet_checks"),
                       action.alias("action"))


def next_check(previous: tuple[int, int] | None, count: int, threshold: int = 3) -> tuple[str, int, str]:
    """One step of :func:`quiet_period` for a live job: ``previous`` is (count, quiet) of the last
    check. Gives (new found, quiet, action)."""
    if count == 0:
        return "N", 0, IDLE
    if previous is None:
        return "N", 1, WAIT
    if count == previous[0]:
        quiet = previous[1] + 1
        return "N", quiet, CALL if quiet >= threshold else WAIT
    return "Y", 0, WAIT


def run_history(runs: DataFrame, zone: str, suffix: str = "", upcoming: int = 5,
                every_minutes: int = 1) -> DataFrame:
    """Past runs with local-time columns and duration, plus the next points of each task's schedule.

    ``runs`` has task_name, state, scheduled_time, start_time, completed_time, error_message. Sort on
    ``scheduled_time``: the 12-hour text does not sort.
    """
    past = runs.select(
        "task_name", map_values("state", RUN_STATES).alias("execution_status"), "scheduled_time",
        local_date("scheduled_time", zone).alias("execution_date"),
        local_clock("scheduled_time", zone, suffix).alias("scheduled_clock"),
        local_clock("start_time", zone, suffix).alias("start_clock"),
        local_clock("completed_time", zone, suffix).alias("completed_clock"),
        second_diff("start_time", "completed_time").alias("execution_seconds"), "error_message")
    last = runs.groupBy("task_name").agg(F.max("scheduled_time").alias("last_time"))
    points = schedule_points(last, "last_time", upcoming, every_minutes, at="scheduled_time")
    future = points.select(
        "task_name", F.lit("UPCOMING").alias("execution_status"), "scheduled_time",
        local_date("scheduled_time", zone).alias("execution_date"),
        local_clock("scheduled_time", zone, suffix).alias("scheduled_clock"))
    return union_blocks(past, future)


def upcoming_points(start: Column, n: int, every_minutes: int, spark: SparkSession) -> DataFrame:
    """``n`` future points of one schedule."""
    return spark.range(1, n + 1).select(
        F.col("id").alias("step"), add_time(start, minutes=(F.col("id") * every_minutes).cast("int")).alias("at"))


def schedule_points(schedules: DataFrame, last: str, n: int, every_minutes: int = 1, at: str = "at") -> DataFrame:
    """Each of many schedules with its ``n`` next points after the time ``last``: ``step`` from 1 and the time ``at``."""
    steps = schedules.withColumn("step", F.explode(F.sequence(F.lit(1), F.lit(n))))
    return steps.withColumn(at, add_time(last, minutes=F.col("step") * F.lit(every_minutes)))


def final_status(runs: DataFrame, audit: DataFrame, on: str = "run_id") -> DataFrame:
    """Status of each run from its own state and its audit row; no audit row is a FAILURE."""
    joined = runs.join(audit.select(on, F.col("status").alias("audit_status")), on, "left")
    return joined.withColumn("final_status", F.when(
        F.col("state") == "EXECUTING", F.lit("RUNNING")).when(
        (F.col("state") == "SUCCEEDED") & (F.col("audit_status") == "SUCCESS"), F.lit("SUCCESS"))
        .otherwise(F.lit("FAILURE")))


@dataclass
class RunResult:
    """What a job did. Jobs return it instead of raising."""

    run_id: str
    job: str
    status: str = "SUCCESS"
    message: str = ""
    source_count: int | None = None
    target_count: int | None = None
    match_status: str | None = None
    started: dt.datetime | None = None
    ended: dt.datetime | None = None
    details: dict = field(default_factory=dict)

    @property
    def ok(self) -> bool:
        return self.status == "SUCCESS"


class JobFailure(Exception):
    """A failure with a message that belongs in the audit row."""


def utc_now() -> dt.datetime:
    return dt.datetime.fromtimestamp(time.time(), dt.timezone.utc).replace(tzinfo=None)


class AuditLog:
    """Append-only audit table in Parquet, one folder per run so that a retry replaces its own row."""

    def __init__(self, spark: SparkSession, path: str, clock: Callable[[], dt.datetime] = utc_now):
        self.spark, self.path, self.clock = spark, path.rstrip("/"), clock

    def append(self, result: RunResult) -> None:
        seconds = None
        if result.started and result.ended:
            whole = result.ended.replace(microsecond=0) - result.started.replace(microsecond=0)
            seconds = int(whole.total_seconds())
        row = (result.run_id, result.job, result.status, result.message, result.started, result.ended,
               seconds, result.source_count, result.target_count, result.match_status)
        (self.spark.createDataFrame([row], AUDIT_SCHEMA).coalesce(1).write.mode("overwrite")
         .parquet(f"{self.path}/{result.job}/{result.run_id}"))

    def read(self, job: str | None = None) -> DataFrame:
        """All rows, or those of one job, read from its folder only."""
        from pipekit.sinks.files import path_exists
        path = self.path if job is None else f"{self.path}/{job}"
        if not path_exists(self.spark, path):
            return self.spark.createDataFrame([], AUDIT_SCHEMA)
        return self.spark.read.schema(AUDIT_SCHEMA).option("recursiveFileLookup", True).parquet(path)

    def latest(self, job: str) -> DataFrame:
        return latest_row(self.read(job), ["started", "run_id"])

    @contextmanager
    def run(self, job: str, run_id: str) -> Iterator[RunResult]:
        """Record start, end and outcome of the body. An error becomes a FAILURE row and is not
        raised again; look at ``result.status``."""
        result = RunResult(run_id, job, started=self.clock())
        try:
            yield result
        except JobFailure as error:
            result.status, result.message = "FAILURE", str(error)
        except Exception as error:  # noqa: BLE001 - the audit row must hold whatever went wrong
            result.status, result.message = "FAILURE", f"{type(error).__name__}: {error}"
        result.ended = self.clock()
        self.append(result)


def require_rows(df: DataFrame, what: str = "input") -> DataFrame:
    """Fail the run when there is nothing to do."""
    if df.isEmpty():
        raise JobFailure(f"{what} is empty")
    return df
