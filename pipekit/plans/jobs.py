"""Jobs composed from the operators. Each returns DataFrames or a RunResult."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import partial

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pipekit.functions.shape import band
from pipekit.operators.aggregates import group_summary
from pipekit.operators.audit import (CALL, AuditLog, JobFailure, RunResult, load_target_audit, next_check,
                                     require_rows)
from pipekit.operators.dims import (DimensionSpec, dimensions_from_flat, fact_from_flat, load_dimension,
                                    load_fact, side_by_side)
from pipekit.operators.joins import missing_from
from pipekit.operators.history import scd2_changes, scd2_initial
from pipekit.operators.merge import assert_unique, upsert
from pipekit.operators.quality import DuplicateReport, drop_duplicates, drop_nulls, duplicate_report
from pipekit.sinks.files import delete_path, list_files, make_dirs, path_exists, rename, write_text
from pipekit.sinks.layers import mark_complete, to_dated, to_refined
from pipekit.session import durable, working_tables
from pipekit.sinks.writers import (append_rows, export_many, export_named, export_under, load_targets,
                                   recover, reload, replace, rewrite_partitions, write_counted)
from pipekit.sources.formats import FileFormat, Stage
from pipekit.sources.scans import read_stage_file, read_when_marked
from pipekit.streaming.loads import FileLoad


@dataclass(frozen=True)
class Star:
    """Where a star schema lives and how its dimensions and fact are built.

    ``dims`` maps a dimension to (key, columns); the fact looks its keys up by the same columns.
    ``measures`` maps a fact column to a SQL expression over the staged columns. ``skewed`` says that few
    members hold much of the fact. ``null_safe`` gives rows with a NULL dimension value the member with that NULL;
    without it they find none, as in SQL.
    """

    root: str
    dims: Mapping[str, tuple[str, Sequence[str]]]
    fact: str
    fact_id: Sequence[str]
    measures: Mapping[str, str]
    skewed: bool = False
    null_safe: bool = False

    def path(self, name: str) -> str:
        return f"{self.root.rstrip('/')}/{name}"


def _read_or_none(spark: SparkSession, path: str) -> DataFrame | None:
    return spark.read.parquet(path) if path_exists(spark, path) else None


def _fact_columns(dims: Mapping[str, tuple[str, Sequence[str]]], fact_id: Sequence[str],
                  measures: Mapping[str, str]) -> dict[str, Column]:
    columns = {c: F.col(c) for c in fact_id}
    columns.update({key: F.col(key) for key, _ in dims.values()})
    columns.update({name: F.expr(text) for name, text in measures.items()})
    return columns


def load_star(staged: DataFrame, dims: Mapping[str, tuple[str, Sequence[str]]], fact_id: Sequence[str],
              measures: Mapping[str, str], existing: Mapping[str, DataFrame] | None = None,
              fact: str = "fact", skewed: bool = False, null_safe: bool = True, cut: bool = False) -> dict[str, DataFrame]:
    """Star tables after adding the staged rows to what exists: dimensions get their new members, the
    fact its new ids. Pure: nothing is saved. Running it again on its own result adds nothing. Dimensions
    load NULL-safely, so the fact looks up NULL-safely too unless told otherwise. ``cut`` keeps staged rows that are
    costly to compute as a working table, for the dimensions and the fact all read them."""
    existing = existing or {}
    staged = durable(staged, "staged") if cut else staged
    added = side_by_side({name: partial(load_dimension, staged, columns, key, existing.get(name))
                          for name, (key, columns) in dims.items()})
    out = {name: rows if name not in existing else existing[name].unionByName(rows)
           for name, rows in added.items()}
    columns = _fact_columns(dims, fact_id, measures)
    old = existing.get(fact)
    rows = load_fact(staged, [(out[n], c) for n, (_, c) in dims.items()], columns, old, fact_id,
                     skewed=skewed, check=False, null_safe=null_safe)
    out[fact] = rows if old is None else old.unionByName(rows)
    return out


def run_star_once(spark: SparkSession, staged: DataFrame, star: Star, log: AuditLog, run_id: str,
                  strict: bool = False) -> RunResult:
    """Star load with reconciliation: dimensions first, then the fact, then staging against fact."""
    with log.run("star_load", run_id) as result, working_tables(spark):
        require_rows(staged, "staging")
        tables = load_star(staged, star.dims, star.fact_id, star.measures, fact=star.fact)
        for name, df in tables.items():
            if name != star.fact:
                reload(df, star.path(name))
        saved = {n: spark.read.parquet(star.path(n)) for n in star.dims}
        columns = _fact_columns(star.dims, star.fact_id, star.measures)
        result.target_count = write_counted(load_fact(
            staged, [(saved[n], c) for n, (_, c) in star.dims.items()], columns, skewed=star.skewed,
            null_safe=star.null_safe), star.path(star.fact))
        result.source_count = staged.count()
        result.match_status = "MATCH" if result.source_count == result.target_count else "MISMATCH"
        if strict and result.match_status == "MISMATCH":
            raise JobFailure("staging and fact counts differ")
    return result


def stage_then_star(spark: SparkSession, stage: Stage, schema: T.StructType, staging: str, star: Star,
                    log: AuditLog, run_id: str) -> RunResult:
    """Reload staging from all files of the stage, record it, then load the star."""
    with log.run("stage_load", run_id) as result:
        rows = spark.read.schema(schema).options(**stage.format.reader_options()).option(
            "mode", "FAILFAST").csv(stage.path)
        result.target_count = write_counted(rows, staging)
    if not result.ok:
        return result
    return run_star_once(spark, spark.read.parquet(staging), star, log, run_id)


def stage_file(spark: SparkSession, stage: Stage, name: str, schema: T.StructType, staging: str,
               log: AuditLog, run_id: str) -> RunResult:
    """Reload staging from one named file, even if it was loaded before."""
    with log.run("stage_file", run_id) as result:
        result.target_count = write_counted(read_stage_file(spark, stage, name, schema), staging)
    return result


def run_star_new(spark: SparkSession, staging: str, star: Star, log: AuditLog, run_id: str) -> RunResult:
    """Add only new members and new fact ids, then check that every staged id has arrived."""
    with log.run("star_new", run_id) as result, working_tables(spark):
        staged = require_rows(spark.read.parquet(staging), "staging")
        result.source_count = staged.count()

        def add_members(name: str) -> DataFrame:
            key, columns = star.dims[name]
            old = _read_or_none(spark, star.path(name))
            append_rows(load_dimension(staged, columns, key, old), star.path(name))
            return spark.read.parquet(star.path(name))

        saved = side_by_side({name: partial(add_members, name) for name in star.dims})
        columns = _fact_columns(star.dims, star.fact_id, star.measures)
        lookups = [(saved[n], c) for n, (_, c) in star.dims.items()]
        old = _read_or_none(spark, star.path(star.fact))
        append_rows(load_fact(staged, lookups, columns, old, star.fact_id, skewed=star.skewed,
                              null_safe=star.null_safe), star.path(star.fact))
        fact = spark.read.parquet(star.path(star.fact))
        result.target_count = fact.count()
        lost = missing_from(staged, fact, star.fact_id).count()
        if lost:
            raise JobFailure(f"{lost} staged rows are missing in {star.fact}")
    return result


def refine_then_star(spark: SparkSession, raw: DataFrame, keys: Sequence[str], required: Sequence[str],
                     refined: str, star: Star, log: AuditLog, run_id: str) -> RunResult:
    """Raw rows without NULLs and duplicates to the refined layer, then the idempotent star load."""
    with log.run("refine", run_id) as result:
        result.target_count = write_counted(drop_duplicates(drop_nulls(raw, required), keys), refined)
    return run_star_new(spark, refined, star, log, run_id) if result.ok else result


def normalise_flat(spark: SparkSession, flat: DataFrame, specs: Sequence[DimensionSpec],
                   columns: Sequence[str], root: str, fact: str = "fact") -> dict[str, DataFrame]:
    """Coded dimensions and a fact from one flat table. For empty targets only: a second load of the
    same codes would repeat them, so existing tables are refused."""
    root = root.rstrip("/")
    for name in [s.name for s in specs] + [fact]:
        if path_exists(spark, f"{root}/{name}"):
            raise FileExistsError(f"{root}/{name} is not empty")
    with working_tables(spark):
        for name, df in dimensions_from_flat(flat, specs).items():
            df.write.parquet(f"{root}/{name}")
    dims = {s.name: spark.read.parquet(f"{root}/{s.name}") for s in specs}
    fact_from_flat(flat, dims, specs, columns).write.parquet(f"{root}/{fact}")
    return {**dims, fact: spark.read.parquet(f"{root}/{fact}")}


def copy_table(spark: SparkSession, source: DataFrame, target: str, on: Sequence[str] | None = None) -> int:
    """Append the whole source on each call; with ``on``, only rows whose key is not there yet."""
    old = _read_or_none(spark, target)
    rows = source if on is None or old is None else missing_from(source, old, on)
    append_rows(rows, target)
    return spark.read.parquet(target).count()


def add_to_staging(df: DataFrame, staging: str, flag: str = "processed_flag") -> None:
    """Append rows to a queue table kept in one folder per flag; new rows are flagged ``N``."""
    rows = df if flag in df.columns else df.withColumn(flag, F.lit("N"))
    rows.write.mode("append").partitionBy(flag).parquet(staging)


def waiting_rows(spark: SparkSession, staging: str, flag: str = "processed_flag") -> DataFrame | None:
    """Rows flagged ``N``; None when there are none."""
    folder = f"{staging}/{flag}=N"
    return spark.read.parquet(folder) if list_files(spark, folder) else None


def _settle(spark: SparkSession, staging: str, targets: Mapping[str, Sequence[str]], root: str,
            log_path: str, flag: str) -> None:
    """Finish or undo a flagged load that was cut short: with its audit row it is done and the files are
    turned; without, its rows are removed."""
    note = f"{staging}/_pending/note"
    if not path_exists(spark, note):
        return
    run, *names = [r["value"] for r in spark.read.text(note).collect()]
    if path_exists(spark, f"{log_path}/run_id={run}"):
        make_dirs(spark, f"{staging}/{flag}=Y")
        for name in names:
            if path_exists(spark, f"{staging}/{flag}=N/{name}"):
                rename(spark, f"{staging}/{flag}=N/{name}", f"{staging}/{flag}=Y/run-{run}-{name}")
    else:
        for target in targets:
            delete_path(spark, f"{root}/{target}/run_id={run}")
    delete_path(spark, note)


def load_flagged(spark: SparkSession, staging: str, targets: Mapping[str, Sequence[str]], root: str,
                 log_path: str, run_id: int, flag: str = "processed_flag", load_id: str = "load_id") -> str:
    """Rows flagged ``N`` into several targets, one audit row per load and target, then flag ``Y``.

    The flag is the folder, so turning it moves the files that were read and rewrites nothing; rows that
    arrive meanwhile stay ``N``. A note of these files and the audit rows make a run that was cut short
    either count once or not at all.
    """
    _settle(spark, staging, targets, root, log_path, flag)
    waiting = waiting_rows(spark, staging, flag)
    if waiting is None or waiting.isEmpty():
        return "nothing waits"
    names = [f.rsplit("/", 1)[-1] for f in waiting.inputFiles()]
    write_text(spark, f"{staging}/_pending/note", "\n".join([str(run_id), *names]))
    places = {name: (f"{root}/{name}/run_id={run_id}", list(dict.fromkeys([load_id, *columns])))
              for name, columns in targets.items()}
    load_targets(waiting, places, "overwrite")
    measured = {name: spark.read.parquet(path) for name, (path, _) in places.items()}
    (load_target_audit(waiting, load_id, measured).withColumn("status", F.lit("SUCCESS"))
     .write.mode("overwrite").parquet(f"{log_path}/run_id={run_id}"))
    _settle(spark, staging, targets, root, log_path, flag)
    return "loaded"


CHECK_SCHEMA = ("check_id int, checked_at timestamp_ntz, waiting_rows bigint, found string, "
                "quiet_checks bigint, action string, note string")


def check_and_load(spark: SparkSession, staging: str, checks: str, targets: Mapping[str, Sequence[str]],
                   root: str, log_path: str, as_of: dt.datetime, threshold: int = 3) -> str:
    """One quiet-period check over the flagged rows; loads once they have been quiet long enough."""
    waiting = waiting_rows(spark, staging)
    count = 0 if waiting is None else waiting.count()
    log = _read_or_none(spark, checks)
    last = None if log is None else log.orderBy(F.col("check_id").desc()).limit(1).first()
    check_id = 1 if last is None else last["check_id"] + 1
    previous = None if last is None else (last["waiting_rows"], last["quiet_checks"])
    found, quiet, action = next_check(previous, count, threshold)
    row = (check_id, as_of, count, found, quiet, action, "task check")
    spark.createDataFrame([row], CHECK_SCHEMA).coalesce(1).write.mode("append").parquet(checks)
    if action == CALL:
        load_flagged(spark, staging, targets, root, log_path, check_id)
    return action


def export_one(df: DataFrame, folder: str, name: str) -> str:
    """A table to one named file with a header."""
    return export_named(df, folder, name, FileFormat(header=True))


def export_each(tables: Mapping[str, tuple[DataFrame, str]], name: str = "data.csv") -> list[str]:
    """Several tables, each to a named file in its own place."""
    return [export_one(df, folder, name) for df, folder in tables.values()]


def export_partitions(tables: Mapping[str, DataFrame], root: str) -> list[str]:
    """Several tables, a named file in a sub-folder of one root each."""
    return [export_one(df, f"{root.rstrip('/')}/{name}", f"{name}.csv") for name, df in tables.items()]


def batch_load(load: FileLoad, load_id: str, as_of: dt.datetime | None = None) -> RunResult:
    """Typed file load with its history row."""
    result = RunResult(load_id, "batch_load")
    row = load.run(load_id, as_of).agg(F.coalesce(F.sum("rows_parsed"), F.lit(0)),
                                       F.coalesce(F.sum("rows_loaded"), F.lit(0))).first()
    result.source_count, result.target_count = row[0], row[1]
    return result


def raw_to_final(raw: DataFrame, upper: Sequence[str], measure: str,
                 limits: Sequence[tuple[float, str]], default: str = "LOW", out: str = "category") -> DataFrame:
    """Raw rows with upper-case text columns and a band."""
    columns = [F.upper(c).alias(c) if c in upper else F.col(c) for c in raw.columns]
    return raw.select(*columns).withColumn(out, band(measure, limits, default))


def transformation_set(df: DataFrame, by: str, measure: str, rate: float,
                       limits: Sequence[tuple[float, str]], only: str) -> dict[str, DataFrame]:
    """Uplifted and banded rows, the rows of one group, and the group summary."""
    raised = df.withColumn("raised", F.col(measure) * F.lit(rate)).withColumn(
        "band", band(measure, limits, "LOW"))
    return {"transformed": raised, "one_group": df.where(F.col(by) == only),
            "summary": group_summary(df, [by], measure)}


def upsert_folder(spark: SparkSession, target: str, source: DataFrame, keys: Sequence[str],
                  stamp: Mapping[str, Column] | None = None) -> None:
    """MERGE into a Parquet folder, by a staged swap."""
    recover(spark, target)
    replace(upsert(spark.read.parquet(target), source, keys, stamp), target)


def upsert_partitions(spark: SparkSession, target: str, source: DataFrame, keys: Sequence[str],
                      partition_by: Sequence[str], stamp: Mapping[str, Column] | None = None) -> None:
    """MERGE into a partitioned folder, rewriting only the partitions that the source touches.

    These are the source's own and those that hold its keys now, found by a scan of keys and partition
    columns alone, so a key that moves leaves no old row behind."""
    touched = source.select(*partition_by)
    if path_exists(spark, target):
        types = {c: source.schema[c].dataType for c in partition_by}
        held = spark.read.parquet(target).select(*keys, *[c for c in partition_by if c not in keys])
        moved = held.join(source.select(*keys).distinct(), list(keys), "left_semi")
        touched = touched.union(moved.select(*[F.col(c).cast(types[c]).alias(c) for c in partition_by]))
    rewrite_partitions(spark, target, partition_by, touched,
                       lambda rows: upsert(rows, source, keys, stamp), source.schema)


def run_scd2(spark: SparkSession, root: str, source: DataFrame, keys: Sequence[str],
             as_of: dt.datetime) -> DataFrame:
    """SCD2 over a history kept as ``root/current`` and ``root/closed/closed_at=…``; gives the history.

    A run reads and rewrites the current versions only and adds one folder of closed ones, so its cost
    does not grow with the history. A run can be repeated with the same ``as_of``, whether it was cut short
    or not: closed versions are only ever added.
    """
    root = root.rstrip("/")
    current, closed = f"{root}/current", f"{root}/closed"
    recover(spark, current)
    assert_unique(source, keys)
    if not path_exists(spark, current):
        reload(scd2_initial(source, as_of), current)
    else:
        with working_tables(spark):
            rows = durable(scd2_changes(spark.read.parquet(current), source, keys, as_of), "scd2")
            ended = rows.where(~F.col("is_current"))
            folder = f"{closed}/closed_at={as_of:%Y%m%d%H%M%S%f}"
            if path_exists(spark, folder):
                # A repeat, or another run of the same moment: only what the folder lacks is added.
                held = spark.read.schema(rows.schema).parquet(folder)
                ended = missing_from(ended, held, [*keys, "valid_from"], null_safe=True)
            ended.write.mode("append").parquet(folder)
            replace(rows.where(F.col("is_current")), current)
    open_rows = spark.read.parquet(current)
    if not path_exists(spark, closed):
        return open_rows
    return open_rows.unionByName(spark.read.schema(open_rows.schema).parquet(f"{closed}/closed_at=*"))


def layer_run(spark: SparkSession, raw: DataFrame, refined: str, dated: str, as_of: dt.datetime,
              name: str, zone: str = "UTC") -> str:
    """Raw scan to the stamped refined layer, on to the dated layer, then the completion marker."""
    folder = to_refined(raw, refined, as_of, zone)
    to_dated(spark.read.parquet(folder), dated, "ingest_ts")
    return mark_complete(spark, dated, name)


def marked_duplicate_report(spark: SparkSession, folder: str, marker: str, schema: T.StructType,
                            measure: str, glob: str = "*.txt") -> DuplicateReport | None:
    """Duplicate report over the text files of a folder, once its marker is there."""
    rows = read_when_marked(spark, folder, marker, glob, schema=schema, numbered=True)
    if rows is None:
        return None
    return duplicate_report(rows, schema.names, ["source_file", "row_in_file"], measure)


__all__ = [
    "Star", "add_to_staging", "batch_load", "check_and_load", "copy_table", "export_each", "export_many", "export_one",
    "export_partitions", "export_under", "layer_run", "load_flagged", "load_star",
    "marked_duplicate_report", "normalise_flat", "raw_to_final", "refine_then_star", "run_star_new",
    "run_scd2", "run_star_once", "stage_file", "stage_then_star", "transformation_set", "upsert_folder",
    "upsert_partitions", "waiting_rows",
]
