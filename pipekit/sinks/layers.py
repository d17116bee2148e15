"""Layered copies (raw, refined, dated), completion markers, folder routing."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence
from zoneinfo import ZoneInfo

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pipekit.functions.text import base_name, first_segment, plain_path
from pipekit.functions.times import as_of_column
from pipekit.sinks.files import make_dirs, path_exists, write_text


def run_folder(root: str, as_of: dt.datetime, zone: str = "UTC") -> str:
    """``root/run_2024-01-31_23-59-59``, the wall clock of a fixed zone; ``as_of`` is UTC."""
    local = as_of.replace(tzinfo=dt.timezone.utc).astimezone(ZoneInfo(zone))
    return f"{root.rstrip('/')}/run_{local:%Y-%m-%d_%H-%M-%S}"


def stamp_rows(df: DataFrame, as_of: dt.datetime | Column) -> DataFrame:
    """Add ``ingest_ts`` and ``source_file`` to scanned rows."""
    return df.select("*", as_of_column(as_of).alias("ingest_ts"),
                     plain_path("_metadata.file_name").alias("source_file"))


def to_refined(df: DataFrame, root: str, as_of: dt.datetime, zone: str = "UTC") -> str:
    """Raw scan to the next layer, under a stamped run folder; gives that folder."""
    path = run_folder(root, as_of, zone)
    stamp_rows(df, as_of).write.mode("overwrite").parquet(path)
    return path


def add_date_parts(df: DataFrame, ts: str | Column) -> DataFrame:
    """``year``, ``month``, ``day`` columns for a dated layout."""
    ts = F.col(ts) if isinstance(ts, str) else ts
    return df.select("*", F.date_format(ts, "yyyy").alias("year"), F.date_format(ts, "MM").alias("month"),
                     F.date_format(ts, "dd").alias("day"))


def to_dated(df: DataFrame, root: str, ts: str | Column, spread: Sequence[str] = ()) -> None:
    """Layer partitioned by ``year/month/day``; rewritten dates replace their old folder.

    Rows are clustered by date before the write so that a task writes few folders; AQE splits a date
    that is much larger than the others. ``spread`` adds columns to the clustering.
    """
    parts = ["year", "month", "day"]
    dated = add_date_parts(df, ts).hint("rebalance", *parts, *spread)
    (dated.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy(*parts).parquet(root))


def mark_complete(spark: SparkSession, folder: str, name: str, content: str = "") -> str:
    """Leave ``_status/<name>_SUCCESS`` (fixed value); readers skip folders that start with an underscore."""
    make_dirs(spark, f"{folder}/_status")
    marker = f"{folder}/_status/{name}_SUCCESS"
    write_text(spark, marker, content)
    return marker


def is_complete(spark: SparkSession, folder: str, name: str) -> bool:
    """One look at the marker."""
    return path_exists(spark, f"{folder}/_status/{name}_SUCCESS")


def route(df: DataFrame, path: Column | str, routes: Mapping[str, str]) -> DataFrame:
    """Add ``folder`` and the ``handler`` its first path segment selects; NULL for unknown folders."""
    folder = first_segment(path)
    table = F.create_map(*[F.lit(x) for pair in routes.items() for x in pair])
    return df.withColumn("folder", folder).withColumn("handler", F.try_element_at(table, F.col("folder")))


def split_routes(df: DataFrame, path: Column | str, routes: Mapping[str, str],
                 ) -> tuple[dict[str, DataFrame], DataFrame]:
    """One DataFrame per handler, and the rejected rows."""
    routed = route(df, path, routes)
    return ({h: routed.where(F.col("handler") == h) for h in dict.fromkeys(routes.values())},
            routed.where(F.col("handler").isNull()))


def text_to_table(df: DataFrame, path: str) -> None:
    """A delimited-text scan saved as a table, all columns as text."""
    df.select(*[F.col(c).cast("string").alias(c) for c in df.columns]).write.mode("overwrite").parquet(path)


def renamed_copy(file: Column | str, as_of: dt.datetime, zone: str) -> Column:
    """File name with a wall-clock stamp before its extension."""
    local = as_of.replace(tzinfo=dt.timezone.utc).astimezone(ZoneInfo(zone))
    return F.regexp_replace(base_name(file), r"^(.+?)(\.[^.]*)?$", f"$1_{local:%Y-%m-%d_%H-%M-%S}$2")
