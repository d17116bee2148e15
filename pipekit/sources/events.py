"""File-arrival events: two JSON layouts, and pattern filters."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pipekit.functions.text import decode_key

OBJECT = "struct<bucket: struct<name: string>, object: struct<key: string, size: bigint>>"
RECORDS_SCHEMA = f"Records array<struct<eventName: string, eventTime: string, s3: {OBJECT}>>"
ENVELOPE_SCHEMA = f"`detail-type` string, source string, time string, detail {OBJECT}"


def record_events(df: DataFrame, column: str = "value") -> DataFrame:
    """One row per entry of ``Records``; the other columns of ``df`` are kept."""
    parsed = df.withColumn("__r", F.explode(F.from_json(column, RECORDS_SCHEMA)["Records"]))
    return parsed.select(
        *[c for c in df.columns if c != column], F.col("__r.s3.bucket.name").alias("bucket"),
        decode_key(F.col("__r.s3.object.key")).alias("object_key"),
        F.col("__r.s3.object.size").alias("size"), F.col("__r.eventName").alias("event_name"),
        F.col("__r.eventTime").alias("event_time"))


def envelope_events(df: DataFrame, column: str = "value") -> DataFrame:
    """One row per event with its envelope fields; the other columns of ``df`` are kept."""
    parsed = df.withColumn("__e", F.from_json(column, ENVELOPE_SCHEMA))
    return parsed.select(
        *[c for c in df.columns if c != column], F.col("__e.detail-type").alias("detail_type"),
        F.col("__e.source").alias("source"), F.col("__e.time").alias("event_time"),
        F.col("__e.detail.bucket.name").alias("bucket"), F.col("__e.detail.object.key").alias("object_key"),
        F.col("__e.detail.object.size").alias("size"))


def matches(pattern: Mapping[str, Sequence[str]]) -> Column:
    """True when every listed column holds one of its listed values."""
    return reduce(lambda a, b: a & b, [F.col(c).isin(list(values)) for c, values in pattern.items()])


def filter_events(df: DataFrame, pattern: Mapping[str, Sequence[str]]) -> DataFrame:
    return df.where(matches(pattern))
