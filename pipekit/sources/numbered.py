"""Lines with their place in the file, numbered before they are parsed.

A parser drops and joins lines as it sees fit, so a number given after it is not the line's place. Here lines are
numbered as text and parsed after that: whatever the parser makes of a line, its number stays.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pipekit.sources.formats import FileFormat
from pipekit.sources.provenance import number_rows, source_file

BAD_RECORD = "_corrupt_record"


def numbered_lines(spark: SparkSession, path: str | Sequence[str], glob: str | None = None) -> DataFrame:
    """(value, source_file, row_in_file, first_row): every line of the files, blank ones too, with its 1-based place
    and the place of the first line of its file that is not blank (null if there is none)."""
    reader = spark.read.option("pathGlobFilter", glob) if glob else spark.read
    scan = reader.text(path if isinstance(path, str) else list(path)).select(
        "value", F.col("_metadata.file_path").alias("__file"), source_file().alias("source_file"),
        F.col("_metadata.file_block_start").alias("__block"))
    return number_rows(scan, 1, first_row=F.trim("value") != "")


def typed(schema: T.StructType | str) -> T.StructType:
    return T.StructType.fromDDL(schema) if isinstance(schema, str) else schema


def parse_lines(lines: DataFrame, schema: T.StructType | str, fmt: FileFormat = FileFormat(), on_error: str = "abort",
                keep: Sequence[str] = ("source_file", "row_in_file"), only: Column | None = None) -> DataFrame:
    """Lines (``value``) parsed into typed columns, with the ``keep`` columns beside them; ``only`` says which lines
    are rows at all.

    ``on_error`` is ``abort`` (a line that does not fit ends the job), ``continue`` (such lines are left out) or
    ``report`` (they stay, with their text in ``_corrupt_record`` and NULL where a field does not parse).
    """
    schema = typed(schema)
    if on_error not in ("abort", "continue", "report"):
        raise ValueError(f"on_error must be abort, continue or report, not {on_error!r}")
    options = {k: v for k, v in fmt.reader_options().items() if k != "header"}
    wanted = T.StructType([f for f in schema.fields if f.name != BAD_RECORD])
    full = T.StructType([*wanted.fields, T.StructField(BAD_RECORD, T.StringType())])
    # The generator has each line parsed once and whole; taken straight from from_csv, a column would have only its own
    # field parsed, and a line whose other fields do not fit would pass.
    parsed = lines.withColumn("__row", F.explode(F.array(F.from_csv("value", full.toDDL(), {
        **options, "mode": "PERMISSIVE", "columnNameOfCorruptRecord": BAD_RECORD}))))
    bad, only = F.col(f"__row.{BAD_RECORD}"), F.lit(True) if only is None else only
    if on_error == "abort":
        # One expression: as filters of their own, the failing one could be moved before the other.
        parsed = parsed.where(F.when(~only, False).when(bad.isNull(), True).otherwise(F.raise_error(F.concat(
            F.lit("MALFORMED line: "), bad)).cast("boolean")))
    else:
        parsed = parsed.where(only & bad.isNull() if on_error == "continue" else only)
    columns = [*wanted.names, BAD_RECORD] if on_error == "report" else wanted.names
    return parsed.select(*[F.col("__row").getField(c).alias(c) for c in columns], *keep)


def read_numbered_csv(spark: SparkSession, path: str | Sequence[str], schema: T.StructType | str,
                      fmt: FileFormat = FileFormat(), on_error: str = "abort", glob: str | None = None) -> DataFrame:
    """Delimited files with ``source_file`` and ``row_in_file``, the line's 1-based place whatever the error policy.

    With a header the first line that is not blank is not a row; blank lines are none either, but count as places.
    A record is one line.
    """
    row = F.trim("value") != ""
    if fmt.header:
        row = row & (F.col("row_in_file") > F.col("first_row"))
    return parse_lines(numbered_lines(spark, path, glob), schema, fmt, on_error, only=row)


def first_line(spark: SparkSession, files: Sequence[str]) -> str | None:
    """The first line that is not blank of the first file that has one; files are tried in growing groups, so many
    files without one cost few jobs."""
    size = 1
    while files:
        some, files = files[:size], files[size:]
        lines = spark.read.text(some).select(
            "value", F.struct("_metadata.file_path", "_metadata.file_block_start", F.monotonically_increasing_id()).alias("at"),
        ).where(F.trim("value") != "")
        if size == 1:
            # Splits of one file are read in order, so no more than its head is scanned.
            found = lines.limit(1).first()
        else:
            found = lines.agg(F.min_by("value", "at").alias("value")).first()
        if found is not None and found["value"] is not None:
            return found["value"]
        size *= 4
    return None
