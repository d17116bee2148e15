"""Readers. Each gives a lazy DataFrame; files are split and read by the executors."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pipekit.functions.text import is_safe_name, split_fields
from pipekit.sinks.files import list_files, path_exists
from pipekit.sources.formats import ON_ERROR, FileFormat, Stage
from pipekit.sources.numbered import BAD_RECORD, first_line, numbered_lines, parse_lines, read_numbered_csv
from pipekit.sources.provenance import inventory, source_file


def read_csv(spark: SparkSession, path: str | Sequence[str], fmt: FileFormat = FileFormat(), *,
             schema: T.StructType | str | None = None, infer: bool = False,
             names: Sequence[str] | None = None, on_error: str = "abort",
             check_header: bool = False, glob: str | None = None) -> DataFrame:
    """Delimited files, one or many.

    ``schema`` types the columns by position and never samples the data; ``infer`` reads the files a
    first time to find types; neither gives all strings. ``names`` renames by position.
    ``check_header`` fails when the header names differ from the schema. ``on_error`` is ``abort``,
    ``continue`` (bad rows left out) or ``report`` (kept, with the raw text in ``_corrupt_record`` if
    the schema holds that column).
    """
    reader = spark.read.options(**fmt.reader_options()).option("mode", ON_ERROR[on_error])
    if schema is not None:
        reader = reader.schema(schema).option("enforceSchema", not check_header)
    elif infer:
        reader = reader.option("inferSchema", True)
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    df = reader.csv(path if isinstance(path, str) else list(path))
    return df.toDF(*names) if names else df


def read_stage_file(spark: SparkSession, stage: Stage, name: str, schema: T.StructType | str,
                    **options) -> DataFrame:
    """One named file of a stage, after a check that the name is safe in a path."""
    if not is_safe_name(name):
        raise ValueError(f"unsafe file name: {name!r}")
    return read_csv(spark, stage.child(name).path, stage.format, schema=schema, **options)


def with_bad_record(schema: T.StructType) -> T.StructType:
    """The schema plus the column that takes the text of a row that does not parse."""
    return T.StructType(schema.fields + [T.StructField(BAD_RECORD, T.StringType())])


def bad_rows(spark: SparkSession, path: str | Sequence[str], schema: T.StructType,
             fmt: FileFormat = FileFormat()) -> DataFrame:
    """Parse the files and return only the rows that do not fit; saves nothing.

    Spark refuses a raw scan of the bad-record column alone, so the filter also looks at the others.
    """
    df = read_csv(spark, path, fmt, schema=with_bad_record(schema), on_error="report")
    shown = df.select(source_file().alias("source_file"), F.col(BAD_RECORD).alias("bad_record"),
                      F.to_json(F.struct(*schema.names)).alias("parsed"))
    return shown.where(F.col("bad_record").isNotNull() & F.col("parsed").isNotNull())


def read_json(spark: SparkSession, path: str | Sequence[str], *,
              schema: T.StructType | str | None = None, multi_line: bool = False, on_error: str = "abort") -> DataFrame:
    """JSON lines, a one-line array (one row per element), or pretty-printed files with
    ``multi_line`` (each such file is read by one task). A malformed record ends the scan, or is left out
    (``continue``), or becomes a row of NULLs (``report``)."""
    reader = spark.read.option("multiLine", multi_line).option("mode", ON_ERROR[on_error])
    if schema is not None:
        reader = reader.schema(schema)
    return reader.json(path if isinstance(path, str) else list(path))


def read_lines(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    """One row per line, column ``value``."""
    return spark.read.text(path if isinstance(path, str) else list(path))


def read_delimited(lines: DataFrame, pattern: str, fields: Sequence[tuple[str, str]],
                   tolerant: bool = False) -> DataFrame:
    """Lines split on a regex into trimmed, typed, named columns."""
    return lines.select(*split_fields("value", pattern, fields, tolerant))


def read_fixed_width(lines: DataFrame, layout: Sequence[tuple[str, int, int, str]],
                     tolerant: bool = False) -> DataFrame:
    """Lines cut at (name, 1-based start, length, type)."""
    columns = []
    for name, start, length, kind in layout:
        value = F.trim(F.col("value").substr(start, length))
        columns.append((value.try_cast(kind) if tolerant else value.cast(kind)).alias(name))
    return lines.select(*columns)


def read_parquet(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    """Parquet files; filters and column lists reach the scan."""
    return spark.read.parquet(*([path] if isinstance(path, str) else path))


def read_tables(spark: SparkSession, paths: Mapping[str, str], fmt: FileFormat = FileFormat(),
                schemas: Mapping[str, T.StructType | str] | None = None) -> dict[str, DataFrame]:
    """One file set per table."""
    schemas = schemas or {}
    return {name: read_csv(spark, path, fmt, schema=schemas.get(name), infer=name not in schemas)
            for name, path in paths.items()}


def read_directory(spark: SparkSession, path: str, schemas: Mapping[str, T.StructType | str] | None = None,
                   pretty_json: bool | None = None) -> dict[str, DataFrame]:
    """All known formats of a mixed folder: one DataFrame per format, for its files of any case.

    Unknown extensions are skipped. Keys are csv, json, txt, parquet, xlsx. JSON files hold one document each with
    ``pretty_json``, else a record on each line; without a word, they do where no schema is given. A file of the
    other kind ends the scan.
    """
    from pipekit.sources.workbook import read_workbooks
    schemas = schemas or {}
    groups: dict[str, list[str]] = {}
    for file in list_files(spark, path):
        kind = file.rsplit(".", 1)[-1].lower()
        groups.setdefault(kind, []).append(file)
    out = {}
    for kind, files in sorted(groups.items()):
        schema = schemas.get(kind)
        if kind in ("csv", "txt"):
            out[kind] = read_csv(spark, files, schema=schema, infer=schema is None)
        elif kind == "json":
            out[kind] = read_json(spark, files, schema=schema, multi_line=(
                schema is None) if pretty_json is None else pretty_json)
        elif kind == "parquet":
            out[kind] = read_parquet(spark, files)
        elif kind == "xlsx":
            out[kind] = read_workbooks(spark, files, schema)
    return out


class MarkerMissing(Exception):
    """The inputs exist but their marker file does not, so there is no work yet."""


def read_when_marked(spark: SparkSession, folder: str, marker: str, glob: str = "*.txt",
                     fmt: FileFormat = FileFormat(sep="|"), schema: T.StructType | str | None = None,
                     numbered: bool = False) -> DataFrame | None:
    """The inputs of a folder, once a marker file says they are complete.

    No marker gives None (no work); a marker without inputs is an error. With ``numbered`` each row has its
    ``source_file`` and ``row_in_file``.
    """
    if not path_exists(spark, f"{folder}/{marker}"):
        return None
    if not any(glob_match(f, glob) for f in list_files(spark, folder)):
        raise FileNotFoundError(f"marker {marker} without {glob} inputs in {folder}")
    if numbered:
        return read_numbered_csv(spark, folder, schema, fmt, glob=glob)
    return read_csv(spark, folder, fmt, schema=schema, glob=glob)


def glob_match(path: str, glob: str) -> bool:
    from fnmatch import fnmatchcase
    return fnmatchcase(path.rsplit("/", 1)[-1], glob)


def merge_text_files(spark: SparkSession, folder: str, sep: str = "|", glob: str = "*.txt",
                     check_header: bool = False) -> DataFrame:
    """All delimited text files of a folder as strings, with ``source_file``.

    The first non-blank line of the first file (in name order) that has one names the columns. In every file the first
    non-blank line is its header and is dropped by its place, whatever it says; with ``check_header`` other words in it
    end the job. Empty and blank files add nothing; blank lines are no rows.
    """
    files = sorted(f for f in list_files(spark, folder) if glob_match(f, glob))
    header = first_line(spark, files)
    if header is None:
        raise FileNotFoundError("no valid data in text files")
    schema = T.StructType([T.StructField(name.strip(), T.StringType()) for name in header.split(sep)])
    row = (F.trim("value") != "") & (F.col("row_in_file") > F.col("first_row"))
    if check_header:
        differs = (F.col("row_in_file") == F.col("first_row")) & (F.col("value") != F.lit(header))
        row = F.when(differs, F.raise_error(F.concat(F.lit("another header: "), "value")).cast("boolean")).otherwise(row)
    return parse_lines(numbered_lines(spark, folder, glob), schema, FileFormat(sep=sep), "report", ["source_file"],
                       row).select(*schema.names, "source_file")


@dataclass(frozen=True)
class Gated:
    """What a file gate let through: a success status either way, the rows if there were files, and what was passed by."""

    status: str
    accepted: DataFrame
    skipped: DataFrame
    lines: DataFrame | None


def gate_files(spark: SparkSession, folder: str, extension: str = ".txt") -> Gated:
    """Read only files with an extension, of any case; other files are no error, they are passed by and listed.

    ``status`` is ``SUCCESS`` with files read and ``SUCCESS: NOTHING TO DO`` without. Files are told by their names, so
    what is passed by is never opened.
    """
    files = inventory(spark, folder).select("path", "file_name", "length")
    fits = F.lower(F.col("file_name")).endswith(extension.lower())
    accepted, skipped = files.where(fits), files.where(~fits)
    if accepted.isEmpty():
        return Gated("SUCCESS: NOTHING TO DO", accepted, skipped, None)
    glob = "*" + "".join(f"[{c.lower()}{c.upper()}]" if c.isalpha() else c for c in extension)
    lines = spark.read.option("pathGlobFilter", glob).option("recursiveFileLookup", True).text(folder)
    return Gated("SUCCESS", accepted, skipped, lines.select("value", source_file().alias("source_file")))


def complete_batches(inventory: DataFrame, batch_of: str = r"batch_([0-9-]+)", marker: str = ".ctl",
                     ) -> DataFrame:
    """Data files of those batches whose marker file has arrived."""
    files = inventory.withColumn("batch", F.regexp_extract("file_name", batch_of, 1))
    done = files.where(F.col("file_name").endswith(marker)).select("batch").distinct()
    return files.where(~F.col("file_name").endswith(marker) & (F.col("batch") != "")).join(
        done, "batch", "left_semi")
