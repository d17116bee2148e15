"""Scans of files and literal rows, row provenance, file events."""

from pipekit.sources.formats import FileFormat, Stage
from pipekit.sources.scans import (read_csv, read_delimited, read_directory, read_fixed_width,
                                   read_json, read_lines, read_parquet, read_tables)

__all__ = ["FileFormat", "Stage", "read_csv", "read_delimited", "read_directory", "read_fixed_width",
           "read_json", "read_lines", "read_parquet", "read_tables"]
