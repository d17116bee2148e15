"""Workbook (.xlsx) scan: first sheet, first row as header, many workbooks in parallel."""

from __future__ import annotations

import io
import re
import sys
import zipfile
from collections.abc import Iterator, Sequence
from xml.etree import ElementTree

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The task-side functions travel with the plan, so executors need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

_NS = {"m": "http://schemas.openxmlformats.org/spreadsheetml/2006/main"}


def _column_index(ref: str) -> int:
    index = 0
    for letter in re.match(r"[A-Z]+", ref).group():
        index = index * 26 + ord(letter) - 64
    return index - 1


def _sheet_rows(content: bytes) -> Iterator[list[str | None]]:
    with zipfile.ZipFile(io.BytesIO(content)) as book:
        names = set(book.namelist())
        shared = []
        if "xl/sharedStrings.xml" in names:
            for item in ElementTree.fromstring(book.read("xl/sharedStrings.xml")).findall("m:si", _NS):
                shared.append("".join(t.text or "" for t in item.iter(f"{{{_NS['m']}}}t")))
        sheet = min((n for n in names if re.match(r"xl/worksheets/sheet\d+\.xml$", n)),
                    key=lambda n: int(re.search(r"\d+", n.rsplit("/", 1)[-1]).group()))
        with book.open(sheet) as stream:
            for _, row in ElementTree.iterparse(stream):
                if row.tag != f"{{{_NS['m']}}}row":
                    continue
                cells: list[str | None] = []
                for i, cell in enumerate(row.findall("m:c", _NS)):
                    at = _column_index(cell.get("r")) if cell.get("r") else i
                    cells.extend([None] * (at + 1 - len(cells)))
                    value = cell.find("m:v", _NS)
                    if cell.get("t") == "inlineStr":
                        cells[at] = "".join(t.text or "" for t in cell.iter(f"{{{_NS['m']}}}t"))
                    elif value is not None:
                        cells[at] = shared[int(value.text)] if cell.get("t") == "s" else value.text
                yield cells
                row.clear()


def parse_workbooks(files: DataFrame, schema: T.StructType | str, batch_rows: int = 10_000) -> DataFrame:
    """Rows of the first sheet of every workbook in a ``path, content`` table.

    The header row picks the columns by name; values are read as text and cast on the JVM side.
    """
    target = (T.StructType.fromDDL(schema) if isinstance(schema, str) else schema)
    names = target.names

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for path, content in zip(batch["path"], batch["content"]):
                rows = _sheet_rows(bytes(content))
                header = [(h or "").strip() for h in next(rows, [])]
                missing = [n for n in names if n not in header]
                if header and missing:
                    raise ValueError(f"{path}: no column {missing}")
                places = [header.index(n) for n in names] if header else []
                chunk: list[list[str | None]] = []
                for cells in rows:
                    chunk.append([path] + [cells[p] if p < len(cells) else None for p in places])
                    if len(chunk) == batch_rows:
                        yield pd.DataFrame(chunk, columns=["source_path", *names], dtype=object)
                        chunk = []
                if chunk:
                    yield pd.DataFrame(chunk, columns=["source_path", *names], dtype=object)

    text = "source_path string, " + ", ".join(f"`{n}` string" for n in names)
    raw = files.select("path", "content").mapInPandas(read, text)
    return raw.select("source_path", *[F.col(f"`{f.name}`").cast(f.dataType).alias(f.name) for f in target])


def read_workbooks(spark: SparkSession, path: str | Sequence[str], schema: T.StructType | str | None = None,
                   ) -> DataFrame:
    """All workbooks of a folder or list. Without a schema the header of the first one is used and all
    columns are strings."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.[xX][lL][sS][xX]").load(
        path if isinstance(path, str) else list(path))
    if schema is None:
        first = files.orderBy("path").limit(1).mapInPandas(
            lambda batches: (pd.DataFrame({"h": [[(c or "").strip() for c in next(_sheet_rows(bytes(x)), [])]]})
                             for b in batches for x in b["content"]), "h array<string>").collect()
        schema = T.StructType([T.StructField(n, T.StringType()) for n in first[0]["h"]])
    return parse_workbooks(files, schema)
