"""Text and path expressions."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Fixed value: the characters a file or object name may hold.
SAFE_NAME = r"^[A-Za-z0-9._/-]+$"


def _col(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def base_name(path: Column | str) -> Column:
    """Last part of a path: ``a/b/c.txt`` gives ``c.txt``."""
    return F.substring_index(_col(path), "/", -1)


def stem(path: Column | str) -> Column:
    """Base name without its last extension."""
    return F.regexp_replace(base_name(path), r"(?<=.)\.[^.]*$", "")


def extension(path: Column | str) -> Column:
    """Lower-case extension with its dot, or an empty string."""
    return F.lower(F.regexp_extract(base_name(path), r".(\.[^.]*)$", 1))


def first_segment(path: Column | str) -> Column:
    """Text before the first slash."""
    return F.substring_index(_col(path), "/", 1)


def last_segment(path: Column | str) -> Column:
    """Text after the last slash."""
    return F.element_at(F.split(_col(path), "/"), -1)


def decode_key(key: Column | str) -> Column:
    """URL-decoded object key; ``+`` becomes a space."""
    return F.url_decode(_col(key))


def plain_path(path: Column | str) -> Column:
    """A file path or name as it is on the store; Spark's file metadata shows it URL-encoded."""
    return F.url_decode(F.replace(_col(path), F.lit("+"), F.lit("%2B")))


def relative_path(path: Column | str, root: str) -> Column:
    """The part of a path below a root folder."""
    marker = re.sub(r"^file:/+", "/", root).rstrip("/") + "/"
    return F.element_at(F.split(_col(path), f"\\Q{marker}\\E", 2), -1)


def size_kb(size: Column | str) -> Column:
    """Bytes as kilobytes with two decimals."""
    return F.round(_col(size) / F.lit(1024), 2)


def safe_name(name: Column | str) -> Column:
    """True when a file name holds only characters that are safe in a path."""
    return F.coalesce(_col(name).rlike(SAFE_NAME), F.lit(False))


def is_safe_name(name: str) -> bool:
    """Driver-side form of :func:`safe_name` for one argument of a job."""
    return bool(re.match(SAFE_NAME, name)) and ".." not in name.split("/")


def split_fields(line: Column | str, pattern: str, fields: Sequence[tuple[str, T.DataType | str]],
                 tolerant: bool = False) -> list[Column]:
    """Columns of a delimited line: split on a regex, trim, cast, name by position.

    With ``tolerant`` a short line or a bad value gives NULL instead of an error.
    """
    parts = F.split(_col(line), pattern)
    out = []
    for i, (name, kind) in enumerate(fields):
        value = F.trim(F.get(parts, F.lit(i)) if tolerant else parts.getItem(i))
        out.append((value.try_cast(kind) if tolerant else value.cast(kind)).alias(name))
    return out


def coded_label(prefix: str, number: Column | str, width: int = 2) -> Column:
    """Prefix plus zero-padded number. Numbers longer than ``width`` are never cut short."""
    digits = _col(number).cast("string")
    padded = F.when(F.length(digits) >= width, digits).otherwise(F.lpad(digits, width, "0"))
    return F.concat(F.lit(prefix), padded)


def tolerant_number(value: Column | str) -> Column:
    """Text as double, NULL when it does not parse."""
    return _col(value).try_cast("double")


def json_fields(text: Column | str, schema: T.StructType | str) -> Column:
    """JSON text as a struct."""
    return F.from_json(_col(text), schema)


def row_digest(columns: Sequence[str | Column]) -> Column:
    """256-bit digest of several columns. Lengths keep neighbours apart; NULL differs from ''."""
    parts = []
    for column in columns:
        text = _col(column).cast("string")
        parts.append(F.coalesce(F.concat(F.length(text).cast("string"), F.lit(":"), text), F.lit("~")))
    return F.unhex(F.sha2(F.concat_ws("|", *parts), 256))
