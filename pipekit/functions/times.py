"""Date and time expressions. Timestamps are zone-less and read as UTC."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

from pipekit.functions.text import _col


def as_of_column(as_of: dt.datetime | Column | None) -> Column:
    """The one clock reading of a run, as a zone-less timestamp column."""
    if as_of is None:
        return F.current_timestamp().cast("timestamp_ntz")
    if isinstance(as_of, Column):
        return as_of.cast("timestamp_ntz")
    return F.lit(as_of.isoformat(sep=" ")).cast("timestamp_ntz")


def add_time(ts: Column | str, days: int = 0, hours: int = 0, minutes: int | Column = 0,
             seconds: int = 0) -> Column:
    """Timestamp moved by a fixed amount."""
    minutes = minutes if isinstance(minutes, Column) else F.lit(minutes)
    return _col(ts) + F.make_dt_interval(F.lit(days), F.lit(hours), minutes, F.lit(seconds))


def year_diff(start: Column | str, end: Column | str) -> Column:
    """Calendar-year boundaries crossed between two dates."""
    return F.year(_col(end)) - F.year(_col(start))


def second_diff(start: Column | str, end: Column | str) -> Column:
    """Whole-second boundaries crossed between two timestamps."""
    whole = [F.date_trunc("second", _col(c)) for c in (start, end)]
    return F.timestamp_diff("SECOND", whole[0], whole[1])


def local_time(ts: Column | str, zone: str) -> Column:
    """UTC timestamp as wall-clock time of ``zone``."""
    return F.convert_timezone(F.lit("UTC"), F.lit(zone), _col(ts))


def local_date(ts: Column | str, zone: str) -> Column:
    """Wall-clock date text, ``2024-01-31``."""
    return F.date_format(local_time(ts, zone), "yyyy-MM-dd")


def local_clock(ts: Column | str, zone: str, suffix: str = "") -> Column:
    """12-hour wall-clock text, ``01:05:09 PM``. Sort on the timestamp, never on this."""
    text = F.date_format(local_time(ts, zone), "hh:mm:ss a")
    return F.concat(text, F.lit(suffix)) if suffix else text


def stamp(ts: Column | str, pattern: str = "yyyyMMdd_HHmmss") -> Column:
    """Timestamp as a file-name stamp."""
    return F.date_format(_col(ts), pattern)


def parse_date(text: Column | str, pattern: str = "yyyy-MM-dd") -> Column:
    """Text to date; bad text is an error."""
    return F.to_date(_col(text), pattern)
