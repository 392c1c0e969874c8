"""Tolerant parsing of text columns; a value that does not parse becomes null."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_NUMBER = r"^\s*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\s*$"
_DATED = r"^\s*\d{4}-\d{1,2}-\d{1,2}"


def blank_to_null(column: Column) -> Column:
    return F.nullif(column, F.lit(""))


def to_double(column: Column) -> Column:
    text = column.cast("string")
    return F.when(text.rlike(_NUMBER), text.try_cast("double"))


def to_long(column: Column) -> Column:
    text = F.trim(column.cast("string"))
    return F.when(
        text.rlike(_NUMBER),
        F.coalesce(text.try_cast("bigint"), text.try_cast("double").try_cast("bigint")),
    )


def to_flag(column: Column) -> Column:
    """true/1 and false/0 in any case; everything else is null."""
    text = F.lower(F.trim(column.cast("string")))
    return F.when(text.isin("true", "1"), F.lit(True)).when(text.isin("false", "0"), F.lit(False))


def to_utc_timestamp(column: Column) -> Column:
    """Mixed ISO-like texts; a text without an offset is UTC (the session zone)."""
    text = column.cast("string")
    return F.when(text.rlike(_DATED), text.try_cast("timestamp"))


def date_text(column: Column) -> Column:
    return F.to_date(column).cast("string")


def hour_label(hour: Column) -> Column:
    return F.format_string("%02d:00", hour.cast("int"))


def hour_of_label(label: str) -> int:
    return int(label.split(":")[0])


def clock_hour(column: Column) -> Column:
    """Hour of an ``HH:MM:SS`` text; service clocks may run past 24:00."""
    return F.split(column, ":")[0].try_cast("int")


def local_wall_clock(epoch_seconds: Column, zone: str = "Pacific/Auckland") -> Column:
    """Epoch seconds as the local wall-clock time of ``zone`` (no zone attached)."""
    return F.convert_timezone(F.lit("UTC"), F.lit(zone), F.timestamp_seconds(epoch_seconds).cast("timestamp_ntz"))
