"""Lenient parsing: malformed text becomes NULL instead of an ANSI error."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

LOAD_TIMESTAMP_FORMAT = "yyyyMMddHHmm"
OPEN_END = "9999-12-31"


def load_timestamp(column: Column) -> Column:
    """Number or text ``yyyyMMddHHmm`` to a timestamp."""
    return F.try_to_timestamp(column.cast("string"), F.lit(LOAD_TIMESTAMP_FORMAT))


def mixed_date(column: Column) -> Column:
    """Eight characters read as ``yyyyMMdd``, anything else as ``yyyy-MM-dd``."""
    text = column.cast("string")
    compact = F.try_to_timestamp(text, F.lit("yyyyMMdd"))
    dashed = F.try_to_timestamp(text, F.lit("yyyy-MM-dd"))
    return F.when(F.length(text) == 8, compact).otherwise(dashed).cast("date")


def term_date(column: Column, open_year: str = "2078") -> Column:
    """``yyyyMMdd`` text to a date; the year that means "open" becomes the open end."""
    text = column.cast("string")
    parsed = F.try_to_timestamp(text, F.lit("yyyyMMdd")).cast("date")
    return F.when(F.substring(text, 1, 4) == open_year, open_end()).otherwise(parsed)


def open_end() -> Column:
    return F.lit(OPEN_END).cast("date")
