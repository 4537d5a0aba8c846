"""Dates, formats and zones."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def parse_date(column: str | Column, pattern: str = "yyyy-MM-dd", strict: bool = False) -> Column:
    """Text to date. Text that does not follow ``pattern`` gives null, or raises at run time if ``strict``."""
    return F.to_date(column, pattern) if strict else F.try_to_date(column, pattern)


def format_date(column: str | Column, pattern: str = "yyyy/MM/dd") -> Column:
    """Date or timestamp to text; ``z`` in the pattern names the session's zone."""
    return F.date_format(column, pattern)


def year_text(column: str | Column) -> Column:
    return F.date_format(column, "yyyy")


def in_zone(column: str | Column, zone: str) -> Column:
    """The wall clock of ``zone`` at an instant given in UTC."""
    return F.from_utc_timestamp(column, zone)
