"""Date parsing, parts and shifts."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def parse_date(column: str | Column, pattern: str = "MM-dd-yyyy") -> Column:
    """Date from text; text that does not fit gives null instead of an error."""
    text = F.col(column) if isinstance(column, str) else column
    return F.to_date(F.try_to_timestamp(text, F.lit(pattern)))


def date_parts(column: str) -> dict[str, Column]:
    """Calendar columns of a date; Sunday is day 1 of the week."""
    day = F.col(column)
    return {
        "yr": F.year(day),
        "mth": F.month(day),
        "lastday": F.last_day(day),
        "nextsunday": F.next_day(day, "Sunday"),
        "dayofwk": F.dayofweek(day),
        "daytrunc": F.trunc(day, "mon"),
    }


def in_month(column: str, year: int, month: int) -> Column:
    """Rows of one month as a half-open range, which scans can skip files by."""
    start = f"{year:04d}-{month:02d}-01"
    end = f"{year + month // 12:04d}-{month % 12 + 1:02d}-01"
    value = F.col(column)
    return (value >= F.lit(start).cast("date")) & (value < F.lit(end).cast("date"))


def is_month_start(column: str) -> Column:
    return F.to_date(column) == F.trunc(column, "MM")


def is_month_end(column: str) -> Column:
    return F.to_date(column) == F.last_day(column)
