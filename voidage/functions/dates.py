"""Date expressions."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from voidage.sources.schemas import OPEN_END

#: Months after which the places that join intervals to dates come round again.
CYCLE = 60


def open_end() -> Column:
    return F.lit(OPEN_END).cast("date")


def month_end(date: Column) -> Column:
    return F.last_day(date)


def month_index(date: Column) -> Column:
    """Calendar months as consecutive integers."""
    return F.year(date) * 12 + F.month(date)


def month_place(date: Column) -> Column:
    """The place of a date's month in the cycle of months."""
    return month_index(date) % CYCLE


def pattern_key(pattern: Column, date: Column, style: str = "dd-MM-yyyy") -> Column:
    """Report key of a pattern and day."""
    return F.concat(pattern, F.date_format(date, style))
