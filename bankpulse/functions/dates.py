"""Month arithmetic and complete-unit differences."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def month_of(moment: Column) -> Column:
    """First day of the month, as a date."""
    return F.trunc(moment.cast("date"), "MONTH")


def month_number(day: Column) -> Column:
    """Months are numbered without gaps from January of year 0."""
    return F.year(day) * 12 + F.month(day) - 1


def complete_years(start: Column, end: Column) -> Column:
    return F.timestamp_diff("YEAR", start, end)


def complete_days(start: Column, end: Column) -> Column:
    """Number of full 24-hour days between zone-less timestamps."""
    return F.extract(F.lit("DAY"), end - start)
