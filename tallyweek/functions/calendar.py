"""Calendar columns of a date."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def iso_week(date: Column) -> Column:
    """ISO 8601 week number, 1-53."""
    return F.weekofyear(date)


def week_block(date: Column) -> Column:
    """Seven-day block of the year: January 1-7 is 1."""
    return (F.floor((F.dayofyear(date) - 1) / 7) + 1).cast("int")


def with_calendar(df: DataFrame, date: str) -> DataFrame:
    """Add year, month and week_of_year; the year is the calendar year."""
    d = F.col(date)
    return df.withColumns({"year": F.year(d), "month": F.month(d), "week_of_year": iso_week(d)})


def in_years(date: str, first: int, last: int | None = None) -> Column:
    """Condition on whole years as a date range, which file formats can prune on."""
    d, last = F.col(date), first if last is None else last
    return (d >= F.lit(dt.date(first, 1, 1))) & (d < F.lit(dt.date(last + 1, 1, 1)))
