"""Row filters."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyweek.functions.calendar import in_years
from tallyweek.functions.columns import is_missing


def keep_positive(df: DataFrame, value: str) -> DataFrame:
    """Rows with value > 0 (F1). NaN counts as missing, not as a large number."""
    return df.where((F.col(value) > 0) & ~is_missing(df, value))


def keep_present(df: DataFrame, *names: str) -> DataFrame:
    """Rows where none of the named columns is missing (F2)."""
    for name in names:
        df = df.where(~is_missing(df, name))
    return df


def keep_members(df: DataFrame, name: str, values: Sequence[object]) -> DataFrame:
    """Rows whose value is one of `values`."""
    return df.where(F.col(name).isin(*values))


def keep_equal(df: DataFrame, name: str, value: object) -> DataFrame:
    """Rows with the given value."""
    return df.where(F.col(name) == F.lit(value))


def keep_years(df: DataFrame, date: str, first: int, last: int | None = None) -> DataFrame:
    """F3 and F4 for calendar years, as a date range that scans can prune on."""
    return df.where(in_years(date, first, last))


def clip(df: DataFrame, value: str, upper: float, lower: float | None = None) -> DataFrame:
    """Rows within [lower, upper]; lower is the smallest value if not given."""
    low = df.agg(F.min(value)).scalar() if lower is None else F.lit(lower)
    return df.where((F.col(value) >= low) & (F.col(value) <= F.lit(upper)))
