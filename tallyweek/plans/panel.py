"""From raw tables to the enriched weekly panel and the model table."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyweek.functions import calendar, columns
from tallyweek.operators import clean
from tallyweek.operators.join import inner_join

# The numeric code of each store type.
TYPE_CODES = {"A": 1.0, "B": 2.0, "C": 3.0}


def clean_sales(sales: DataFrame, date: str = "week_date", value: str = "weekly_sales") -> DataFrame:
    """Dates as dates, only positive sales."""
    return clean.keep_positive(columns.to_dates(sales, date), value)


def clean_features(
    features: DataFrame,
    date: str = "week_date",
    fill: tuple[str, str] | None = ("markdown_1", "markdown_5"),
    types: Mapping[str, str] | None = None,
) -> DataFrame:
    """Dates as dates, text `NA` as missing, and missing values in a column range as 0.

    Columns of the range that are text are read as numbers.
    """
    span = columns.columns_between(features, *fill) if fill else []
    types = {**{c: "double" for c in span}, **(types or {})}
    out = columns.text_na_to_null(columns.to_dates(features, date), types=types)
    return columns.fill_missing(out, span, 0.0)


def star_merge(
    sales: DataFrame,
    stores: DataFrame,
    features: DataFrame,
    store_key: Sequence[str] = ("store",),
    feature_keys: Sequence[str] = ("store", "week_date", "is_holiday"),
    salt: int | None = None,
) -> DataFrame:
    """Sales with their store and their store-week features."""
    return inner_join(inner_join(sales, stores, store_key, salt), features, feature_keys, salt)


def enrich(
    merged: DataFrame,
    date: str = "week_date",
    flag: str = "is_holiday",
    kind: str = "store_type",
    codes: Mapping[str, float] = TYPE_CODES,
) -> DataFrame:
    """Holiday flag as 0/1, numeric store type, calendar columns."""
    out = columns.bools_to_int(merged, flag).withColumn("type_numeric", columns.encode(F.col(kind), codes))
    return calendar.with_calendar(out, date)


def build_panel(sales: DataFrame, stores: DataFrame, features: DataFrame, salt: int | None = None) -> DataFrame:
    """Clean, join and enrich."""
    return enrich(star_merge(clean_sales(sales), stores, clean_features(features), salt=salt))


def model_table(panel: DataFrame, year: int, date: str = "week_date", drop: Sequence[str] | None = None) -> DataFrame:
    """One year of the panel without the weak features (M1)."""
    weak = ["week_date", "temperature", "fuel_price", "store_type", "cpi", "month", "unemployment"]
    rows = clean.keep_years(panel, date, year)
    return columns.drop_columns(rows, *(weak if drop is None else drop), prefix="markdown")
