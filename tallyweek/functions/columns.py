"""Column builders: types, conditions, labels and column choice."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def numeric_columns(df: DataFrame) -> list[str]:
    """Names of the numeric columns, in order."""
    return [f.name for f in df.schema if isinstance(f.dataType, T.NumericType)]


def columns_between(df: DataFrame, first: str, last: str) -> list[str]:
    """Names from `first` to `last`, both included."""
    names = df.columns
    i, j = names.index(first), names.index(last)
    if i > j:
        raise ValueError(f"{first} comes after {last}")
    return names[i : j + 1]


def other_columns(df: DataFrame, *left_out: str) -> list[str]:
    """All column names but those given."""
    return [c for c in df.columns if c not in left_out]


def select_numeric(df: DataFrame) -> DataFrame:
    return df.select(*numeric_columns(df))


def drop_columns(df: DataFrame, *names: str, prefix: str | None = None) -> DataFrame:
    """Drop columns by name and, if given, by prefix."""
    by_prefix = [c for c in df.columns if prefix and c.startswith(prefix)]
    return df.drop(*names, *by_prefix)


def is_missing(df: DataFrame, name: str) -> Column:
    """NULL or, for floating-point columns, NaN."""
    c = F.col(name)
    if isinstance(df.schema[name].dataType, (T.DoubleType, T.FloatType)):
        return c.isNull() | F.isnan(c)
    return c.isNull()


def map_columns(df: DataFrame, names: Sequence[str], change: Callable[[Column], Column]) -> DataFrame:
    """Apply one change to several columns; for all of them pass `df.columns`."""
    return df.withColumns({c: change(F.col(c)) for c in names})


def text_na_to_null(df: DataFrame, token: str = "NA", types: Mapping[str, str] | None = None) -> DataFrame:
    """Turn the text `token` into NULL in every string column.

    `types` then gives the real type of columns that were text only because of
    the token; what does not parse becomes NULL.
    """
    types = dict(types or {})
    changed = {
        f.name: F.nullif(F.col(f.name), F.lit(token)) for f in df.schema if isinstance(f.dataType, T.StringType)
    }
    for name, to in types.items():
        changed[name] = changed.get(name, F.col(name)).try_cast(to)
    return df.withColumns(changed) if changed else df


def fill_missing(df: DataFrame, names: Sequence[str], value: float = 0) -> DataFrame:
    """Replace NULL and NaN by a constant in the named columns."""
    return df.withColumns({c: F.when(is_missing(df, c), F.lit(value)).otherwise(F.col(c)) for c in names})


def to_dates(df: DataFrame, *names: str) -> DataFrame:
    """Text dates to dates."""
    return map_columns(df, names, lambda c: c.cast("date"))


def bools_to_int(df: DataFrame, *names: str) -> DataFrame:
    """Flags to 0 and 1."""
    return map_columns(df, names, lambda c: c.cast("int"))


def encode(col: Column, codes: Mapping[object, object]) -> Column:
    """Value to code, NULL for values without a code."""
    branches = iter(codes.items())
    value, code = next(branches)
    out = F.when(col == F.lit(value), F.lit(code))
    for value, code in branches:
        out = out.when(col == F.lit(value), F.lit(code))
    return out


def lookup(col: Column, names: Mapping[object, str]) -> Column:
    """Code to name through a constant map, NULL for unknown codes."""
    pairs = [F.lit(x) for item in names.items() for x in item]
    return F.try_element_at(F.create_map(*pairs), col)


def percent(part: Column, whole: Column) -> Column:
    """part / whole * 100, NULL when whole is zero."""
    return F.try_divide(part.cast("double"), whole.cast("double")) * 100


def fixed_text(col: Column, digits: int = 2) -> Column:
    """Number as text with a fixed count of decimals (P20)."""
    return F.format_string(f"%.{digits}f", col.cast("double"))


def joined_label(*cols: Column, sep: str = ".") -> Column:
    """One label from several columns."""
    return F.concat_ws(sep, *[c.cast("string") for c in cols])


def cents(col: Column) -> Column:
    """An amount as whole cents, NaN as missing.

    Whole numbers add up the same in any order, and several times faster than
    decimals; a sum past 9.2e18 cents is an error, not a wrong number.
    """
    return F.when(~F.isnan(col.cast("double")), F.rint(col * 100).cast("bigint"))


def total(col: Column, money: bool = False) -> Column:
    """Plain sum, or with `money` the sum to the cent."""
    return money_sum(col) if money else F.sum(col)


def mean(col: Column, money: bool = False) -> Column:
    """Plain mean, or with `money` the mean of amounts in whole cents."""
    return money_mean(col) if money else F.avg(col)


def money_sum(col: Column) -> Column:
    """Sum to the cent, the same however the rows are partitioned."""
    return F.sum(cents(col)) / 100


def money_mean(col: Column) -> Column:
    """Mean of a money column from its exact sum."""
    return F.try_divide(money_sum(col), F.count(cents(col)))
