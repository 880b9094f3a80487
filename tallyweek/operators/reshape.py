"""Unions and changes between long and wide."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def stack_rows(*tables: DataFrame) -> DataFrame:
    """All rows of tables with the same columns, matched by name."""
    return reduce(DataFrame.unionByName, tables)


def stack_with_id(tables: Mapping[str, DataFrame], id_column: str = "source") -> DataFrame:
    """All rows with the name of their table; columns a table lacks are NULL."""
    tagged = [df.withColumn(id_column, F.lit(name)) for name, df in tables.items()]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tagged)


def to_long(
    df: DataFrame, ids: Sequence[str], values: Sequence[str], name: str = "metric", value: str = "value"
) -> DataFrame:
    """One row per id and value column."""
    return df.unpivot(list(ids), list(values), name, value)


def to_wide(df: DataFrame, ids: Sequence[str], name: str, value: str, names: Sequence[object] | None = None) -> DataFrame:
    """One column per entry of `names`, or per value found (R2); naming them saves a pass over the table."""
    return df.groupBy(*ids).pivot(name, None if names is None else list(names)).agg(F.first(value, ignorenulls=True))
