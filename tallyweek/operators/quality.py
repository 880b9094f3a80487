"""Data audits: missing values, signs, whole-table description."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyweek.functions.columns import percent

FLOATS = (T.DoubleType, T.FloatType)


def _count_if(condition: Column) -> Column:
    return F.coalesce(F.count_if(condition), F.lit(0))


def missing_audit(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Counts of NULL and of NaN per column, in one pass (A1)."""
    names = list(columns or df.columns)
    aggs = []
    for i, c in enumerate(names):
        aggs.append(_count_if(F.col(c).isNull()).alias(f"null_{i}"))
        if isinstance(df.schema[c].dataType, FLOATS):
            aggs.append(_count_if(F.isnan(c)).alias(f"nan_{i}"))
        else:
            aggs.append(F.lit(0).cast("long").alias(f"nan_{i}"))
    entries = [
        F.struct(F.lit(c).alias("column"), F.col(f"null_{i}").alias("n_null"), F.col(f"nan_{i}").alias("n_nan"))
        for i, c in enumerate(names)
    ]
    return df.agg(*aggs).select(F.inline(F.array(*entries)))


def sign_audit(df: DataFrame, value: str) -> DataFrame:
    """Negative and zero counts, total rows and the negative percentage (A2)."""
    v = F.col(value)
    return df.agg(
        _count_if(v < 0).alias("n_negative"), _count_if(v == 0).alias("n_zero"), F.count(F.lit(1)).alias("n_rows")
    ).withColumn("pct_negative", percent(F.col("n_negative"), F.col("n_rows")))


def describe(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Count, mean, sd, minimum and maximum per column, one row each (A4).

    Numbers stay numbers: text minima and maxima have columns of their own.
    Booleans count as 0 and 1, dates as text.
    """
    names = list(columns or df.columns)
    aggs, entries = [], []
    for i, c in enumerate(names):
        kind = df.schema[c].dataType
        col = F.col(c).cast("int") if isinstance(kind, T.BooleanType) else F.col(c)
        number = isinstance(kind, (T.NumericType, T.BooleanType))
        aggs += [F.count(col).alias(f"n_{i}"), F.min(col).alias(f"lo_{i}"), F.max(col).alias(f"hi_{i}")]
        if number:
            aggs += [F.avg(col).alias(f"avg_{i}"), F.stddev_samp(col).alias(f"sd_{i}")]
        no_number, no_text = F.lit(None).cast("double"), F.lit(None).cast("string")
        entries.append(
            F.struct(
                F.lit(c).alias("column"),
                F.col(f"n_{i}").alias("count"),
                (F.col(f"avg_{i}").cast("double") if number else no_number).alias("mean"),
                (F.col(f"sd_{i}") if number else no_number).alias("stddev"),
                (F.col(f"lo_{i}").cast("double") if number else no_number).alias("min"),
                (F.col(f"hi_{i}").cast("double") if number else no_number).alias("max"),
                (no_text if number else F.col(f"lo_{i}").cast("string")).alias("min_text"),
                (no_text if number else F.col(f"hi_{i}").cast("string")).alias("max_text"),
            )
        )
    return df.agg(*aggs).select(F.inline(F.array(*entries)))


def distinct_values(df: DataFrame, *names: str) -> DataFrame:
    """The distinct values of one or more columns."""
    return df.select(*names).distinct()


def value_range(df: DataFrame, value: str) -> DataFrame:
    """Smallest and largest value."""
    return df.agg(F.min(value).alias("min_value"), F.max(value).alias("max_value"))
