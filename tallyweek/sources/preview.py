"""A first look at a table."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F



# Rows a client may ask for at a time.
FETCH_ROWS = 100_000


def glimpse(df: DataFrame, n: int = 5, order_by: Sequence[str] = ()) -> DataFrame:
    """One row per column: position, name, type and its first `n` values."""
    head = (df.orderBy(*order_by) if order_by else df).limit(n)
    samples = head.agg(
        *[F.concat_ws(", ", F.collect_list(F.coalesce(F.col(c).cast("string"), F.lit("NULL")))).alias(c) for c in df.columns]
    )
    entries = [
        F.struct(F.lit(i).alias("position"), F.lit(c).alias("column"), F.lit(t).alias("type"), F.col(c).alias("sample"))
        for i, (c, t) in enumerate(df.dtypes, start=1)
    ]
    return samples.select(F.inline(F.array(*entries)))


def dims(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Row and column counts of each table."""
    parts = [
        df.agg(F.count(F.lit(1)).alias("n_rows")).select(
            F.lit(name).alias("table_name"), "n_rows", F.lit(len(df.columns)).alias("n_cols")
        )
        for name, df in tables.items()
    ]
    return reduce(DataFrame.unionByName, parts)


def fetch(df: DataFrame, max_rows: int = FETCH_ROWS) -> list[Row]:
    """The rows of a result, for the caller's own process.

    A result of more than `max_rows` rows is refused rather than cut: it is to
    be summarised or written instead.
    """
    rows = df.limit(max_rows + 1).collect()
    if len(rows) > max_rows:
        raise ValueError(f"more than {max_rows} rows: summarise or write the table instead")
    return rows
