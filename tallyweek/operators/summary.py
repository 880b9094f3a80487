"""Grouped summaries, shares, peaks and top-k lists.

All groupings combine on the map side first, so a group that holds much of
the table reaches the shuffle as one row per task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyweek.functions.columns import cents, mean, percent, total
from tallyweek.functions.sizing import saved
from tallyweek.operators.quantile import named_quantiles


def count_by(df: DataFrame, *keys: str, name: str = "n") -> DataFrame:
    """Rows per group, most first."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias(name)).orderBy(F.desc(name), *keys)


def total_by(df: DataFrame, keys: Sequence[str], value: str, name: str = "total_sales", money: bool = False) -> DataFrame:
    """Total per group, largest first (A6); `money` sums whole cents."""
    return df.groupBy(*keys).agg(total(F.col(value), money).alias(name)).orderBy(F.desc(name), *keys)


def mean_by(
    df: DataFrame, keys: Sequence[str], value: str, name: str = "avg_sales", money: bool = False, by_value: bool = False
) -> DataFrame:
    """Mean per group, missing values ignored.

    Ordered by the keys, or with `by_value` largest mean first. With `money`
    amounts count in whole cents, whose sums do not depend on the partitioning.
    """
    out = df.groupBy(*keys).agg(mean(F.col(value), money).alias(name))
    return out.orderBy(F.desc(name), *keys) if by_value else out.orderBy(*keys)


def peak_by(df: DataFrame, keys: Sequence[str], value: str, money: bool = False) -> DataFrame:
    """Largest value and total per group."""
    return (
        df.groupBy(*keys)
        .agg(F.max(value).alias("peak_sales"), total(F.col(value), money).alias("total_sales"))
        .orderBy(*keys)
    )


def six_numbers(df: DataFrame, value: str, approx: int | None = None, money: bool = False) -> DataFrame:
    """Count, minimum, mean, median, maximum and sd of a column (A3).

    The median is exact unless `approx` gives an accuracy to be content with.
    """
    v = F.col(value)
    median = named_quantiles(df, value, {"median_sales": 0.5}, approx=approx).scalar()
    return df.agg(
        F.count(F.lit(1)).alias("count_sales"),
        F.min(v).alias("min_sales"),
        mean(v, money).alias("mean_sales"),
        F.max(v).alias("max_sales"),
        F.stddev_samp(v).alias("sd_sales"),
    ).select(
        "count_sales", "min_sales", "mean_sales", median.alias("median_sales"), "max_sales", "sd_sales"
    )


def share_by(df: DataFrame, *keys: str) -> DataFrame:
    """Rows per group and their percentage of all rows."""
    counts = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    total = counts.agg(F.sum("n")).scalar()
    return counts.withColumn("pct", percent(F.col("n"), total)).orderBy(F.desc("n"), *keys)


def holiday_lift(df: DataFrame, flag: str, value: str, money: bool = False) -> DataFrame:
    """Share of rows, share of sales and mean ratio of flagged rows.

    Rows whose flag is missing are left out; without a flagged row both shares are 0.
    """
    on, v = F.col(flag).cast("int") == 1, F.col(value)
    seen = cents(v) if money else v
    sums = df.where(F.col(flag).isNotNull()).agg(
        F.count_if(on).alias("n_holiday"),
        F.count(F.lit(1)).alias("n_rows"),
        F.count(F.when(on, seen)).alias("_n_on"),
        F.count(F.when(~on, seen)).alias("_n_off"),
        F.coalesce(total(F.when(on, v), money), F.lit(0.0)).alias("_sum_on"),
        F.coalesce(total(F.when(~on, v), money), F.lit(0.0)).alias("_sum_off"),
    )
    mean_on = F.try_divide(F.col("_sum_on"), F.col("_n_on"))
    mean_off = F.try_divide(F.col("_sum_off"), F.col("_n_off"))
    return sums.select(
        "n_holiday",
        "n_rows",
        percent(F.col("n_holiday"), F.col("n_rows")).alias("pct_rows"),
        percent(F.col("_sum_on"), F.col("_sum_on") + F.col("_sum_off")).alias("pct_sales"),
        mean_on.alias("mean_holiday"),
        mean_off.alias("mean_other"),
        F.try_divide(mean_on, mean_off).alias("lift"),
    )


def best_in_group(
    df: DataFrame, group: Sequence[str], key: str, value: str, lowest: bool = False
) -> DataFrame:
    """The key with the highest (or lowest) value in each group.

    Ties go to the smallest key. An aggregate, so no group is sorted.
    """
    sort = F.col(value) if lowest else -F.col(value)
    best = F.min(F.struct(sort.alias("s"), F.col(key).alias("k"), F.col(value).alias("v"))).alias("_best")
    return (
        df.where(F.col(value).isNotNull())
        .groupBy(*group)
        .agg(best)
        .select(*group, F.col("_best.k").alias(key), F.col("_best.v").alias(value))
        .orderBy(*group)
    )


def top_k(df: DataFrame, value: str, tie_break: Sequence[str], k: int = 5) -> DataFrame:
    """The k rows with the largest value."""
    return df.orderBy(F.desc(value), *tie_break).limit(k)


def order_by_mean(df: DataFrame, category: str, value: str, money: bool = False) -> DataFrame:
    """Categories by ascending mean of a value, with their rank (O3)."""
    means = mean_by(df, [category], value, "mean_value", money=money)
    return rank_rows(means, ["mean_value", category], "rank").orderBy("rank")


def category_order(df: DataFrame, category: str) -> DataFrame:
    """The levels of a category with their sort rank."""
    levels = df.select(category).where(F.col(category).isNotNull()).distinct()
    return rank_rows(levels, [category], "sort_key").orderBy("sort_key")


def rank_rows(df: DataFrame, order: Sequence[str], name: str) -> DataFrame:
    """Number the rows 1.. by `order`, which must identify a row.

    The rows are dealt by ranges of the order to as many partitions as the
    session shuffles to, and saved with the number of their range; each range
    is numbered by itself and shifted by the row count of the ranges before it.
    """
    ranged = saved(df.repartitionByRange(*order).withColumn("_range", F.spark_partition_id()), "ranged")
    counts = ranged.groupBy("_range").agg(F.count(F.lit(1)).alias("_n"))
    before = F.sum("_n").over(Window.orderBy("_range")) - F.col("_n")
    offsets = counts.select("_range", before.alias("_before"))
    within = F.row_number().over(Window.partitionBy("_range").orderBy(*order))
    return (
        ranged.withColumn("_within", within)
        .join(offsets, "_range")
        .withColumn(name, (F.col("_before") + F.col("_within")).cast("long"))
        .drop("_range", "_within", "_before")
    )
