"""Sales, stores and features derived from the order-line and supplier tables.

The definitions are those of FIXTURES.md, section 2.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyweek.functions.columns import cents

# ISO weeks that count as holiday weeks, and the store types.
HOLIDAY_WEEKS = (6, 36, 47, 52)
STORE_TYPES = ("A", "B", "C")


def _lines(spark: SparkSession, sf_dir: str, years: tuple[int, int] | None) -> DataFrame:
    lines = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    if years:
        # A line ships at most six days after the Monday its week is named by,
        # so this range loses no line of the asked years and reaches the scan.
        shipped, kind = F.col("l_shipdate"), lines.schema["l_shipdate"].dataType
        low, high = F.lit(f"{years[0]}-01-01").cast(kind), F.lit(f"{years[1] + 1}-01-07").cast(kind)
        lines = lines.where((shipped >= low) & (shipped < high))
    week = F.trunc(F.col("l_shipdate").cast("date"), "week")
    lines = lines.withColumns({"store": F.col("l_suppkey").cast("int"), "week_date": week})
    if years:
        lines = lines.where(F.year("week_date").between(*years))
    return lines


def _holiday(date: str) -> Column:
    return F.weekofyear(date).isin(*HOLIDAY_WEEKS)


def sales(spark: SparkSession, sf_dir: str, years: tuple[int, int] | None = None) -> DataFrame:
    price = cents(F.col("l_extendedprice"))
    signed = F.when(F.col("l_returnflag") == "R", -price).otherwise(price)
    return (
        _lines(spark, sf_dir, years)
        .groupBy("store", F.col("l_linenumber").alias("dept"), "week_date")
        .agg((F.sum(signed) / 100).alias("weekly_sales"))
        .withColumn("is_holiday", _holiday("week_date"))
    )


def stores(spark: SparkSession, sf_dir: str) -> DataFrame:
    nation = F.col("s_nationkey")
    kind = F.element_at(F.array(*map(F.lit, STORE_TYPES)), nation % 3 + 1)
    return spark.read.parquet(f"{sf_dir}/supplier.parquet").select(
        F.col("s_suppkey").cast("int").alias("store"),
        kind.alias("store_type"),
        (30000 + 7000 * nation).cast("int").alias("store_size"),
    )


def features(spark: SparkSession, sf_dir: str, years: tuple[int, int] | None = None) -> DataFrame:
    """Markdowns are text, with `NA` where missing, as in a raw file."""

    def mean(c: str) -> Column:
        return F.sum(cents(F.col(c))) / 100 / F.count(F.lit(1))

    n = F.col("n")
    weekly = (
        _lines(spark, sf_dir, years)
        .groupBy("store", "week_date")
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.round(30 + 500 * mean("l_discount"), 2).alias("temperature"),
            F.round(2.5 + 25 * mean("l_tax"), 3).alias("fuel_price"),
            F.round(120 + 2 * mean("l_quantity"), 4).alias("cpi"),
            F.round(4 + 1.5 * F.sum("l_linenumber").cast("double") / F.count(F.lit(1)), 3).alias("unemployment"),
        )
    )
    markdowns = [
        F.when((n + i - 1) % 3 == 0, "NA").otherwise((n * i).cast("string")).alias(f"markdown_{i}") for i in range(1, 6)
    ]
    return weekly.select(
        "store", "week_date", "temperature", "fuel_price", *markdowns, "cpi", "unemployment",
        _holiday("week_date").alias("is_holiday"),
    )
