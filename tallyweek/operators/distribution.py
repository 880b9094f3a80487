"""Shape of a distribution: moments, histograms, density, box plots, binned scatter.

Each gives the numbers a chart is drawn from, a bounded count of rows, instead
of bringing all rows to where it is drawn.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyweek.functions.columns import mean, total
from tallyweek.functions.sizing import local_table, saved
from tallyweek.operators.clean import clip, keep_present
from tallyweek.operators.join import attach_stats
from tallyweek.operators.quantile import named_quantiles

# Bandwidths at which a Gaussian is zero in double precision.
REACH = 39


def skewness(df: DataFrame, value: str) -> DataFrame:
    """Population skewness."""
    return df.agg(F.skewness(value).alias("skewness"))


def kurtosis(df: DataFrame, value: str) -> DataFrame:
    """Population kurtosis in both conventions: excess, and Pearson = excess + 3."""
    return df.agg(F.kurtosis(value).alias("excess_kurtosis")).withColumn(
        "pearson_kurtosis", F.col("excess_kurtosis") + 3
    )


def histogram(df: DataFrame, value: str, bins: int = 30) -> DataFrame:
    """`bins` equal bins from the smallest to the largest value, empty ones included.

    Bins are numbered from 1; the largest value belongs to the last one.
    """
    rows = keep_present(df, value).select(F.col(value).cast("double").alias("x"))
    low, high = rows.agg(F.min("x"), F.max("x")).first()
    if low is None:
        return local_table(df.sparkSession, [], "bin int, bin_start double, bin_end double, n bigint")
    width = (high - low) / bins
    number = F.least(F.floor((F.col("x") - low) / width), F.lit(bins - 1)) if width else F.lit(0)
    counts = rows.groupBy((number + 1).cast("int").alias("bin")).agg(F.count(F.lit(1)).alias("n"))
    edges = [(i, low + (i - 1) * width, low + i * width) for i in range(1, bins + 1)]
    frame = local_table(df.sparkSession, edges, "bin int, bin_start double, bin_end double")
    return (
        frame.join(counts, "bin", "left")
        .select("bin", "bin_start", "bin_end", F.coalesce("n", F.lit(0).cast("long")).alias("n"))
        .orderBy("bin")
    )


def histogram_by_width(df: DataFrame, value: str, width: float) -> DataFrame:
    """Counts in bins [i * width, (i + 1) * width) that hold rows."""
    return (
        keep_present(df, value)
        .groupBy(F.floor(F.col(value) / width).alias("bin"))
        .agg(F.count(F.lit(1)).alias("n"))
        .select("bin", (F.col("bin") * width).cast("double").alias("bin_start"), "n")
        .orderBy("bin")
    )


def density(
    df: DataFrame, value: str, upper: float, lower: float | None = None, points: int = 512, fineness: int = 8
) -> DataFrame:
    """Gaussian kernel density on an even grid over [lower, upper].

    Rows outside the range are left out. The bandwidth is Silverman's,
    0.9 * min(sd, IQR / 1.34) * n^(-1/5). Rows are first counted in bins of
    1/`fineness` of it, each bin standing at the mean of its rows.
    """
    kept = keep_present(df, value)
    if lower is None:  # taken once, as a number, so that later passes do not look for it again
        lower = kept.agg(F.min(value)).first()[0]
    if lower is None:
        return local_table(df.sparkSession, [], "point int, x double, density double")
    rows = clip(kept, value, upper, float(lower)).select(F.col(value).cast("double").alias("x"))
    n, sd, low = rows.agg(F.count("x"), F.stddev_samp("x"), F.min("x")).first()
    empty = local_table(df.sparkSession, [], "point int, x double, density double")
    if not n or not sd:
        return empty
    low = float(lower)
    q1, q3 = named_quantiles(rows, "x", {"q1": 0.25, "q3": 0.75}).first()
    spread = min(sd, (q3 - q1) / 1.34) or sd
    bandwidth = 0.9 * spread * math.pow(n, -0.2)
    step = (upper - low) / (points - 1)

    binned = rows.groupBy(F.floor((F.col("x") - low) / (bandwidth / fineness)).alias("bin")).agg(
        F.count(F.lit(1)).alias("n"), F.avg("x").alias("center")
    )
    # A bin meets only the grid points near it: further off the kernel is zero
    # in double precision, and so the pairs stay few for any bandwidth.
    first = F.greatest(F.lit(0.0), F.ceil((F.col("center") - REACH * bandwidth - low) / step).cast("double")).cast("int")
    last = F.least(F.lit(points - 1.0), F.floor((F.col("center") + REACH * bandwidth - low) / step).cast("double")).cast("int")
    u = (F.lit(low) + F.col("point") * step - F.col("center")) / bandwidth
    sums = (
        binned.where(first <= last)
        .select("n", "center", F.explode(F.sequence(first, last)).alias("point"))
        .groupBy("point")
        .agg((F.sum(F.col("n") * F.exp(-u * u / 2)) / (n * bandwidth * math.sqrt(2 * math.pi))).alias("density"))
    )
    grid = local_table(df.sparkSession, [(i, low + i * step) for i in range(points)], "point int, x double")
    return grid.join(sums, "point", "left").fillna(0.0, ["density"]).orderBy("point")


def box_stats(
    df: DataFrame, group: Sequence[str], value: str, entity: Sequence[str] = (), approx: int | None = None
) -> DataFrame:
    """Quartiles, whiskers and the count of outliers per group.

    Whiskers end at the last value within 1.5 IQR of the box. Every row counts;
    with `entity` each distinct entity counts once. `approx` as in `named_quantiles`.
    """
    rows = keep_present(df, value).select(*group, *entity, F.col(value).cast("double").alias("x"))
    if entity:
        rows = saved(rows.distinct(), "entities")
    box = named_quantiles(rows, "x", {"q1": 0.25, "median": 0.5, "q3": 0.75}, group, approx)
    fence = 1.5 * (F.col("q3") - F.col("q1"))
    inside = F.col("x").between(F.col("q1") - fence, F.col("q3") + fence)
    return (
        attach_stats(rows, box, group)
        .groupBy(*group)
        .agg(
            F.count(F.lit(1)).alias("n"),
            *[F.first(c).alias(c) for c in ("q1", "median", "q3")],
            F.min(F.when(inside, F.col("x"))).alias("whisker_low"),
            F.max(F.when(inside, F.col("x"))).alias("whisker_high"),
            F.count_if(~inside).alias("n_outliers"),
        )
        .orderBy(*group)
    )


def binned_scatter(
    df: DataFrame, x: str, y: str, x_width: float, y_width: float, category: Sequence[str] = (), money: bool = False
) -> DataFrame:
    """Points counted in an x by y grid per category, with their mean y.

    `money` takes the mean of y in whole cents.
    """
    return (
        keep_present(df, x, y)
        .groupBy(
            *category,
            F.floor(F.col(x) / x_width).alias("x_bin"),
            F.floor(F.col(y) / y_width).alias("y_bin"),
        )
        .agg(F.count(F.lit(1)).alias("n"), mean(F.col(y), money).alias("avg_sales"))
        .orderBy(*category, "x_bin", "y_bin")
    )


def band(col: Column, bands: Sequence[tuple[str, float | None, float | None]], rest: str = "other") -> Column:
    """Name of the band a number lies in; both ends belong to a band.

    An open lower end means up to the upper one, an open upper end means above
    the lower one.
    """
    out = F.when(col.isNull(), F.lit(None).cast("string"))
    for name, low, high in bands:
        if low is None:
            out = out.when(col <= high, name)
        elif high is None:
            out = out.when(col > low, name)
        else:
            out = out.when(col.between(low, high), name)
    return out.otherwise(rest)


def mean_by_band(
    df: DataFrame, x: str, y: str, bands: Sequence[tuple[str, float | None, float | None]], category: Sequence[str] = (),
    money: bool = False,
) -> DataFrame:
    """Rows, total and mean of a column per band of another."""
    v = F.col(y)
    return (
        df.groupBy(*category, band(F.col(x), bands).alias("band"))
        .agg(F.count(F.lit(1)).alias("n"), total(v, money).alias("total_sales"), mean(v, money).alias("avg_sales"))
        .orderBy(*category, "band")
    )
