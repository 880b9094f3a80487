"""Totals and means of a growing folder of files, kept up to date by micro-batches.

A batch leaves one row per group: how many values, their cents, the smallest and largest, and how many are missing,
negative or zero. Such rows add up, so the state is just their table, in a folder per batch. A batch
that runs again after a failure writes its folder anew, and nothing counts twice. Summaries (A1-A3, A10, A11)
come from the state alone and never from the rows read before.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyweek.functions.columns import percent


def partial_sums(df: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """One row per group that adds up with those of other rows; amounts as whole cents."""
    v = F.col(value)
    return df.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n_rows"), F.count(v).alias("n"), F.sum(F.round(v * 100).cast("long")).alias("cents"),
        F.min(v).alias("low"), F.max(v).alias("high"), F.count_if(v < 0).alias("n_negative"), F.count_if(v == 0).alias("n_zero"),
    )


def merged(parts: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The partial sums of all batches as one row per group."""
    sums = [F.sum(c).alias(c) for c in ("n_rows", "n", "cents", "n_negative", "n_zero")]
    return parts.groupBy(*keys).agg(*sums, F.min("low").alias("low"), F.max("high").alias("high"))


def follow(source: DataFrame, keys: Sequence[str], value: str, state: str) -> None:
    """Take in all files that a streaming source has not seen yet, and stop; `state` keeps progress and sums."""

    def take(batch: DataFrame, number: int) -> None:
        partial_sums(batch, keys, value).write.mode("overwrite").parquet(f"{state}/sums/batch={number}")

    writer = source.writeStream.foreachBatch(take).option("checkpointLocation", f"{state}/progress").trigger(availableNow=True)
    writer.start().awaitTermination()


def file_source(spark: SparkSession, path: str, schema, files_per_batch: int = 100) -> DataFrame:
    """A folder of Parquet files as a stream."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).parquet(path)


def summaries(spark: SparkSession, state: str, keys: Sequence[str]) -> DataFrame:
    """The merged state with mean, total and share of negative values."""
    out = merged(spark.read.parquet(f"{state}/sums"), keys)
    return out.withColumns(
        {
            "total_sales": F.col("cents") / 100, "avg_sales": F.try_divide(F.col("cents") / 100, F.col("n")),
            "n_missing": F.col("n_rows") - F.col("n"), "pct_negative": percent(F.col("n_negative"), F.col("n_rows")),
        }
    )
