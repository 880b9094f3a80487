"""Delimited files and Parquet tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyweek.functions.sizing import saved

BAD_LINE = "_bad_line"


def read_delimited(
    spark: SparkSession, path: str, schema: T.StructType | str | None = None, na: str = "NA", sep: str = ","
) -> DataFrame:
    """Read a file with a header (S1). Text equal to `na` becomes NULL.

    The line separator is left to Spark, which takes LF, CRLF and bare CR.
    Without a schema the types are inferred, at the cost of one more read.
    """
    reader = spark.read.option("header", True).option("sep", sep).option("nullValue", na)
    if schema is None:
        return reader.option("inferSchema", True).csv(path)
    return reader.schema(schema).csv(path)


def write_delimited(df: DataFrame, path: str, na: str = "NA", sep: str = ",") -> None:
    df.write.mode("overwrite").option("header", True).option("sep", sep).option("nullValue", na).csv(path)


def read_checked(
    spark: SparkSession, path: str, schema: T.StructType | str, na: str = "NA", sep: str = ",", header: bool = True
) -> tuple[DataFrame, DataFrame]:
    """The good rows of a delimited file, and the bad lines as (line, file).

    A line is bad if it has more or fewer fields than the schema, or a field that is not of its type; `na`
    is a missing value and no fault. Every line is in one of the two tables, whichever columns are asked for.
    """
    fields = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    whole = T.StructType([*fields.fields, T.StructField(BAD_LINE, T.StringType())])
    options = {"header": header, "sep": sep, "nullValue": na, "mode": "PERMISSIVE", "columnNameOfCorruptRecord": BAD_LINE, "columnPruning": False}
    read = spark.read.options(**options).schema(whole).csv(path)
    # Parsed once and kept: Spark gives no bad lines of a raw file whose other columns are not asked for.
    rows = saved(read.withColumn("_file", F.when(F.col(BAD_LINE).isNotNull(), F.col("_metadata.file_path"))), "parsed-lines")
    good = rows.where(F.col(BAD_LINE).isNull()).drop(BAD_LINE, "_file")
    return good, rows.where(F.col(BAD_LINE).isNotNull()).select(F.col(BAD_LINE).alias("line"), F.col("_file").alias("file"))


def quarantine(bad: DataFrame, path: str) -> DataFrame:
    """Append bad lines to the table kept at `path`, and read it."""
    bad.write.mode("append").parquet(path)
    return bad.sparkSession.read.parquet(path)


def save_table(df: DataFrame, path: str, partition_by: Sequence[str] = (), replace: str = "all") -> None:
    """Keep a cleaned table for later sessions.

    `replace="partitions"` replaces the partitions that `df` has rows of and leaves the files of all others as they are.
    """
    if replace not in ("all", "partitions"):
        raise ValueError("replace must be 'all' or 'partitions'")
    if replace == "partitions" and not partition_by:
        raise ValueError("a table without partitions can only be replaced as a whole")
    mode = "dynamic" if replace == "partitions" else "static"
    df.write.mode("overwrite").option("partitionOverwriteMode", mode).partitionBy(*partition_by).parquet(path)


def load_table(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    return spark.read.schema(schema).parquet(path) if schema else spark.read.parquet(path)
