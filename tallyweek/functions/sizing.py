"""Where intermediate tables go."""

from __future__ import annotations

import uuid
from collections.abc import Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors see: `spark.checkpoint.dir`, where unset one beside the session's tables."""
    return (spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get("spark.sql.warehouse.dir") + "/_scratch").rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder."""
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def checkpointed(df: DataFrame) -> DataFrame:
    """The same rows in the same partitions, kept in the shared folder: later tasks do not carry the plan that made them.

    Where the application has no checkpoint folder, it gets one in the shared folder.
    """
    context = df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(scratch_path(df.sparkSession, "checkpoints"))
    return df.checkpoint()


def local_table(spark: SparkSession, rows: Sequence[tuple], fields: str) -> DataFrame:
    """A handful of rows as a table whose size Spark knows."""
    schema = T.StructType.fromDDL(fields)
    kinds = {"string": pa.string(), "int": pa.int32(), "bigint": pa.int64(), "double": pa.float64(), "boolean": pa.bool_()}
    arrays = [
        pa.array([row[i] for row in rows], kinds[field.dataType.simpleString()]) for i, field in enumerate(schema)
    ]
    return spark.createDataFrame(pa.table(arrays, names=schema.names), schema=schema)


def saved(df: DataFrame, name: str) -> DataFrame:
    """The rows as a table in the shared folder: computed once, safe from lost executors.

    Spark knows the size of such a table and decides by it whether joins with it are
    broadcast.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
