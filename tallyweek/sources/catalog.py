"""Named tables: register, list, drop."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tallyweek.functions.sizing import local_table

TABLE_FIELDS = "name string, table_type string, is_temporary boolean"


def publish(df: DataFrame, name: str, overwrite: bool = True, stored: bool = False) -> DataFrame:
    """Make `df` known under `name` and return the named table.

    A temporary view by default; `stored=True` writes a table.
    """
    if stored:
        df.write.mode("overwrite" if overwrite else "errorifexists").saveAsTable(name)
    elif overwrite:
        df.createOrReplaceTempView(name)
    else:
        df.createTempView(name)
    return df.sparkSession.table(name)


def list_tables(spark: SparkSession, pattern: str | None = None) -> DataFrame:
    """The tables and views of the session."""
    rows = [(t.name, t.tableType, t.isTemporary) for t in spark.catalog.listTables(pattern=pattern)]
    return local_table(spark, rows, TABLE_FIELDS).orderBy("name")


def drop_table(spark: SparkSession, name: str) -> None:
    """Forget a view or drop a table; nothing happens if there is none."""
    if not spark.catalog.dropTempView(name):
        spark.sql(f"DROP TABLE IF EXISTS `{name}`")
