"""Every query with SQL gives the rows of its SQL."""

from pathlib import Path

import duckdb
import pytest
from conftest import SMALL

import __spark_entry__ as contract
from tools.check_queries import normal

SQL, QUERIES = contract.oracle_sql(), contract.queries()


@pytest.fixture(scope="module")
def db():
    connection = duckdb.connect()
    for path in Path(SMALL).glob("*.parquet"):
        connection.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    return connection


def test_entry(spark):
    out = contract.entry(spark)
    assert out.columns == ["year", "week_of_year", "avg_sales"] and out.count() > 300


def test_sql_names():
    assert set(SQL) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(SQL))
def test_same_rows_as_sql(spark, db, name):
    got, want = QUERIES[name](spark, SMALL).toPandas(), db.execute(SQL[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert normal(got) == normal(want)


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(SQL)))
def test_other_queries_give_rows(spark, name):
    assert len(QUERIES[name](spark, SMALL).collect()) > 0


@pytest.mark.parametrize("name", ["star_merge", "join_features", "boxplot_sales_by_type", "sales_summary", "regression_metrics"])
def test_same_rows_without_broadcasts(spark, db, name):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = QUERIES[name](spark, SMALL)
        assert "BroadcastHashJoin" not in plan._jdf.queryExecution().executedPlan().toString()
        assert normal(plan.toPandas()) == normal(db.execute(SQL[name]).df())
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
