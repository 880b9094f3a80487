import datetime as dt

import pytest
from conftest import rows

from tallyweek.functions import sizing
from tallyweek.sources import catalog, files, preview, standin


def test_bare_cr_file_with_na(spark, tmp_path):
    path = tmp_path / "cr.csv"
    path.write_bytes(b"store,kind,size\r1,A,100\r2,B,NA\r3,C,300\r")
    df = files.read_delimited(spark, str(path))
    assert df.schema["size"].dataType.typeName() == "integer"
    assert rows(df, "store") == [(1, "A", 100), (2, "B", None), (3, "C", 300)]
    typed = files.read_delimited(spark, str(path), "store int, kind string, size double")
    assert rows(typed, "store")[1] == (2, "B", None)


def test_delimited_roundtrip_keeps_nulls(spark, tmp_path):
    df = spark.createDataFrame([(1, None, True), (2, 2.5, False)], "a int, b double, c boolean")
    files.write_delimited(df, str(tmp_path / "out"))
    assert rows(files.read_delimited(spark, str(tmp_path / "out"), df.schema), "a") == rows(df, "a")


def test_parquet_partitions_are_pruned(spark, tmp_path):
    df = spark.createDataFrame([(1, 2010), (2, 2011)], "a int, year int")
    files.save_table(df, str(tmp_path / "t"), ["year"])
    again = files.load_table(spark, str(tmp_path / "t")).where("year = 2011")
    assert rows(again) == [(2, 2011)]
    assert len(again.inputFiles()) >= 1


def test_publish_list_drop(spark):
    one, two = spark.range(1), spark.range(2)
    catalog.publish(one, "t_view")
    assert catalog.publish(two, "t_view").count() == 2
    catalog.publish(one, "t_stored", stored=True)
    assert catalog.publish(two, "t_stored", stored=True).count() == 2
    assert rows(catalog.list_tables(spark, "t_*")) == [("t_stored", "MANAGED", False), ("t_view", "TEMPORARY", True)]
    catalog.drop_table(spark, "t_view")
    catalog.drop_table(spark, "t_stored")
    catalog.drop_table(spark, "t_stored")
    assert rows(catalog.list_tables(spark, "t_*")) == []


def test_glimpse_and_dims(spark):
    df = spark.createDataFrame([(2, "b"), (1, None), (3, "c")], "n int, s string")
    assert rows(preview.glimpse(df, 2, ["n"])) == [(1, "n", "int", "1, 2"), (2, "s", "string", "NULL, b")]
    assert rows(preview.dims({"t": df, "none": df.limit(0)})) == [("t", 3, 2), ("none", 0, 2)]


def test_standin_counts(spark):
    sf = "/root/testdata/sf0.01"
    sales, features = standin.sales(spark, sf), standin.features(spark, sf)
    assert sales.count() == 53276
    assert sales.where("weekly_sales < 0").count() == 17728
    assert sales.where("weekly_sales > 200000").count() == 42
    assert features.count() == 29036
    assert [features.where(f"markdown_{i} = 'NA'").count() for i in (1, 2, 3)] == [5461, 10037, 13538]


def test_standin_years_lose_nothing(spark, small):
    some = standin.sales(spark, small, years=(1996, 1998))
    all_of_it = standin.sales(spark, small).where("year(week_date) between 1996 and 1998")
    assert sorted(rows(some)) == sorted(rows(all_of_it))
    assert "GreaterThanOrEqual(l_shipdate" in some._jdf.queryExecution().executedPlan().toString()


def test_saved_tables_are_in_the_shared_folder(spark):
    df = spark.range(100).withColumnRenamed("id", "a")
    again = sizing.saved(df, "numbers")
    assert sorted(rows(again)) == sorted(rows(df)) and spark.conf.get("spark.checkpoint.dir") in again.inputFiles()[0]
    dates = spark.createDataFrame([(dt.date(2010, 1, 1), None)], "d date, x decimal(18,2)")
    assert rows(sizing.saved(dates, "dates")) == rows(dates) and sizing.saved(dates.limit(0), "none").count() == 0


def test_fetch_refuses_rather_than_cuts(spark):
    assert len(preview.fetch(spark.range(10), 10)) == 10
    with pytest.raises(ValueError):
        preview.fetch(spark.range(11), 10)
