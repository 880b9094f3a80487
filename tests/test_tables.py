import datetime as dt

import pytest
from conftest import rows

from tallyweek.operators import join, quality, reshape, summary
from tallyweek.plans import panel

NAN = float("nan")


def test_joins_need_equal_keys(spark):
    d = dt.date(2010, 2, 12)
    left = spark.createDataFrame([(1, d, True, 10.0), (1, d, False, 20.0), (None, d, True, 30.0)], "k int, d date, f boolean, v double")
    right = spark.createDataFrame([(1, d, True, "a"), (None, d, True, "b")], "k int, d date, f boolean, w string")
    assert rows(join.inner_join(left, right, ["k", "d", "f"])) == [(1, d, True, 10.0, "a")]


def test_salted_join_gives_the_same_rows(spark):
    left = spark.range(1000).selectExpr("if(id < 600, 7, id % 20) as k", "id % 3 as v")
    right = spark.range(20).selectExpr("id as k", "id * 10 as w")
    plain, salted = join.inner_join(left, right, ["k"]), join.inner_join(left, right, ["k"], salt=4)
    assert salted.columns == plain.columns
    assert sorted(rows(salted)) == sorted(rows(plain))


def test_attach_stats_matches_null_groups(spark):
    df = spark.createDataFrame([("a", 1.0), (None, 2.0), (None, 4.0)], "g string, v double")
    stats = df.groupBy("g").agg({"v": "max"}).toDF("g", "top")
    assert rows(join.attach_stats(df, stats, ["g"]), "v") == [("a", 1.0, 1.0), (None, 2.0, 4.0), (None, 4.0, 4.0)]


def test_panel_edges(spark):
    d = dt.date(2010, 1, 1)
    sales = spark.createDataFrame(
        [(1, 1, "2010-01-01", 10.0, True), (1, 2, "2010-01-01", 0.0, True), (1, 3, "2010-01-01", -5.0, True), (2, 1, "2010-01-01", 7.0, False)],
        "store int, dept int, week_date string, weekly_sales double, is_holiday boolean",
    )
    stores = spark.createDataFrame([(1, "A", 100), (2, "D", 200)], "store int, store_type string, store_size int")
    marks = ", ".join(f"markdown_{i} string" for i in range(1, 6))
    features = spark.createDataFrame(
        [(1, "2010-01-01", "1.5", "NA", "NA", "NA", "2", True), (2, "2010-01-01", "NA", "NA", "NA", "NA", "NA", False)],
        f"store int, week_date string, {marks}, is_holiday boolean",
    )
    out = panel.build_panel(sales, stores, features)
    picked = out.select(
        "store", "dept", "week_date", "is_holiday", "markdown_1", "markdown_2", "markdown_5", "type_numeric", "year", "week_of_year"
    )
    assert rows(picked, "store") == [
        (1, 1, d, 1, 1.5, 0.0, 2.0, 1.0, 2010, 53),
        (2, 1, d, 0, 0.0, 0.0, 0.0, None, 2010, 53),
    ]
    assert sorted(rows(panel.build_panel(sales, stores, features, salt=3))) == sorted(rows(out))


def test_missing_and_sign_audit(spark):
    df = spark.createDataFrame([(1.0, "a"), (None, None), (NAN, "c")], "x double, s string")
    assert rows(quality.missing_audit(df)) == [("x", 1, 1), ("s", 1, 0)]
    signs = spark.createDataFrame([(-1.0,), (0.0,), (1.0,), (3.0,)], "x double")
    assert rows(quality.sign_audit(signs, "x")) == [(1, 1, 4, 25.0)]


def test_describe(spark):
    df = spark.createDataFrame(
        [(1, "b", True, dt.date(2010, 1, 1)), (3, "a", False, None), (None, None, None, None)], "n int, s string, f boolean, d date"
    )
    got = {r["column"]: r for r in quality.describe(df).collect()}
    assert tuple(got["n"])[1:6] == (2, 2.0, pytest.approx(2**0.5), 1.0, 3.0)
    assert tuple(got["s"])[1:] == (2, None, None, None, None, "a", "b")
    assert tuple(got["f"])[1:3] == (2, 0.5)
    assert got["d"]["min_text"] == "2010-01-01"


def test_empty_tables(spark):
    df = spark.createDataFrame([], "g string, x double")
    assert rows(quality.missing_audit(df)) == [("g", 0, 0), ("x", 0, 0)]
    assert rows(quality.sign_audit(df, "x")) == [(0, 0, 0, None)]
    assert rows(summary.six_numbers(df, "x")) == [(0, None, None, None, None, None)]
    assert rows(summary.mean_by(df, ["g"], "x")) == []
    assert rows(summary.share_by(df, "g")) == []
    assert rows(summary.holiday_lift(df.selectExpr("true as f", "x"), "f", "x"))[0][:2] == (0, 0)


def test_group_summaries(spark):
    df = spark.createDataFrame(
        [("a", 1, 1.0), ("a", 2, 3.0), ("b", 1, 4.0), ("b", 2, 4.0), ("c", 1, None)], "g string, k int, x double"
    )
    assert rows(summary.count_by(df, "g")) == [("a", 2), ("b", 2), ("c", 1)]
    assert rows(summary.total_by(df, ["g"], "x")) == [("b", 8.0), ("a", 4.0), ("c", None)]
    assert rows(summary.mean_by(df, ["g"], "x", by_value=True)) == [("b", 4.0), ("a", 2.0), ("c", None)]
    assert rows(summary.peak_by(df, ["g"], "x"))[1] == ("b", 4.0, 8.0)
    assert rows(summary.share_by(df, "g")) == [("a", 2, 40.0), ("b", 2, 40.0), ("c", 1, 20.0)]
    assert rows(summary.best_in_group(df, ["g"], "k", "x")) == [("a", 2, 3.0), ("b", 1, 4.0)]
    assert rows(summary.best_in_group(df, ["g"], "k", "x", lowest=True)) == [("a", 1, 1.0), ("b", 1, 4.0)]
    assert rows(summary.top_k(df, "x", ["g", "k"], 2)) == [("b", 1, 4.0), ("b", 2, 4.0)]
    assert rows(summary.order_by_mean(df.where("x is not null"), "g", "x")) == [("a", 2.0, 1), ("b", 4.0, 2)]


def test_plain_sums_are_not_rounded(spark):
    df = spark.createDataFrame([("a", True, 0.004), ("a", True, 0.004), ("a", False, 3.4567)], "g string, f boolean, x double")
    mean = (0.004 + 0.004 + 3.4567) / 3
    assert rows(summary.mean_by(df, ["g"], "x"))[0][1] == pytest.approx(mean) and rows(summary.total_by(df, ["g"], "x"))[0][1] == pytest.approx(3 * mean)
    assert rows(summary.peak_by(df, ["g"], "x"))[0][1:] == (3.4567, pytest.approx(3 * mean))
    assert summary.six_numbers(df, "x").first()["mean_sales"] == pytest.approx(mean)
    assert summary.holiday_lift(df, "f", "x").first()["mean_holiday"] == pytest.approx(0.004)
    assert rows(summary.mean_by(df, ["g"], "x", money=True)) == [("a", pytest.approx(3.46 / 3))]
    endless = spark.createDataFrame([("a", float("inf")), ("a", 1.0)], "g string, x double")
    assert rows(summary.mean_by(endless, ["g"], "x")) == [("a", float("inf"))] and rows(summary.total_by(endless, ["g"], "x")) == [("a", float("inf"))]


def test_holiday_lift_without_flags(spark):
    none = spark.createDataFrame([(0, 10.0), (0, 20.0), (None, 99.0)], "f int, x double")
    assert rows(summary.holiday_lift(none, "f", "x")) == [(0, 2, 0.0, 0.0, None, 15.0, None)]


def test_pivot_of_all_values(spark):
    df = spark.createDataFrame([("a", "y1", 1.0), ("a", "y3", 3.0), ("b", "y2", 2.0)], "id string, y string, v double")
    assert reshape.to_wide(df, ["id"], "y", "v").columns == ["id", "y1", "y2", "y3"]


def test_holiday_lift(spark):
    df = spark.createDataFrame([(1, 30.0), (0, 10.0), (0, 10.0), (0, 10.0)], "f int, x double")
    assert rows(summary.holiday_lift(df, "f", "x")) == [(1, 4, 25.0, 50.0, 30.0, 10.0, 3.0)]


def test_ranks_over_many_ranges(spark):
    df = spark.range(5000).selectExpr("(id * 37) % 5001 as a", "cast(id as string) as s")
    before = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        for parts in ("1", "8", "300"):
            spark.conf.set("spark.sql.shuffle.partitions", parts)
            for order in (["a"], ["s"], ["a", "s"]):
                got = sorted(rows(summary.rank_rows(df, order, "r").select("r", *order)))
                assert [g[1:] for g in got] == sorted(rows(df.select(*order))) and [g[0] for g in got] == list(range(1, 5001))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert rows(summary.category_order(spark.createDataFrame([("b",), ("a",), ("b",), (None,)], "c string"), "c")) == [("a", 1), ("b", 2)]


def test_unions(spark):
    a = spark.createDataFrame([(1, 0.5, 20)], "fold int, rmse double, num_trees int")
    b = spark.createDataFrame([(0.7, 1)], "rmse double, fold int")
    out = reshape.stack_with_id({"RF": a, "DT": b}, "model")
    assert rows(out.select("model", "fold", "rmse", "num_trees")) == [("RF", 1, 0.5, 20), ("DT", 1, 0.7, None)]
    assert reshape.stack_rows(a, a).count() == 2


def test_long_and_wide(spark):
    df = spark.createDataFrame([("a", 1.0, 2.0), ("b", 3.0, None)], "id string, x double, y double")
    long = reshape.to_long(df, ["id"], ["x", "y"])
    assert rows(long, "id", "metric") == [("a", "x", 1.0), ("a", "y", 2.0), ("b", "x", 3.0), ("b", "y", None)]
    assert rows(reshape.to_wide(long, ["id"], "metric", "value", ["x", "y"]), "id") == rows(df)
