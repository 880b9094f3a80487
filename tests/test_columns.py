import datetime as dt

import pytest
from conftest import rows
from pyspark.sql import functions as F

from tallyweek.functions import calendar, columns
from tallyweek.operators import clean
from tallyweek.plans import panel

DATES = [dt.date(2010, 1, 1), dt.date(2010, 12, 31), dt.date(2011, 11, 25), dt.date(2012, 1, 1), dt.date(2012, 12, 31)]


def test_text_na_leaves_other_types_alone(spark):
    df = spark.createDataFrame(
        [("NA", 1.0, DATES[0], True, "7"), ("x", None, None, None, "NA")],
        "s string, d double, t date, b boolean, n string",
    )
    out = columns.text_na_to_null(df, types={"n": "double"})
    assert rows(out) == [(None, 1.0, DATES[0], True, 7.0), ("x", None, None, None, None)]


def test_fill_and_column_ranges(spark):
    df = spark.createDataFrame([(1, None, float("nan"), 3.0, 4)], "a int, m1 double, m2 double, m3 double, z int")
    assert columns.columns_between(df, "m1", "m3") == ["m1", "m2", "m3"]
    with pytest.raises(ValueError):
        columns.columns_between(df, "m3", "m1")
    assert rows(columns.fill_missing(df, ["m1", "m2", "m3"], 0.0)) == [(1, 0.0, 0.0, 3.0, 4)]
    assert columns.drop_columns(df, "z", "nope", prefix="m").columns == ["a"]
    assert columns.other_columns(df, "a", "z") == ["m1", "m2", "m3"]


def test_select_numeric(spark):
    df = spark.createDataFrame([(1, "x", 2.0, True)], "a int, s string, d double, b boolean")
    assert columns.select_numeric(df).columns == ["a", "d"]


def test_unknown_type_has_no_code(spark):
    df = spark.createDataFrame([("A",), ("B",), ("C",), ("D",), (None,)], "t string")
    out = df.select(columns.encode(F.col("t"), panel.TYPE_CODES), columns.lookup(F.col("t"), {"A": "one"}))
    assert rows(out) == [(1.0, "one"), (2.0, None), (3.0, None), (None, None), (None, None)]


def test_week_edges(spark):
    df = spark.createDataFrame([(d,) for d in DATES], "d date")
    out = df.select(calendar.iso_week(F.col("d")), calendar.week_block(F.col("d")))
    assert rows(out) == [(53, 1), (52, 53), (47, 47), (52, 1), (1, 53)]
    assert rows(calendar.with_calendar(df, "d"))[0] == (DATES[0], 2010, 1, 53)
    assert clean.keep_years(df, "d", 2010).count() == 2
    assert clean.keep_years(df, "d", 2010, 2011).count() == 3


def test_labels_and_numbers(spark):
    df = spark.createDataFrame([(1, 3, 2.0, "a"), (0, 0, 0.125, None)], "p int, w int, x double, s string")
    out = df.select(
        columns.percent(F.col("p"), F.col("w")), columns.fixed_text(F.col("x")), columns.joined_label(F.col("s"), F.col("p"))
    )
    assert rows(out) == [(pytest.approx(100 / 3), "2.00", "a.1"), (None, "0.13", "0")]


def test_dates_and_flags(spark):
    df = spark.createDataFrame([("2010-02-05", True, 1), ("2010-02-12", None, 2)], "d string, f boolean, i int")
    out = columns.bools_to_int(columns.to_dates(df, "d"), "f")
    assert rows(out) == [(dt.date(2010, 2, 5), 1, 1), (dt.date(2010, 2, 12), None, 2)]


def test_money_is_exact_in_any_partitioning(spark):
    df = spark.range(100_000).select((F.col("id") % 97 * 0.01 + 0.1).alias("x"))
    want = sum(round((i % 97) * 0.01 + 0.1, 2) for i in range(100_000))
    got = [df.repartition(n).agg(columns.money_sum(F.col("x"))).first()[0] for n in (1, 3, 7)]
    assert len(set(got)) == 1 and got[0] == pytest.approx(want)
    with_nan = spark.createDataFrame([(1.0,), (float("nan"),), (None,), (2.0,)], "x double")
    assert rows(with_nan.agg(columns.money_sum(F.col("x")), columns.money_mean(F.col("x")))) == [(3.0, 1.5)]


def test_filters(spark):
    df = spark.createDataFrame([(-1.0,), (0.0,), (1.0,), (None,), (float("nan"),), (5.0,)], "x double")
    assert rows(clean.keep_positive(df, "x")) == [(1.0,), (5.0,)]
    assert rows(clean.keep_present(df, "x")) == [(-1.0,), (0.0,), (1.0,), (5.0,)]
    assert rows(clean.keep_members(df, "x", [0.0, 5.0])) == [(0.0,), (5.0,)]
    assert rows(clean.keep_equal(df, "x", 1.0)) == [(1.0,)]
    assert rows(clean.clip(df, "x", 1.0)) == [(-1.0,), (0.0,), (1.0,)]
    assert rows(clean.clip(df, "x", 4.0, lower=0.5)) == [(1.0,)]
