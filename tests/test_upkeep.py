"""Refreshed partitions, bad lines, and summaries by micro-batches."""

from pathlib import Path

import pytest
from conftest import rows

from tallyweek.operators import quality, summary
from tallyweek.sources import files
from tallyweek.streaming import running


def test_refresh_leaves_other_years(spark, tmp_path):
    path = str(tmp_path / "t")
    files.save_table(spark.createDataFrame([(1, 2010), (2, 2011), (3, 2012)], "a int, year int"), path, ["year"])
    before = {p: p.stat().st_mtime_ns for p in Path(path).rglob("*.parquet") if "year=2011" not in str(p)}
    files.save_table(spark.createDataFrame([(9, 2011), (8, 2011)], "a int, year int"), path, ["year"], replace="partitions")
    assert rows(files.load_table(spark, path), "a") == [(1, 2010), (3, 2012), (8, 2011), (9, 2011)]
    assert before == {p: p.stat().st_mtime_ns for p in Path(path).rglob("*.parquet") if "year=2011" not in str(p)}
    plan = files.load_table(spark, path).where("year = 2011")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(year" in plan
    files.save_table(spark.createDataFrame([(5, 2013)], "a int, year int"), path, ["year"])
    assert rows(files.load_table(spark, path)) == [(5, 2013)]
    with pytest.raises(ValueError):
        files.save_table(spark.range(1), path, replace="partitions")
    with pytest.raises(ValueError):
        files.save_table(spark.range(1), path, replace="some")


def test_bad_lines(spark, tmp_path):
    path = tmp_path / "in.csv"
    path.write_text('a,b,c\n1,2.5,x\n2,NA,y\nthree,1.0,z\n4,1.0\n5,1.0,u,v\n6,"bad, too",w\n7,3.0,\n')
    good, bad = files.read_checked(spark, str(path), "a int, b double, c string")
    assert rows(good, "a") == [(1, 2.5, "x"), (2, None, "y"), (7, 3.0, None)]
    assert sorted(r.line for r in bad.collect()) == ["4,1.0", "5,1.0,u,v", '6,"bad, too",w', "three,1.0,z"]
    assert good.count() + bad.count() == 7 and good.select("c").count() == 3  # whichever columns are asked for
    assert all(r.file.endswith("in.csv") for r in bad.collect())
    files.quarantine(bad, str(tmp_path / "bad"))
    assert files.quarantine(bad.limit(1), str(tmp_path / "bad")).count() == 5


def test_running_sums_equal_the_batch_result(spark, tmp_path):
    data = [(i % 3, None if i % 10 == 0 else (i % 7 - 2) * 12.25) for i in range(200)]
    df = spark.createDataFrame(data, "k int, x double")
    path, state = str(tmp_path / "in"), str(tmp_path / "state")
    df.limit(120).repartition(5).write.parquet(path)
    source = lambda: running.file_source(spark, path, df.schema, files_per_batch=2)
    running.follow(source(), ["k"], "x", state)
    seen = spark.read.parquet(path)

    def same(whole):
        got = {r.k: r for r in running.summaries(spark, state, ["k"]).collect()}
        assert {k: r.avg_sales for k, r in got.items()} == pytest.approx(dict(rows(summary.mean_by(whole, ["k"], "x", money=True))))
        assert {k: r.n_rows for k, r in got.items()} == dict(rows(summary.count_by(whole, "k")))
        for k, r in got.items():
            own = whole.where(whole.k == k)
            assert (r.n_negative, r.n_zero, r.n_rows) == quality.sign_audit(own, "x").first()[:3]
            assert r.n_missing == quality.missing_audit(own, ["x"]).first()["n_null"]
            assert (r.low, r.high) == tuple(quality.value_range(own, "x").first())

    same(seen)
    assert len(list(Path(state, "sums").glob("batch=*"))) == 3
    running.follow(source(), ["k"], "x", state)  # nothing new
    same(seen)
    df.subtract(seen).limit(40).repartition(2).write.mode("append").parquet(path)
    running.follow(source(), ["k"], "x", state)
    same(spark.read.parquet(path))


def test_a_repeated_batch_counts_once(spark, tmp_path):
    df = spark.createDataFrame([(1, 2.0), (1, 3.5)], "k int, x double")
    for _ in range(2):
        running.partial_sums(df, ["k"], "x").write.mode("overwrite").parquet(f"{tmp_path}/sums/batch=0")
    assert running.summaries(spark, str(tmp_path), ["k"]).first()["n"] == 2
