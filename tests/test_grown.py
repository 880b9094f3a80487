"""Trees grown on cells in single tasks, held against Spark's learners on rows."""

import uuid

import numpy as np
import pytest
from conftest import rows
from pyspark.sql import functions as F

from tallyweek.operators import bagging, crossval, grown, models

FEATURES = ["a", "b", "c"]


@pytest.fixture(scope="module")
def table(spark):
    rng = np.random.default_rng(3)
    n = 900
    a, b, c = rng.integers(0, 9, n), rng.integers(0, 5, n), rng.integers(0, 2, n)
    y = np.round(4 * a + 15 * (b > 2) * c - 6 * c + rng.normal(0, 2, n), 2)
    data = [(i, int(p), int(q), int(r), float(v)) for i, (p, q, r, v) in enumerate(zip(a, b, c, y))]
    return spark.createDataFrame(data, "id int, a int, b int, c int, y double").cache()


def run(table, kind, grid, least, monkeypatch, **more):
    monkeypatch.setattr(crossval, "CELL_ROWS", least)
    return crossval.cross_validate(table, "y", kind, FEATURES, k=3, grid=grid, key=["id"], **more)


def jobs(spark, work):
    group = uuid.uuid4().hex
    spark.sparkContext.setJobGroup(group, "")
    try:
        work()
        return len(spark.sparkContext.statusTracker().getJobIdsForGroup(group))
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def test_jobs_do_not_grow_with_rounds_and_levels(spark, table, monkeypatch):
    seen = [jobs(spark, lambda n=n, d=d: run(table, "gbt", [{"max_iter": n, "max_depth": d}], 0, monkeypatch)) for n, d in ((2, 1), (12, 3))]
    assert 0 < seen[0] and abs(seen[1] - seen[0]) <= 3


def test_forest_without_draws_is_that_of_spark(spark, table, monkeypatch):
    grid = [{"num_trees": 2, "max_depth": d, "bootstrap": False, "feature_subset": "all"} for d in (1, 3)]
    on_rows, on_cells = (run(table, "forest", grid, least, monkeypatch) for least in (10**9, 0))
    for one, other in zip(rows(on_rows.evals, "fold"), rows(on_cells.evals, "fold")):
        assert [x for x in other if isinstance(x, float)] == pytest.approx([x for x in one if isinstance(x, float)], rel=1e-9)
    for one, other in zip(on_rows.fits, on_cells.fits):
        assert list(other.model.featureImportances) == pytest.approx(list(one.model.featureImportances), rel=1e-8)
        assert other.model.totalNumNodes == one.model.totalNumNodes and len(other.model.trees) == 2


@pytest.mark.parametrize("kind, grid", [("gbt", [{"max_iter": 5, "max_depth": 3}]), ("tree", [{"max_depth": 4}]), ("forest", [{"num_trees": 6, "max_depth": 4}])])
def test_models_predict_what_was_scored(spark, table, tmp_path, monkeypatch, kind, grid):
    cv = run(table, kind, grid, 0, monkeypatch)
    on_rows = run(table, kind, grid, 10**9, monkeypatch)
    for i, (own, f) in enumerate(zip(rows(cv.evals, "fold"), cv.fits), start=1):
        held_out = cv.predictions.where(F.col("fold") == i)
        kept, again = rows(held_out.select("id", "prediction"), "id"), rows(models.score(f, held_out.drop("prediction")).select("id", "prediction"), "id")
        assert [r[1] for r in again] == pytest.approx([r[1] for r in kept], rel=1e-9)
        y, p = (np.array([r[c] for r in held_out.collect()]) for c in ("y", "prediction"))
        assert own[2] == pytest.approx(np.sqrt(((y - p) ** 2).mean())) and own[3] == pytest.approx(1 - ((y - p) ** 2).mean() / y.var())
        assert own[3] == pytest.approx(rows(on_rows.evals, "fold")[i - 1][3], abs=0.15 if kind == "forest" else 1e-9)
        assert sum(f.model.featureImportances) == pytest.approx(1)
    assert cv.predictions.columns == on_rows.predictions.columns and cv.predictions.count() == 900
    models.save_fit(cv.fits[0], str(tmp_path / kind))
    kept = models.load_fit(spark, str(tmp_path / kind))
    assert rows(models.score(kept, table), "id") == rows(models.score(cv.fits[0], table), "id")


def test_forest_does_not_depend_on_partitions(spark, table, monkeypatch):
    grid = [{"num_trees": 3, "max_depth": 2}, {"num_trees": 5, "max_depth": 4}]
    monkeypatch.setattr(grown, "CHUNK", 200)
    seen = [rows(run(table.repartition(n), "forest", grid, 0, monkeypatch).evals, "fold") for n in (1, 7)]
    for one, other in zip(*seen):
        assert [x for x in other if isinstance(x, float)] == pytest.approx([x for x in one if isinstance(x, float)], rel=1e-9)
    on_rows = rows(run(table, "forest", grid, 10**9, monkeypatch).evals, "fold")
    assert [r[2] for r in seen[0]] == pytest.approx([r[2] for r in on_rows], rel=0.25)


def test_too_many_cells_are_left_to_spark(spark, table, monkeypatch):
    grid = [{"max_depth": 1}, {"max_depth": 3}]
    seen = []
    for most in (10**9, 0):
        monkeypatch.setattr(grown, "MOST_GROUPS", most)
        seen.append([x for r in rows(run(table, "tree", grid, 0, monkeypatch, select_on="inner").evals, "fold") for x in r if isinstance(x, float)])
    assert seen[0] == pytest.approx(seen[1], rel=1e-9)


def test_missing_features_are_an_error(spark, table, monkeypatch):
    with pytest.raises(Exception, match="missing|Bucketizer|NULL|null"):
        run(table.withColumn("a", F.when(F.col("id") != 5, F.col("a"))), "tree", [{}], 0, monkeypatch)


def test_draws():
    keys = np.random.default_rng(1).integers(-(2**62), 2**62, 200_000)
    one, two = grown.drawn(keys, 1234, 0).astype(float), grown.drawn(keys, 1234, 1).astype(float)
    assert one.mean() == pytest.approx(1, abs=0.01) and one.var() == pytest.approx(1, abs=0.02) and (one == 0).mean() == pytest.approx(np.exp(-1), abs=0.005)
    assert abs(np.corrcoef(one, two)[0, 1]) < 0.01 and abs(np.corrcoef(one, np.arange(200_000) % 7)[0, 1]) < 0.01
    used = grown.allowed(np.arange(1, 20_001), 7, 3, 1234, 4)
    assert used.shape == (20_000, 3) and (np.diff(used, axis=1) > 0).all()
    assert np.bincount(used.ravel(), minlength=7) / 20_000 == pytest.approx(np.full(7, 3 / 7), abs=0.02)


def test_split_points_of_counted_values_are_those_of_ranges(spark, monkeypatch):
    rng = np.random.default_rng(8)
    df = spark.createDataFrame([(float(x), int(i)) for x, i in zip(rng.normal(0, 5, 3000).round(1), rng.integers(0, 90, 3000))], "x double, i int")
    counted = bagging.split_points(df, ["x", "i"])
    monkeypatch.setattr(bagging, "COUNTED_VALUES", 0)
    assert bagging.split_points(df, ["x", "i"]) == counted
    assert counted["x"] == pytest.approx(np.unique(np.quantile([r.x for r in df.collect()], np.arange(1, 32) / 32)))


def test_fits_of_large_tables_are_grown(spark, table, monkeypatch):
    params = {"gbt": {"max_iter": 4, "max_depth": 2}, "tree": {"max_depth": 3}, "forest": {"num_trees": 2, "max_depth": 3, "bootstrap": False, "feature_subset": "all"}}
    rows_of = table.drop("id")
    seen, counted = [], []
    for least, rounds in ((10**9, 4), (0, 4), (0, 14)):
        monkeypatch.setattr(models, "CELL_ROWS", least)
        params["gbt"]["max_iter"] = rounds
        counted.append(jobs(spark, lambda: seen.append(models.fit_all(rows_of, "y", ["gbt", "linear", "tree", "forest"], params=params))))
    on_rows, on_cells, _ = seen
    assert list(on_cells) == list(on_rows) == ["gbt", "linear", "tree", "forest"] and abs(counted[2] - counted[1]) <= 3
    for kind, f in on_rows.items():
        one, other = (rows(models.score(x, table).select("id", "prediction"), "id") for x in (f, on_cells[kind]))
        assert [r[1] for r in other] == pytest.approx([r[1] for r in one], rel=1e-9)
    assert rows(models.model_overview(on_cells, spark), "model")[0][:4] == rows(models.model_overview(on_rows, spark), "model")[0][:4]
    one, other = (rows(models.compare_models(x, table), "model") for x in (on_rows, on_cells))
    assert [r[1:] for r in other] == [pytest.approx(r[1:], rel=1e-9) for r in one]


def test_about_distinct(spark):
    df = spark.range(60_000).select((F.col("id") % 40).cast("double").alias("a"), F.col("id").cast("double").alias("b"), F.lit(None).cast("double").alias("c"))
    a, b, c = bagging._about_distinct(df)
    assert (a, c) == (40, 0) and b == pytest.approx(60_000, rel=0.15)


def test_first_of_equal_splits_whatever_the_rounding():
    rng = np.random.default_rng(2)
    a = rng.integers(0, 6, 400)
    bins = np.stack([a, 5 - a, a]).astype(np.uint8)  # three names for the same splits
    w, y = rng.integers(1, 9, 400).astype(float), rng.normal(50_000, 30_000, 400)
    for _ in range(10):
        order = rng.permutation(400)
        made, _ = grown.grow(bins[:, order], [6, 6, 6], w[order], (w * y)[order], 4)
        assert set(made["feature"]) == {-1, 0}
