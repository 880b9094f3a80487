"""Learners that SQL can check, forests by content, kept models, and the queue of cross-validations."""

import numpy as np
import pytest
from conftest import rows
from pyspark.sql import functions as F

from tallyweek.operators import bagging, crossval, models


@pytest.fixture(scope="module")
def table(spark):
    rng = np.random.default_rng(5)
    n = 700
    a, b, c = rng.uniform(0, 10, n), rng.integers(0, 6, n), rng.integers(0, 3, n)
    y = np.round(5 * a + 20 * (b > 2) - 7 * c + rng.normal(0, 1, n), 2)
    data = [(i, float(p), int(q), int(r), float(v)) for i, (p, q, r, v) in enumerate(zip(a, b, c, y))]
    return spark.createDataFrame(data, "id int, a double, b int, c int, y double").cache()


def best_split(x, y):
    """The threshold with the largest fall of the squared error, as SQL and the tree have it."""
    best = (0.0, None)
    values = np.unique(x)
    for t in (values[:-1] + values[1:]) / 2:
        left = x <= t
        gain = len(y) * y.var() - left.sum() * y[left].var() - (~left).sum() * y[~left].var()
        best = max(best, (gain, t))
    return best


def test_tree_nodes(spark, table):
    f = models.fit(table, "y", "tree", ["b", "c"], max_depth=2)
    nodes = {r.node: r for r in models.tree_nodes(f, spark).collect()}
    assert set(nodes) == {1, 2, 3, 4, 5, 6, 7}
    frame = table.toPandas()
    gains = {x: best_split(frame[x].to_numpy(), frame.y.to_numpy()) for x in ("b", "c")}
    top = max(gains, key=lambda x: gains[x][0])
    assert (nodes[1].feature, nodes[1].threshold) == (top, gains[top][1])
    below = frame[frame[top] <= gains[top][1]]
    second = frame[(frame[top] <= gains[top][1]) & (frame[nodes[2].feature] <= nodes[2].threshold)]
    assert len(below) > len(second) and nodes[4].prediction == pytest.approx(second.y.mean())


def test_bag_weights_are_poisson(spark):
    drawn = spark.range(40_000).select(bagging.bag_weight(["id"], 3).alias("w"), bagging.bag_weight(["id"], 4).alias("v"))
    r = drawn.agg(F.avg("w"), F.var_pop("w"), F.corr("w", "v"), F.avg((F.col("w") == 0).cast("int"))).first()
    assert r[0] == pytest.approx(1, abs=0.02) and r[1] == pytest.approx(1, abs=0.04)
    assert abs(r[2]) < 0.02 and r[3] == pytest.approx(np.exp(-1), abs=0.01)


def test_split_points(spark, table):
    cuts = bagging.split_points(table, ["a", "b", "c"], max_bins=8)
    assert cuts["b"] == [0.5, 1.5, 2.5, 3.5, 4.5] and cuts["c"] == [0.5, 1.5]
    assert cuts["a"] == pytest.approx(np.quantile(table.toPandas().a, np.arange(1, 8) / 8))
    assert bagging.split_points(spark.createDataFrame([(1.0,)], "a double"), ["a"]) == {"a": []}


def test_content_forest_does_not_depend_on_partitions(spark, table):
    seen = []
    for n, partitions in ((3, 3), (8, 8), (5, 64), (1, None)):
        f = bagging.content_forest(table.repartition(n), "y", ["a", "b", "c"], ["id"], num_trees=4, max_depth=4, partitions=partitions)
        predicted = rows(models.score(f, table).select("id", "prediction"), "id")
        seen.append((models.feature_importance(f, spark).collect(), predicted))
    for importance, predicted in seen[1:]:
        assert [r.feature for r in importance] == [r.feature for r in seen[0][0]]
        assert [r.importance for r in importance] == pytest.approx([r.importance for r in seen[0][0]], rel=1e-9)
        assert [p for _, p in predicted] == pytest.approx([p for _, p in seen[0][1]], rel=1e-9)
    rmse, r2 = models.compute_metrics(f, table).first()
    assert r2 > 0.8 and sum(r.importance for r in seen[0][0]) == pytest.approx(1)
    assert models.model_overview({"forest": f}, spark).first()["n_trees"] == 4


def test_models_outlive_the_session(spark, table, tmp_path):
    for kind in ("linear", "tree", "gbt"):
        f = models.fit(table, "y", kind, ["a", "b"], **({} if kind == "linear" else {"max_depth": 2}))
        models.save_fit(f, str(tmp_path / kind))
        again = models.load_fit(spark.newSession(), str(tmp_path / kind))
        assert (again.label, again.features, again.dropped, again.columns) == (f.label, f.features, f.dropped, f.columns)
        assert rows(models.score(again, table), "id") == rows(models.score(f, table), "id")
    run = crossval.cross_validate(table, "y", "tree", ["a", "b"], k=3, grid=[{"max_depth": 1}, {"max_depth": 2}], key=["id"])
    crossval.save_run(run, str(tmp_path / "run"))
    again = crossval.load_run(spark, str(tmp_path / "run"))
    assert (again.model, again.params) == (run.model, run.params) and len(again.fits) == 3
    assert rows(again.evals, "fold") == rows(run.evals, "fold")
    assert rows(again.predictions, "id") == rows(run.predictions, "id")
    assert rows(models.score(again.fits[0], table), "id") == rows(models.score(run.fits[0], table), "id")


def test_one_queue_gives_what_single_runs_give(spark, table):
    grids = {"tree": [{"max_depth": 1}, {"max_depth": 3}], "gbt": [{"max_iter": 2, "max_depth": 1}, {"max_iter": 3, "max_depth": 2}]}
    kinds = {"linear": "linear", "gbt": "gbt", "tree": "tree"}
    together = crossval.cross_validate_all(table, "y", kinds, ["a", "b", "c"], k=3, grids=grids, key=["id"])
    assert list(together) == list(kinds)
    for kind in kinds:
        alone = crossval.cross_validate(table, "y", kind, ["a", "b", "c"], k=3, grid=grids.get(kind), key=["id"])
        assert rows(alone.evals, "fold") == rows(together[kind].evals, "fold") and alone.params == together[kind].params
    assert all(p == {"max_depth": 3} for p in together["tree"].params)
    with pytest.raises(ValueError):
        crossval.cross_validate_all(table.where("id < 1"), "y", kinds, ["a"], k=3, key=["id"])


def test_native_scores(table):
    ours = crossval.cross_validate(table, "y", "linear", ["a", "b", "c"], k=3, key=["id"]).evals
    native = crossval.native_scores(table, "y", "linear", ["a", "b", "c"], k=3, key=["id"], grid=[{"regParam": 0.0}, {"regParam": 50.0}])
    first = rows(native.where("point = 0").select("fold", "rmse", "r_squared"), "fold")
    assert np.array(first) == pytest.approx(np.array(rows(ours.select("fold", "rmse", "r_squared"), "fold")))
    assert native.count() == 6 and rows(native.where("point = 1"), "fold")[0][2] > first[0][1]


def test_partitions_follow_the_rows():
    assert [models.partitions_for(n) for n in (0, 1, 20_000, 20_001, 10**9)] == [1, 1, 1, 2, 50_000]


def test_fits_of_large_tables_take_few_tasks():
    assert [models.fit_partitions(n) for n in (0, 1, 38_700, 240_000, 2_300_000, 14_400_000, 10**9)] == [1, 1, 2, 12, 12, 58, 4000]


def test_fits_do_not_carry_the_plan_of_their_rows(spark, table):
    f = models.fit_all(table.select("a", "b", "y"), "y", ["linear", "tree"])["linear"]
    plan = f.model.summary.predictions._jdf.queryExecution().executedPlan().toString()
    assert "Scan ExistingRDD" in plan and "Exchange" not in plan and "InMemory" not in plan
    assert spark.sparkContext.getCheckpointDir()


def test_checkpoints_do_not_change_boosted_trees(table):
    seen = [models.fit(table, "y", "gbt", ["a", "b", "c"], max_iter=5, max_depth=3, checkpoint_interval=i).model.toDebugString.split("\n")[1:] for i in (1, 3, 10)]
    assert seen[0] == seen[1] == seen[2] and models.gbt().getCheckpointInterval() == 3


@pytest.mark.parametrize("select_on", ["train", "inner"])
def test_fits_on_cells_are_those_on_rows(table, monkeypatch, select_on):
    grids = {"tree": [{"max_depth": 1}, {"max_depth": 3}], "gbt": [{"max_iter": 2, "max_depth": 1}, {"max_iter": 4, "max_depth": 2}]}
    seen = []
    for least in (10**9, 0):
        monkeypatch.setattr(crossval, "CELL_ROWS", least)
        runs = crossval.cross_validate_all(table, "y", {"gbt": "gbt", "tree": "tree"}, ["b", "c"], k=3, grids=grids, key=["id"], select_on=select_on)
        seen.append(runs)
    for kind in grids:
        on_rows, on_cells = (run[kind] for run in seen)
        assert on_rows.params == on_cells.params and on_rows.predictions.columns == on_cells.predictions.columns
        for one, other in zip(rows(on_rows.evals, "fold"), rows(on_cells.evals, "fold")):
            assert [x for x in other if isinstance(x, float)] == pytest.approx([x for x in one if isinstance(x, float)], rel=1e-9)
        one, other = (rows(run.predictions.select("id", "prediction"), "id") for run in (on_rows, on_cells))
        assert [r[1] for r in other] == pytest.approx([r[1] for r in one], rel=1e-9)
        again = models.score(on_cells.fits[0], table)
        assert again.columns == [*table.columns, "prediction"] and on_cells.fits[0].features == ["b", "c"]


def test_rows_of_a_cell_are_counted_once(table):
    binned = bagging.binner(["a", "b"], bagging.split_points(table, ["a", "b"], 8)).transform(table)
    met = crossval.cells(binned, "y", ["a", "b"])
    assert met.count() == binned.select("_bin_a", "_bin_b").distinct().count() <= 48
    assert met.agg(F.sum("_weight")).first()[0] == 700
    assert met.agg(F.sum(F.col("_weight") * F.col("y"))).first()[0] == pytest.approx(table.agg(F.sum("y")).first()[0])
