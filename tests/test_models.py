import numpy as np
import pytest
from conftest import rows
from pyspark.ml.evaluation import RegressionEvaluator
from pyspark.ml.regression import GeneralizedLinearRegression
from pyspark.sql import functions as F

from tallyweek.operators import crossval, models
from tallyweek.operators.metrics import regression_metrics
from tallyweek.operators.split import hash_bucket, split, with_fold


@pytest.fixture(scope="module")
def learnable(spark):
    rng = np.random.default_rng(11)
    a, b = rng.uniform(0, 10, 600), rng.uniform(0, 10, 600)
    y = 2 * a - 3 * b + rng.normal(0, 0.1, 600)
    data = [(i, float(p), float(q), 1, float(v)) for i, (p, q, v) in enumerate(zip(a, b, y))]
    return spark.createDataFrame(data, "id int, a double, b double, c int, y double").cache()


def ids(df):
    return sorted(r["id"] for r in df.select("id").collect())


def test_split_does_not_depend_on_partitions(learnable):
    for seed in (None, 5):
        parts = split(learnable, {"train": 3, "test": 1}, ["id"], seed)
        again = split(learnable.repartition(7), {"train": 3, "test": 1}, ["id"], seed)
        assert {n: ids(d) for n, d in parts.items()} == {n: ids(d) for n, d in again.items()}
        assert sorted(ids(parts["train"]) + ids(parts["test"])) == list(range(600))
        assert 400 < parts["train"].count() < 500
    assert ids(split(learnable, {"a": 1, "b": 1}, ["id"])["a"]) != ids(split(learnable, {"a": 1, "b": 1}, ["id"], 5)["a"])
    drawn = split(learnable, {"train": 0.75, "test": 0.25}, seed=1234, method="random")
    assert sum(d.count() for d in drawn.values()) == 600


def test_folds_are_a_partition(learnable):
    folds = [ids(with_fold(learnable.repartition(n), 5, ["id"]).where(F.col("fold") == i)) for n in (3,) for i in range(1, 6)]
    assert sorted(sum(folds, [])) == list(range(600)) and all(folds)
    assert learnable.select(hash_bucket(["id"], 5)).distinct().count() == 5
    assert with_fold(learnable, 3).select("fold").distinct().count() == 3


def test_metrics_match_the_evaluator(spark):
    df = spark.createDataFrame([(1.0, 1.5), (2.0, 1.0), (4.0, 4.5), (None, 1.0)], "y double, prediction double")
    rmse, r2 = regression_metrics(df, "y").first()
    whole = df.where("y is not null")
    for name, got in (("rmse", rmse), ("r2", r2)):
        assert got == pytest.approx(RegressionEvaluator(labelCol="y", metricName=name).evaluate(whole))
    assert rows(regression_metrics(spark.createDataFrame([(2.0, 1.0), (2.0, 3.0)], "y double, prediction double"), "y")) == [(1.0, None)]
    assert rows(regression_metrics(df.limit(0), "y")) == [(None, None)]


def test_linear_recovers_the_equation(spark, learnable):
    f = models.fit(learnable, "y", "linear", ["a", "b", "c"])
    table = {r["term"]: r for r in models.linear_summary(f, spark).collect()}
    assert f.dropped == ["c"]
    assert table["a"]["coefficient"] == pytest.approx(2, abs=0.05)
    assert table["b"]["coefficient"] == pytest.approx(-3, abs=0.05)
    assert table["c"]["coefficient"] == 0 and table["c"]["p_value"] is None
    assert table["a"]["p_value"] < 1e-6 and table["a"]["std_error"] > 0
    rmse, r2 = models.compute_metrics(f, learnable).first()
    assert rmse < 0.15 and 0.99 < r2 <= 1
    assert models.score(f, learnable).columns == [*learnable.columns, "prediction"]


def test_trees_beat_the_mean(spark, learnable):
    fits = models.fit_all(learnable.select("a", "b", "y"), "y")
    compared = {r["model"]: r for r in models.compare_models(fits, learnable).collect()}
    assert set(compared) == set(models.MODEL_NAMES.values())
    assert all(r["r_squared"] > 0.5 and r["rmse"] >= 0 for r in compared.values())
    alone = models.compute_metrics(fits["gbt"], learnable).first()
    assert compared["Gradient Boosted Tree"]["rmse"] == pytest.approx(alone["rmse"])
    for kind in ("forest", "gbt", "tree"):
        shares = models.feature_importance(fits[kind], spark).collect()
        assert sum(r["importance"] for r in shares) == pytest.approx(1)
        assert {r["feature"] for r in shares} == {"a", "b"}
    merged = models.compare_importance(fits, spark).collect()
    assert len(merged) == 6 and merged == sorted(merged, key=lambda r: r["mean_importance"])
    overview = {r["model"]: r for r in models.model_overview(fits, spark).collect()}
    assert overview["forest"]["n_trees"] == 20 and overview["tree"]["depth"] <= 5 and overview["linear"]["train_r_squared"] > 0.99


def test_same_seed_same_forest(learnable):
    one, two = (models.fit(learnable, "y", "forest", ["a", "b"], num_trees=5) for _ in range(2))
    assert one.model.toDebugString.split("\n")[1:] == two.model.toDebugString.split("\n")[1:]


def test_text_and_missing_features(spark):
    data = [(["r", "s", "t"][i % 3], float(i % 5) if i % 11 else None, float(i % 3) * 4 + i % 5) for i in range(120)]
    df = spark.createDataFrame(data, "kind string, x double, y double")
    f = models.fit(df, "y", "linear", handle_invalid="skip")
    assert f.features[-1] == "x" and len(f.features) == 3
    assert models.compute_metrics(f, df, "skip").first()["r_squared"] == pytest.approx(1)
    assert models.fit(df.where("kind = 'r'"), "y", models.tree, ["x"], max_depth=2, handle_invalid="skip").model.depth <= 2


def test_formula(learnable):
    assert models.formula_columns(learnable, "y ~ .") == ("y", ["id", "a", "b", "c"])
    assert models.formula_columns(learnable, "y ~ . - id - c") == ("y", ["a", "b"])
    assert models.formula_columns(learnable, "y ~ b + a") == ("y", ["b", "a"])
    with pytest.raises(ValueError):
        models.formula_columns(learnable, "y ~ nope")
    assert models.fit(learnable, "y ~ . - id").features == ["a", "b"]


def test_small_parts_are_not_empty(spark):
    df = spark.range(100_000)
    for weights in ({"a": 0.996, "b": 0.004}, {"a": 0.9, "b": 0.096, "c": 0.004}):
        sizes = {name: part.count() for name, part in split(df, weights, ["id"]).items()}
        assert sum(sizes.values()) == 100_000
        assert all(abs(sizes[name] / 100_000 - w) < 0.004 and sizes[name] > 0 for name, w in weights.items())
    assert split(df, {"all": 2}, ["id"])["all"].count() == 100_000


def test_missing_features_are_an_error_unless_told(spark):
    data = [(float(i) if i % 4 else None, float(i % 7), 2.0 * i) for i in range(40)]
    df = spark.createDataFrame(data, "a double, b double, y double")
    with pytest.raises(Exception):
        models.fit(df, "y", "tree")
    f = models.fit(df, "y", "tree", handle_invalid="skip")
    with pytest.raises(Exception):
        models.score(f, df).collect()
    assert models.score(f, df, "skip").count() == 30
    kept = models.score(f, df, "keep").collect()
    assert len(kept) == 40 and all((r["prediction"] is None) == (r["a"] is None) for r in kept)
    with pytest.raises(ValueError):
        models.score(f, df, "drop")
    fits = models.fit_all(df, "y", ["tree", "linear"], handle_invalid="skip")
    assert models.compare_models(fits, df, "skip").count() == 2


def test_forest_depends_on_content_only(learnable, spark):
    df = learnable.select("a", "b", "y")
    shares = [models.feature_importance(models.fit(df.repartition(n), "y", "forest", num_trees=4), spark).collect() for n in (3, 7)]
    assert shares[0] == shares[1]
    trees = [models.fit_all(df.repartition(n), "y", ["forest"])["forest"].model.toDebugString.split("\n")[1:] for n in (2, 5)]
    assert trees[0] == trees[1]


def test_plain_forest_is_the_tree(learnable):
    df = learnable.select("a", "b", "y")
    one = models.fit(df, "y", "tree", max_depth=2)
    same = models.fit(df, "y", "forest", num_trees=3, max_depth=2, bootstrap=False, feature_subset="all")
    a, b = (sorted(r["prediction"] for r in models.score(f, df).collect()) for f in (one, same))
    assert a == pytest.approx(b)


def test_folds_outside_the_range_are_refused(learnable):
    data = learnable.select((F.col("id") % 4).alias("part"), "a", "b", "y")
    with pytest.raises(ValueError, match="folds must be"):
        crossval.cross_validate(data, "y", "tree", k=5, fold_column="part")
    with pytest.raises(ValueError, match="has no rows"):
        crossval.cross_validate(data.withColumn("part", F.col("part") + 1), "y", "tree", k=5, fold_column="part")


def test_predictions_are_read_without_the_source(learnable):
    run = crossval.cross_validate(learnable.drop("c"), "y", "linear", ["a", "b"], k=3, key=["id"])
    plan = run.predictions._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Scan") == 1 and run.predictions.count() == 600


def test_first_point_wins_a_tie():
    assert crossval.choose([float("nan"), 1.0]) == 1 and crossval.choose([None, 2.0]) == 1
    with pytest.raises(ValueError):
        crossval.choose([None, float("nan")])
    assert crossval.choose([2.0, 1.0, 1.0]) == 1
    assert crossval.choose([1.0, 1.0]) == 0


@pytest.mark.parametrize("select_on", ["train", "inner"])
def test_cross_validation(spark, learnable, select_on):
    grid = [{"max_depth": 1}, {"max_depth": 4}, {"max_depth": 4}]
    run = crossval.cross_validate(
        learnable.drop("c"), "y", "tree", ["a", "b"], k=3, grid=grid, key=["id"], select_on=select_on
    )
    evals = run.evals.orderBy("fold").collect()
    assert [r["fold"] for r in evals] == [1, 2, 3]
    assert all(r["max_depth"] == 4 and r["num_trees"] is None and r["max_iter"] is None for r in evals)
    assert all(r["r_squared"] > 0.5 and r["select_rmse"] > 0 for r in evals)
    held_out = run.predictions
    assert ids(held_out) == list(range(600))
    by_hand = regression_metrics(held_out.where("fold = 2"), "y").first()
    assert by_hand["rmse"] == pytest.approx(evals[1]["rmse"]) and by_hand["r_squared"] == pytest.approx(evals[1]["r_squared"])
    one = regression_metrics(models.score(run.fits[1], with_fold(learnable, 3, ["id"]).where("fold = 2")), "y").first()
    assert one["rmse"] == pytest.approx(evals[1]["rmse"])
    long = crossval.cv_long(crossval.cv_results([run])).collect()
    assert len(long) == 6 and {r["axis"] for r in long} == {"Decision Tree.1", "Decision Tree.2", "Decision Tree.3"}
    shares = crossval.cv_importance([run], spark).collect()
    assert len(shares) == 6 and {r["fold"] for r in shares} == {1, 2, 3}
    both = crossval.cv_vs_holdout(spark.createDataFrame([("tree", 1.0, 0.9)], "model string, rmse double, r_squared double"), run.evals)
    assert both.first()["cv_rmse_mean"] == pytest.approx(np.mean([r["rmse"] for r in evals]))


def test_cross_validation_with_own_folds_and_constructor(learnable):
    data = learnable.select((F.col("id") % 2 + 1).alias("part"), "a", "b", "c", "y")
    run = crossval.cross_validate(data, "y", models.linear, k=2, fold_column="part")
    assert run.fits[0].dropped == ["c"] and run.model == "linear"
    assert all(r["r_squared"] > 0.99 for r in run.evals.collect())
    built = crossval.cross_validate(
        data, "y", lambda: GeneralizedLinearRegression(featuresCol=models.FEATURES), ["a", "b"], k=2, fold_column="part", name="glm"
    )
    assert all(r["model"] == "glm" and r["r_squared"] > 0.99 for r in built.evals.collect())
    with pytest.raises(ValueError):
        crossval.cross_validate(data, "y", "tree", select_on="test")
