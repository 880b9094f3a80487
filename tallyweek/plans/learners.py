"""Queries on learners whose results SQL can give too: few features, shallow trees, small grids.

Beside them stand the queries with the full parameters, in `queries`; both call the same operators.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyweek.functions.sizing import scratch_path
from tallyweek.operators import bagging, crossval, models, reshape
from tallyweek.plans.queries import KEY, Query, _fits, model_parts, once, rounded

# Features that have no more values than a tree has bins. The store type is left out: among two sizes
# it can make the same split as the size does, and which of two equal splits is taken is a matter of rounding.
SMALL = ["is_holiday", "dept", "store_size"]
DEPTHS = [{"max_depth": 1}, {"max_depth": 2}]
RIDGE = [{"reg_param": 0.0}, {"reg_param": 3000.0}, {"reg_param": 30000.0}]
# Without draws, a forest is its tree.
PARAMS = {
    "forest": {"num_trees": 3, "max_depth": 2, "bootstrap": False, "feature_subset": "all"},
    "gbt": {"max_iter": 2, "max_depth": 2},
    "tree": {"max_depth": 2},
}

QUERIES: dict[str, Query] = {}


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


def _parts(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    wanted = list(dict.fromkeys([*KEY, *SMALL, "weekly_sales"]))
    return {name: part.select(*wanted) for name, part in model_parts(spark, sf_dir, keep_key=True).items()}


@once
def _small_fits(spark, sf_dir) -> dict[str, models.Fit]:
    train = _parts(spark, sf_dir)["train"].select("weekly_sales", *SMALL)
    return models.fit_all(train, "weekly_sales", params=PARAMS)


def _predicted(spark, sf_dir, kind: str) -> DataFrame:
    scored = models.score(_small_fits(spark, sf_dir)[kind], _parts(spark, sf_dir)["test"])
    return rounded(scored.select(*KEY, "prediction"), 4, "prediction")


@query
def tree_predictions(spark, sf_dir):
    """M7, M9."""
    return _predicted(spark, sf_dir, "tree")


@query
def forest_predictions(spark, sf_dir):
    """M5, M9."""
    return _predicted(spark, sf_dir, "forest")


@query
def gbt_predictions(spark, sf_dir):
    """M6, M9."""
    return _predicted(spark, sf_dir, "gbt")


@query
def tree_nodes(spark, sf_dir):
    """M8: the tree as a table of nodes."""
    return rounded(models.tree_nodes(_small_fits(spark, sf_dir)["tree"], spark), 4, "prediction")


def _compared(spark, sf_dir) -> DataFrame:
    return models.compare_models(_small_fits(spark, sf_dir), _parts(spark, sf_dir)["test"])


@query
def small_comparison(spark, sf_dir):
    """M10, M11, M12."""
    return rounded(rounded(_compared(spark, sf_dir), 3, "rmse"), 7, "r_squared")


@query
def small_comparison_long(spark, sf_dir):
    """M13."""
    return reshape.to_long(small_comparison(spark, sf_dir), ["model"], ["rmse", "r_squared"])


@query
def small_importance(spark, sf_dir):
    """M14."""
    return rounded(models.feature_importance(_small_fits(spark, sf_dir)["forest"], spark), 8, "importance")


@query
def small_importance_compare(spark, sf_dir):
    """M15."""
    return rounded(rounded(models.compare_importance(_small_fits(spark, sf_dir), spark), 8, "importance"), 6, "mean_importance")


# Grids


def _train(spark, sf_dir) -> DataFrame:
    return _parts(spark, sf_dir)["train"]


@once
def _grid_tree(spark, sf_dir):
    return crossval.cross_validate(_train(spark, sf_dir), "weekly_sales", "tree", SMALL, grid=DEPTHS, key=KEY)


@once
def _grid_tree_inner(spark, sf_dir):
    return crossval.cross_validate(_train(spark, sf_dir), "weekly_sales", "tree", SMALL, grid=DEPTHS, key=KEY, select_on="inner")


def _shown(evals: DataFrame, *point: str) -> DataFrame:
    out = evals.select("model", "fold", *point, "select_rmse", "rmse", "r_squared")
    return rounded(rounded(out, 3, "rmse", "select_rmse"), 7, "r_squared")


@query
def grid_tree(spark, sf_dir):
    """The point chosen on the rows fitted on, fold by fold."""
    return _shown(_grid_tree(spark, sf_dir).evals, "max_depth")


@query
def grid_tree_inner(spark, sf_dir):
    """The point chosen on rows set aside."""
    return _shown(_grid_tree_inner(spark, sf_dir).evals, "max_depth")


@query
def grid_long(spark, sf_dir):
    """M21, M22, O2."""
    return rounded(crossval.cv_long(crossval.cv_results([_grid_tree_inner(spark, sf_dir)])), 6, "value")


@query
def grid_importance(spark, sf_dir):
    """M23."""
    return rounded(rounded(crossval.cv_importance([_grid_tree(spark, sf_dir)], spark), 8, "importance"), 6, "mean_importance")


@query
def grid_vs_holdout(spark, sf_dir):
    """M24."""
    holdout = models.compare_models({"tree": _small_fits(spark, sf_dir)["tree"]}, _parts(spark, sf_dir)["test"])
    out = crossval.cv_vs_holdout(holdout, crossval.cv_results([_grid_tree_inner(spark, sf_dir)]))
    return rounded(rounded(out, 3, "holdout_rmse", "cv_rmse_mean", "cv_rmse_sd"), 7, "holdout_r_squared", "cv_r_squared_mean")


@query
def grid_ridge(spark, sf_dir):
    """M17-M19 with a learner that has a closed form."""
    train = _train(spark, sf_dir)
    run = crossval.cross_validate(train, "weekly_sales", models.ridge, ["store_size", "dept"], grid=RIDGE, key=KEY, select_on="inner")
    return _shown(run.evals, "reg_param").drop("model")


# Forests by content


@query
def forest_bags(spark, sf_dir):
    """M5: how many training rows get each weight in the first trees of a forest drawn by content."""
    train = _train(spark, sf_dir)
    trees = [train.select(F.lit(i).alias("tree"), bagging.bag_weight(KEY, i).alias("weight")) for i in range(3)]
    return reshape.stack_rows(*trees).groupBy("tree", "weight").agg(F.count(F.lit(1)).alias("n"))


@query
def forest_by_content(spark, sf_dir):
    """A forest that does not depend on the partitioning."""
    train = model_parts(spark, sf_dir, keep_key=True)["train"]
    features = [c for c in train.columns if c not in ("weekly_sales", "week_date")]
    return models.feature_importance(bagging.content_forest(train, "weekly_sales", features, KEY), spark)


# Results that outlive the session


@query
def saved_model_metrics(spark, sf_dir):
    """The linear model kept as files and read back."""
    path = scratch_path(spark, "linear-model")
    models.save_fit(_fits(spark, sf_dir, "linear")["linear"], path)
    out = models.compute_metrics(models.load_fit(spark, path), model_parts(spark, sf_dir)["test"])
    return rounded(rounded(out, 3, "rmse"), 7, "r_squared")


@query
def saved_grid(spark, sf_dir):
    """A cross-validation kept as files and read back; its scores, and those of its saved models on their folds."""
    path = scratch_path(spark, "tree-grid")
    crossval.save_run(_grid_tree_inner(spark, sf_dir), path)
    return _shown(crossval.load_run(spark, path).evals, "max_depth")


@query
def cv_native(spark, sf_dir):
    """M17 by Spark's own cross-validator."""
    train = model_parts(spark, sf_dir, keep_key=True)["train"]
    features = [c for c in train.columns if c not in ("weekly_sales", "week_date")]
    out = crossval.native_scores(train, "weekly_sales", "linear", features, key=KEY).select("fold", "rmse", "r_squared")
    return rounded(rounded(out, 3, "rmse"), 7, "r_squared")
