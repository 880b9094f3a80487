"""k-fold cross-validation of regression models with a grid per fold."""

from __future__ import annotations

import json
import math
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass
from multiprocessing.pool import ThreadPool

from pyspark import StorageLevel, inheritable_thread_target
from pyspark.ml import Estimator, PipelineModel
from pyspark.ml.evaluation import RegressionEvaluator
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import DecisionTreeRegressor, GBTRegressor, LinearRegression
from pyspark.ml.tuning import CrossValidator
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyweek.functions.columns import fixed_text, joined_label, other_columns
from tallyweek.functions.sizing import checkpointed, local_table, saved
from tallyweek.operators import bagging, grown, models
from tallyweek.operators.clean import keep_present
from tallyweek.operators.metrics import regression_metrics
from tallyweek.operators.models import FEATURES, MODEL_NAMES, Fit
from tallyweek.operators.reshape import stack_rows, to_long
from tallyweek.operators.split import hash_bucket, with_fold

# The grids tried for each kind of model.
GRIDS: dict[str, list[dict[str, int]]] = {
    "forest": [{"num_trees": 20, "max_depth": 5}, {"num_trees": 50, "max_depth": 10}],
    "gbt": [{"max_iter": 20, "max_depth": 5}, {"max_iter": 50, "max_depth": 10}],
    "tree": [{"max_depth": 5}, {"max_depth": 10}],
}

# From this many rows on, trees are fitted on cells.
CELL_ROWS = models.CELL_ROWS
WEIGHT = "_weight"

EVAL_FIELDS = (
    "model string, fold int, rmse double, r_squared double, "
    "num_trees int, max_iter int, max_depth int, reg_param double, select_rmse double"
)


@dataclass(frozen=True)
class CrossValidation:
    """The outcome: a fit and its parameters per fold, held-out predictions, scores."""

    model: str
    fits: list[Fit]
    params: list[dict]
    predictions: DataFrame
    evals: DataFrame


def choose(scores: Sequence[float]) -> int:
    """Position of the lowest score; the first one wins a tie, and a missing or NaN score never does."""
    known = [i for i, s in enumerate(scores) if s is not None and not math.isnan(s)]
    if not known:
        raise ValueError("no grid point has a score")
    return min(known, key=lambda i: scores[i])


def _cell_bins(built: Sequence[Estimator]) -> int | None:
    """The bins of learners for which a cell's mean and weight say all its rows say; None if there is one for which they do not.

    That holds for squared error without draws: within a cell no split parts the rows, and each of them is predicted alike.
    """
    for m in built:
        if not isinstance(m, (DecisionTreeRegressor, GBTRegressor)) or m.getMinInstancesPerNode() > 1:
            return None
        if isinstance(m, GBTRegressor) and (m.getSubsamplingRate() < 1 or m.getFeatureSubsetStrategy() != "all" or m.getLossType() != "squared"):
            return None
    return built[0].getMaxBins() if len({m.getMaxBins() for m in built}) == 1 else None


def cells(rows: DataFrame, label: str, names: Sequence[str]) -> DataFrame:
    """Binned rows as one row per cell: the mean label, the weight and the vector of bins."""
    bins = [f"_bin_{c}" for c in names]
    # Bins come marked as categories; as numbers they keep their order, and a split lies between two of them.
    met = rows.groupBy(*[F.col(c).cast("int").alias(c) for c in bins]).agg(F.avg(label).alias(label), F.count(F.lit(1)).cast("double").alias(WEIGHT)).persist(StorageLevel.MEMORY_AND_DISK)
    dealt = models.by_content(met, bins, models.fit_partitions(met.count()))
    out = checkpointed(VectorAssembler(inputCols=bins, outputCol=FEATURES).transform(dealt).select(label, WEIGHT, FEATURES))
    met.unpersist()
    return out


def cross_validate(
    data: DataFrame,
    label: str,
    estimator: str | Callable[..., Estimator],
    features: Sequence[str] | None = None,
    k: int = 5,
    grid: Sequence[Mapping[str, object]] | None = None,
    key: Sequence[str] | None = None,
    fold_column: str | None = None,
    select_on: str = "train",
    parallelism: int = 8,
    name: str | None = None,
    handle_invalid: str = "error",
    partitions: int | None = None,
) -> CrossValidation:
    """Cross-validate one kind of model (M16-M18), see `cross_validate_all`."""
    name = name or (estimator if isinstance(estimator, str) else estimator.__name__)
    runs = cross_validate_all(
        data, label, {name: estimator}, features, k, {name: grid or []}, key, fold_column, select_on, parallelism, handle_invalid, partitions
    )
    return runs[name]


def cross_validate_all(
    data: DataFrame,
    label: str,
    estimators: Mapping[str, str | Callable[..., Estimator]],
    features: Sequence[str] | None = None,
    k: int = 5,
    grids: Mapping[str, Sequence[Mapping[str, object]]] | None = None,
    key: Sequence[str] | None = None,
    fold_column: str | None = None,
    select_on: str = "train",
    parallelism: int = 8,
    handle_invalid: str = "error",
    partitions: int | None = None,
) -> dict[str, CrossValidation]:
    """Cross-validate several kinds of models on the same folds (M16-M20); `estimators` and `grids` go by name.

    Folds 1..k come from `fold_column` or the hash of `key` (all columns if not
    given). For each fold every grid point is fitted on the other folds, the
    point with the lowest RMSE is kept, and the rows of the fold are scored with
    it. `select_on="train"` takes that RMSE on the rows fitted on; `"inner"`
    fits on four fifths of them, takes it on the rest, and fits the chosen point
    again on all. The fold's own rows never take part in the choice.

    The rows are read once, turned into vectors once and kept in the shared folder. All models, folds and grid points
    wait in one queue, the longest fits first, of which `parallelism` run side by
    side; a learner never waits for another one to end. `handle_invalid` and `partitions` as in
    `models.fit`. Held-out predictions are saved once.

    From CELL_ROWS rows on, trees, forests and boosted trees on numbers are grown on cells (`grown`), as long as the cells fit in a
    task's memory. With more of them single and boosted trees are still fitted on `cells` and forests on rows, by Spark.
    Where a feature may be split is set by its values in all rows, where there are cells, and not by a sample of them.
    """
    if select_on not in ("train", "inner"):
        raise ValueError("select_on must be 'train' or 'inner'")
    spark = data.sparkSession
    makers = {n: models.ESTIMATORS[e] if isinstance(e, str) else e for n, e in estimators.items()}
    names = list(features) if features is not None else other_columns(data, label, fold_column or "")
    rows = data if fold_column else with_fold(data, k, key)
    fold = fold_column or "fold"
    rows = models.usable_rows(keep_present(rows, label), names, handle_invalid)
    if select_on == "inner":
        rows = rows.withColumn("_inner", hash_bucket(key or names, 5, seed=1))
    points = {n: [dict(p) for p in (grids or {}).get(n) or [{}]] for n in makers}
    rows = rows.persist(StorageLevel.MEMORY_AND_DISK)

    try:
        found = {r[fold]: r["count"] for r in rows.groupBy(fold).count().collect()}
        if unknown := [i for i in found if i not in range(1, k + 1)]:
            raise ValueError(f"folds must be 1 to {k}, not {unknown[0]}")
        if empty := [i for i in range(1, k + 1) if i not in found]:
            raise ValueError(f"fold {empty[0]} has no rows")
        numbers = all(isinstance(rows.schema[c].dataType, T.NumericType) for c in names)
        large = numbers and sum(found.values()) >= CELL_ROWS
        runs: dict[str, CrossValidation] = {}
        for most, which in (_growing(makers, points) if large else {}).items():
            runs |= _on_cells(rows, label, names, {n: makers[n] for n in which}, points, k, fold, key, select_on == "inner", most, sum(found.values()), parallelism) or {}
        asked_for, makers = list(makers), {n: make for n, make in makers.items() if n not in runs}
        if not makers:
            return {n: runs[n] for n in asked_for}
        partitions = partitions or models.fit_partitions(sum(found.values()))
        vary = {n for n, make in makers.items() if isinstance(make(), LinearRegression)}
        constant = models.constant_columns(rows, names) if vary else []
        dropped = {n: constant if n in vary else [] for n in makers}
        bins = {n: _cell_bins([make(**p) for p in points[n]]) if large else None for n, make in makers.items()}
        tables: dict[tuple[str, ...] | int, tuple] = {}
        for most in {b for b in bins.values() if b}:
            to_bins = bagging.binner(names, bagging.split_points(rows, names, most))
            tables[most] = (to_bins, checkpointed(to_bins.transform(models.by_content(rows, [label, *names], partitions))), names)
        for out in [dropped[n] for n in makers if not bins[n]]:
            if tuple(out) not in tables:
                to_vector = models.vectorizer(rows, label, [c for c in names if c not in out])
                vectors = to_vector.transform(models.by_content(rows, [label, *names], partitions))
                tables[tuple(out)] = (to_vector, checkpointed(vectors), models.vector_names(vectors))
        of = {n: tables[bins[n] or tuple(dropped[n])] for n in makers}
        rows.unpersist()  # the vectors hold all columns

        inner = F.col("_inner") == 0

        def training(n: str, number: int, whole: bool) -> DataFrame:
            """The rows outside the fold, all of them or those the candidates of an inner choice are fitted on."""
            train = of[n][1].where(F.col(fold) != number)
            return train if whole else train.where(~inner)

        def fit_point(n: str, number: int, point: Mapping[str, object], whole: bool = True):
            built = makers[n](**point)
            if bins[n]:
                return built.copy({built.labelCol: label, built.weightCol: WEIGHT}).fit(merged[bins[n], number, whole])
            return built.copy({built.labelCol: label}).fit(training(n, number, whole).select(label, FEATURES))

        def rmse(model, part: DataFrame) -> float:
            return regression_metrics(model.transform(part.select(label, FEATURES)), label).first()["rmse"]

        def attempt(job: tuple[str, int, dict]):
            """A model, or None where it has to be fitted again, and the RMSE to choose by."""
            n, number, point = job
            train = training(n, number, True)
            if len(points[n]) == 1:
                return fit_point(n, number, point), None
            if select_on == "train":
                model = fit_point(n, number, point)
                return model, rmse(model, train)
            return None, rmse(fit_point(n, number, point, whole=False), train.where(inner))

        def finish(job: tuple[str, int, dict, object]):
            n, number, point, model = job
            if model is None:
                model = fit_point(n, number, point)
            held_out = model.transform(of[n][1].where(F.col(fold) == number))
            return model, held_out, regression_metrics(held_out, label).first()

        threaded = inheritable_thread_target(spark)

        def run(fn, jobs: list[tuple]) -> list:
            """The results in the order of the jobs, which start with the longest."""
            order = sorted(range(len(jobs)), key=lambda i: -_effort(jobs[i][2]))
            done = dict(zip(order, pool.map(threaded(fn), [jobs[i] for i in order], chunksize=1)))
            return [done[i] for i in range(len(jobs))]

        with ThreadPool(max(1, parallelism)) as pool:
            asked = {
                (bins[n], i, whole): n
                for n in makers if bins[n]
                for i in range(1, k + 1) for whole in ([True, False] if select_on == "inner" and len(points[n]) > 1 else [True])
            }
            made = pool.map(threaded(lambda at: cells(training(asked[at], *at[1:]), label, names)), list(asked), chunksize=1)
            merged = dict(zip(asked, made))
            jobs = [(n, i, point) for n in makers for i in range(1, k + 1) for point in points[n]]
            tried = dict(zip(((n, i, str(p)) for n, i, p in jobs), run(attempt, jobs)))
            chosen = []
            for n in makers:
                for i in range(1, k + 1):
                    own = [tried[n, i, str(p)] for p in points[n]]
                    best = choose([e for _, e in own]) if len(own) > 1 else 0
                    chosen.append((n, i, points[n][best], *own[best]))
            finished = run(finish, [c[:4] for c in chosen])
        for n in makers:
            own = [(c, f) for c, f in zip(chosen, finished) if c[0] == n]
            held_out = [part.drop(FEATURES, f"_{label}", "_inner", *[f"_bin_{c}" for c in names]) for _, (_, part, _) in own]
            evals = [_eval_row(n, i, scores["rmse"], scores["r_squared"], point, select_rmse) for (_, i, point, _, select_rmse), (_, _, scores) in own]
            used = [c for c in names if c not in dropped[n]]
            runs[n] = CrossValidation(
                model=n,
                fits=[Fit(PipelineModel([of[n][0], m]), label, of[n][2], dropped[n], used) for _, (m, _, _) in own],
                params=[c[2] for c, _ in own],
                predictions=saved(stack_rows(*held_out), "predictions"),
                evals=local_table(spark, evals, EVAL_FIELDS),
            )
        return {n: runs[n] for n in asked_for}
    finally:
        rows.unpersist()


def _eval_row(name: str, fold: int, rmse: float, r_squared: float | None, point: Mapping[str, object], select_rmse: float | None) -> tuple:
    return (name, fold, rmse, r_squared, point.get("num_trees"), point.get("max_iter"), point.get("max_depth"), point.get("reg_param"), select_rmse)


def _growing(makers: Mapping[str, Callable[..., Estimator]], points: Mapping[str, Sequence[Mapping]]) -> dict[int, list[str]]:
    """The learners that can be grown on cells at all their grid points, by how many bins they want."""
    out: dict[int, list[str]] = {}
    for n, make in makers.items():
        built = [make(**p) for p in points[n]]
        if all(grown.learner(b) for b in built) and len({b.getMaxBins() for b in built}) == 1:
            out.setdefault(built[0].getMaxBins(), []).append(n)
    return out


def _on_cells(
    rows: DataFrame, label: str, names: Sequence[str], makers: Mapping[str, Callable[..., Estimator]], points: Mapping[str, Sequence[Mapping]],
    k: int, fold: str, key: Sequence[str] | None, inner: bool, most: int, n_rows: int, parallelism: int,
) -> dict[str, CrossValidation] | None:
    """The cross-validations of trees that are grown on cells, or None where there are too many cells."""
    cuts = bagging.split_points(rows, names, most)
    if not grown.countable(cuts):
        return None
    table, n_bins = grown.cell_rows(rows, names, cuts, label, key, n_rows)
    table = saved(table, "rows_by_cell")
    built = {(n, j): make(**p) for n, make in makers.items() for j, p in enumerate(points[n])}
    learners = {at: grown.learner(b) for at, b in built.items()}
    bags = grown.bags(learners)
    packed = grown.groups(table, label, fold, "_inner" if inner else None, bags)
    if packed is None:
        return None
    tasks = [(n, j, i, not inner or len(points[n]) == 1) for n, j in built for i in range(1, k + 1)]
    fits, trees = grown.fit(packed, tasks, learners, n_bins, bags)
    own_trees = {t: trees.where(F.col("task") == i) for i, t in enumerate(tasks)}
    scored = grown.scores(packed, fits, learners, n_bins)
    chosen = []
    for n in makers:
        for i in range(1, k + 1):
            own = [t for t in tasks if t[0] == n and t[2] == i]
            best = own[choose([scored[t][0] for t in own]) if len(own) > 1 else 0]
            chosen.append(((*best[:3], True), scored[best][0] if len(own) > 1 else None))
    if again := [t for t, _ in chosen if t not in fits]:
        more, trees = grown.fit(packed, again, learners, n_bins, bags)
        fits |= more
        own_trees |= {t: trees.where(F.col("task") == i) for i, t in enumerate(again)}
        scored |= grown.scores(packed, {t: fits[t] for t in again}, learners, n_bins)
    best_fits = {t: fits[t] for t, _ in chosen}
    held_out = grown.predictions(table, fold, best_fits, learners, n_bins)
    shaped = grown.shaped(rows.sparkSession, {t: built[t[:2]] for t in best_fits}, own_trees, label, len(names), parallelism)
    to_bins = bagging.binner(names, cuts)
    out = {}
    for place, n in enumerate(makers):
        own = [(t, e) for t, e in chosen if t[0] == n]
        evals = [_eval_row(n, t[2], *scored[t][1:], points[n][t[1]], e) for t, e in own]
        kept = [c for c in rows.columns if c != "_inner"]
        out[n] = CrossValidation(
            model=n,
            fits=[Fit(PipelineModel([to_bins, shaped[t]]), label, list(names), [], list(names)) for t, _ in own],
            params=[points[n][t[1]] for t, _ in own],
            predictions=held_out.select(*kept, F.col(f"_prediction_{place}").alias("prediction")),
            evals=local_table(rows.sparkSession, evals, EVAL_FIELDS),
        )
    return out


def _effort(point: Mapping[str, object]) -> float:
    """How long a fit takes next to others: trees grown one after the other count in full."""
    return (point.get("max_iter", 0) + 0.1 * point.get("num_trees", 1)) * point.get("max_depth", 1)


def native_scores(
    data: DataFrame, label: str, estimator: str | Callable[..., Estimator], features: Sequence[str] | None = None, k: int = 5,
    grid: Sequence[Mapping[str, object]] | None = None, key: Sequence[str] | None = None, parallelism: int = 8, partitions: int | None = None,
) -> DataFrame:
    """RMSE and R squared of every grid point on every fold (M17) by Spark's own CrossValidator: fold, point, rmse, r_squared.

    It takes the folds from a column and keeps the models of all folds. It compares points by their mean
    over the folds, so there is no choice inside a fold; for that see `cross_validate`. `grid` holds parameters
    by Spark's names.
    """
    names = list(features) if features is not None else other_columns(data, label)
    rows = with_fold(keep_present(data, label), k, key).persist(StorageLevel.MEMORY_AND_DISK)
    built = (models.ESTIMATORS[estimator] if isinstance(estimator, str) else estimator)()
    built = built.copy({built.labelCol: label})
    try:
        dropped = models.constant_columns(rows, names) if isinstance(built, LinearRegression) else []
        to_vector = models.vectorizer(rows, label, [c for c in names if c not in dropped])
        vectors = to_vector.transform(models.by_content(rows, [label, *names], partitions or models.fit_partitions(rows.count())))
        vectors = vectors.select(label, FEATURES, (F.col("fold") - 1).alias("fold")).persist(StorageLevel.MEMORY_AND_DISK)
        points = [{built.getParam(n): v for n, v in p.items()} for p in grid or [{}]]
        judge = RegressionEvaluator(labelCol=label, metricName="rmse")
        search = CrossValidator(
            estimator=built, estimatorParamMaps=points, evaluator=judge, numFolds=k, foldCol="fold", parallelism=parallelism, collectSubModels=True
        )
        found = search.fit(vectors)
        scored = [
            (i + 1, j, *regression_metrics(model.transform(vectors.where(F.col("fold") == i)), label).first())
            for i, of_fold in enumerate(found.subModels)
            for j, model in enumerate(of_fold)
        ]
        vectors.unpersist()
    finally:
        rows.unpersist()
    return local_table(data.sparkSession, scored, "fold int, point int, rmse double, r_squared double")


def save_run(run: CrossValidation, path: str) -> None:
    """Keep a cross-validation for later sessions (S6): the model of every fold, predictions and scores."""
    spark = run.evals.sparkSession
    for i, fitted in enumerate(run.fits, start=1):
        models.save_fit(fitted, f"{path}/fold{i}")
    run.predictions.write.mode("overwrite").parquet(f"{path}/predictions")
    run.evals.coalesce(1).write.mode("overwrite").parquet(f"{path}/evals")
    about = json.dumps({"model": run.model, "params": run.params})
    local_table(spark, [(about,)], "value string").coalesce(1).write.mode("overwrite").text(f"{path}/about")


def load_run(spark: SparkSession, path: str) -> CrossValidation:
    """A cross-validation that `save_run` kept."""
    about = json.loads(spark.read.text(f"{path}/about").first()["value"])
    fits = [models.load_fit(spark, f"{path}/fold{i}") for i in range(1, len(about["params"]) + 1)]
    return CrossValidation(about["model"], fits, about["params"], spark.read.parquet(f"{path}/predictions"), spark.read.parquet(f"{path}/evals"))


def cv_results(runs: Sequence[CrossValidation]) -> DataFrame:
    """The scores of all models and folds."""
    return stack_rows(*[r.evals for r in runs]).replace(MODEL_NAMES, subset="model").orderBy("model", "fold")


def cv_long(results: DataFrame) -> DataFrame:
    """Scores in long form with the chart's axis and value labels."""
    long = to_long(results, ["model", "fold"], ["rmse", "r_squared"])
    return long.withColumns(
        {"axis": joined_label(F.col("model"), F.col("fold")), "value_label": fixed_text(F.round("value", 2), 2)}
    ).orderBy("model", "fold", "value")


def cv_importance(runs: Sequence[CrossValidation], spark: SparkSession) -> DataFrame:
    """Importances per model, fold and feature, ordered by the feature's mean."""
    parts = [
        models.feature_importance(f, spark).withColumns(
            {"model": F.lit(MODEL_NAMES.get(run.model, run.model)), "fold": F.lit(i)}
        )
        for run in runs
        for i, f in enumerate(run.fits, start=1)
        if hasattr(f.model, "featureImportances")
    ]
    return models.order_importance(stack_rows(*parts))


def cv_vs_holdout(holdout: DataFrame, results: DataFrame) -> DataFrame:
    """Hold-out scores next to mean and sd over the folds, per model."""
    folds = results.groupBy("model").agg(
        F.avg("rmse").alias("cv_rmse_mean"),
        F.stddev_samp("rmse").alias("cv_rmse_sd"),
        F.avg("r_squared").alias("cv_r_squared_mean"),
    )
    return holdout.select("model", F.col("rmse").alias("holdout_rmse"), F.col("r_squared").alias("holdout_r_squared")).join(
        folds, "model"
    ).orderBy("model")
