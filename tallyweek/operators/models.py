"""Regression on tables: four learners, their summaries, scores and importances."""

from __future__ import annotations

import json
import re
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass
from functools import reduce
from multiprocessing.pool import ThreadPool

from pyspark import StorageLevel, inheritable_thread_target
from pyspark.ml import Estimator, Model, PipelineModel, Transformer
from pyspark.ml.feature import RFormula, VectorAssembler
from pyspark.ml.regression import (
    DecisionTreeRegressor,
    GBTRegressor,
    LinearRegression,
    RandomForestRegressor,
)
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyweek.functions.columns import is_missing, other_columns
from tallyweek.functions.sizing import checkpointed, local_table
from tallyweek.operators.clean import keep_present
from tallyweek.operators.metrics import metric_columns, regression_metrics
from tallyweek.operators.reshape import stack_rows

FEATURES = "features"
# Fixed value: the seed of the models.
SEED = 1234

# Training rows are dealt by content to partitions of about this many rows, so that the draws of a forest
# do not depend on how the table came, and tasks are as many as a table of any size needs.
PARTITION_ROWS = 20_000
# From FEW_PARTITIONS on partitions grow up to LARGE_PARTITION_ROWS before there are more of them: every task of a fit sends
# its histograms on and its figures to the driver, however few rows it has.
FEW_PARTITIONS = 12
LARGE_PARTITION_ROWS = 250_000
# From this many rows on, trees are grown on cells: the rows that fall in the same bins of all features (see `grown`).
CELL_ROWS = 500_000
HANDLE_INVALID = ("error", "skip", "keep")

# The display name of each kind of model.
MODEL_NAMES = {
    "linear": "MLR",
    "forest": "Random Forest",
    "gbt": "Gradient Boosted Tree",
    "tree": "Decision Tree",
}


def linear() -> Estimator:
    return LinearRegression(featuresCol=FEATURES)


def ridge(reg_param: float = 0.0) -> Estimator:
    """Linear regression whose coefficients are held back, solved by normal equations."""
    return LinearRegression(featuresCol=FEATURES, regParam=reg_param, elasticNetParam=0.0, solver="normal")


def _deep(max_memory: int, cache_node_ids: bool, checkpoint_interval: int) -> dict[str, object]:
    return {"maxMemoryInMB": max_memory, "cacheNodeIds": cache_node_ids, "checkpointInterval": checkpoint_interval}


def forest(
    num_trees: int = 20, max_depth: int = 5, seed: int = SEED, bootstrap: bool = True, feature_subset: str = "auto",
    max_memory: int = 512, cache_node_ids: bool = False, checkpoint_interval: int = 10,
) -> Estimator:
    return RandomForestRegressor(
        featuresCol=FEATURES, numTrees=num_trees, maxDepth=max_depth, seed=seed, bootstrap=bootstrap,
        featureSubsetStrategy=feature_subset, **_deep(max_memory, cache_node_ids, checkpoint_interval),
    )


def gbt(
    max_iter: int = 20, max_depth: int = 5, seed: int = SEED,
    max_memory: int = 512, cache_node_ids: bool = False, checkpoint_interval: int = 3,
) -> Estimator:
    """Boosted trees. Each task carries the trees grown since the last checkpoint, so that is made often; results do not depend on it."""
    return GBTRegressor(
        featuresCol=FEATURES, maxIter=max_iter, maxDepth=max_depth, seed=seed, **_deep(max_memory, cache_node_ids, checkpoint_interval)
    )


def tree(
    max_depth: int = 5, seed: int = SEED, max_memory: int = 512, cache_node_ids: bool = False, checkpoint_interval: int = 10
) -> Estimator:
    return DecisionTreeRegressor(
        featuresCol=FEATURES, maxDepth=max_depth, seed=seed, **_deep(max_memory, cache_node_ids, checkpoint_interval)
    )


ESTIMATORS: dict[str, Callable[..., Estimator]] = {"linear": linear, "forest": forest, "gbt": gbt, "tree": tree}


@dataclass(frozen=True)
class Fit:
    """A fitted model, ready to score raw rows."""

    pipeline: PipelineModel
    label: str
    features: list[str]
    dropped: list[str]
    columns: list[str]

    @property
    def model(self) -> Model:
        return self.pipeline.stages[-1]


def constant_columns(df: DataFrame, names: Sequence[str]) -> list[str]:
    """Columns whose non-missing values are all the same."""
    row = df.agg(*[(F.min(c).eqNullSafe(F.max(c))).alias(c) for c in names]).first()
    return [c for c in names if row[c]]


def vectorizer(df: DataFrame, label: str, features: Sequence[str] | None = None) -> Transformer:
    """Turns rows into label and feature vector, as in the formula `label ~ .` (M3).

    Numbers enter as they are. Text enters as indicators, which takes a pass to
    find the levels. A missing feature is an error here; see `usable_rows`.
    """
    names = list(features) if features is not None else other_columns(df, label)
    if any(isinstance(df.schema[c].dataType, T.StringType) for c in names):
        formula = f"{label} ~ {' + '.join(names)}"
        return RFormula(formula=formula, featuresCol=FEATURES, labelCol=f"_{label}", handleInvalid="error").fit(df)
    return VectorAssembler(inputCols=names, outputCol=FEATURES, handleInvalid="error")


def usable_rows(df: DataFrame, names: Sequence[str], handle_invalid: str) -> DataFrame:
    """The rows to fit on: all of them, so that a missing feature is an error, or with `skip` the complete ones."""
    if handle_invalid not in HANDLE_INVALID:
        raise ValueError(f"handle_invalid must be one of {HANDLE_INVALID}")
    return df if handle_invalid == "error" else keep_present(df, *names)


def formula_columns(df: DataFrame, formula: str) -> tuple[str, list[str]]:
    """Label and features of `y ~ .`, `y ~ a + b` or `y ~ . - a` (M3)."""
    label, right = (side.strip() for side in formula.split("~"))
    features: list[str] = []
    for sign, term in re.findall(r"([+-]?)\s*([^\s+-]+)", right):
        names = other_columns(df, label) if term == "." else [term]
        if unknown := [c for c in names if c not in df.columns]:
            raise ValueError(f"no column {unknown[0]}")
        features = [c for c in features if c not in names] if sign == "-" else features + [c for c in names if c not in features]
    return label, features


def vector_names(df: DataFrame, column: str = FEATURES) -> list[str]:
    """Names of the vector's entries, from the column's metadata."""
    groups = df.schema[column].metadata["ml_attr"]["attrs"].values()
    entries = sorted((e for group in groups for e in group), key=lambda e: e["idx"])
    return [e["name"] for e in entries]


def fit(
    train: DataFrame,
    target: str,
    estimator: str | Estimator | Callable[..., Estimator] = "linear",
    features: Sequence[str] | None = None,
    handle_invalid: str = "error",
    partitions: int | None = None,
    **params: object,
) -> Fit:
    """Fit one model (M4-M7). `target` is the label column or a formula; `estimator` is
    a kind, a constructor (X2) or a built estimator.

    A missing feature is an error unless `handle_invalid="skip"` leaves such rows out. Rows are
    dealt by content to `partitions`, or to as many as PARTITION_ROWS asks for, so the fit does not
    depend on the input's partitioning.
    Constant features are kept out of a linear model, where they would cost it
    its standard errors, and are reported with coefficient 0.
    """
    if isinstance(estimator, str):
        estimator = ESTIMATORS[estimator]
    if not isinstance(estimator, Estimator):
        estimator = estimator(**params)
    label = target
    if "~" in target:
        label, features = formula_columns(train, target)
    names = list(features) if features is not None else other_columns(train, label)
    train = usable_rows(keep_present(train, label), names, handle_invalid).select(label, *names).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        return _fit_vectors(*_vectors_of(train, label, names, isinstance(estimator, LinearRegression), partitions), label, names, estimator)
    finally:
        train.unpersist()


def partitions_for(n_rows: int) -> int:
    return max(1, -(-n_rows // PARTITION_ROWS))


def fit_partitions(n_rows: int) -> int:
    """How many partitions the fits work on: those of `partitions_for` while they are few, of a large table fewer and larger ones."""
    return min(partitions_for(n_rows), max(FEW_PARTITIONS, -(-n_rows // LARGE_PARTITION_ROWS)))


def _vectors_of(train: DataFrame, label: str, names: Sequence[str], vary: bool, partitions: int | None) -> tuple[Transformer, DataFrame, list[str]]:
    """The vectorizer, the rows as vectors in an order of their own, and the constant features left out if all must vary."""
    dropped = constant_columns(train, names) if vary else []
    to_vector = vectorizer(train, label, [c for c in names if c not in dropped])
    partitions = partitions or fit_partitions(train.count())
    return to_vector, to_vector.transform(by_content(train, [label, *names], partitions)), dropped


def _fit_vectors(to_vector: Transformer, rows: DataFrame, dropped: list[str], label: str, names: Sequence[str], estimator: Estimator) -> Fit:
    model = estimator.copy({estimator.labelCol: label}).fit(rows.select(label, FEATURES))
    return Fit(PipelineModel([to_vector, model]), label, vector_names(rows), dropped, [c for c in names if c not in dropped])


def by_content(df: DataFrame, names: Sequence[str], partitions: int) -> DataFrame:
    """The same rows, dealt to partitions and ordered in them by a hash of the named columns.

    Equal rows land together; a row that is repeated without end is better given a key column.
    """
    at = F.xxhash64(*[F.col(c) for c in names])
    return df.repartition(partitions, at).sortWithinPartitions(at, *names)


def fit_all(
    train: DataFrame, label: str, kinds: Sequence[str] = tuple(ESTIMATORS), parallelism: int = 4,
    handle_invalid: str = "error", partitions: int | None = None, params: Mapping[str, Mapping[str, object]] | None = None,
) -> dict[str, Fit]:
    """One fit per kind, with default parameters or those in `params`, side by side on one kept table of vectors.

    `parallelism` is how many fits may hold a copy of the rows at a time. From CELL_ROWS rows on, trees, forests and boosted
    trees on numbers are grown on cells, if these are not too many.
    """
    from tallyweek.operators import grown  # it knows the learners of this module

    names = other_columns(train, label)
    train = usable_rows(keep_present(train, label), names, handle_invalid).select(label, *names).persist(StorageLevel.MEMORY_AND_DISK)
    n_rows = train.count()
    partitions = partitions or fit_partitions(n_rows)
    made = {kind: ESTIMATORS[kind](**(params or {}).get(kind, {})) for kind in kinds}
    numbers = all(isinstance(train.schema[c].dataType, T.NumericType) for c in names)

    def vectors(vary: bool) -> tuple[Transformer, DataFrame, list[str]]:
        to_vector, rows, dropped = _vectors_of(train, label, names, vary, partitions)
        return to_vector, checkpointed(rows.select(label, FEATURES)), dropped

    def one(kind: str) -> Fit:
        # Only a linear model leaves constant features out, and only then it needs vectors of its own.
        return _fit_vectors(*(narrow if isinstance(made[kind], LinearRegression) else plain), label, names, made[kind])

    try:
        fits = grown.fit_all(train, label, names, made, n_rows, parallelism) if numbers and n_rows >= CELL_ROWS else {}
        kinds, wanted = [kind for kind in kinds if kind not in fits], kinds
        if not kinds:
            return {kind: fits[kind] for kind in wanted}
        linear_asked = any(isinstance(m, LinearRegression) for m in made.values())
        plain = narrow = vectors(False)
        if linear_asked and constant_columns(train, names):
            narrow = vectors(True)
        with ThreadPool(max(1, min(parallelism, len(kinds)))) as pool:
            fits |= dict(zip(kinds, pool.map(inheritable_thread_target(train.sparkSession)(one), kinds, chunksize=1)))
        return {kind: fits[kind] for kind in wanted}
    finally:
        train.unpersist()


def score(fitted: Fit, df: DataFrame, handle_invalid: str = "error") -> DataFrame:
    """Rows with their prediction (M9).

    A missing feature is an error; with `skip` such rows are left out, with
    `keep` they stay and have no prediction.
    """
    rows = fitted.pipeline.transform(usable_rows(df, fitted.columns, handle_invalid)).drop(FEATURES, f"_{fitted.label}", *[f"_bin_{c}" for c in fitted.columns])
    if handle_invalid != "keep":
        return rows
    whole = reduce(lambda a, b: a & b, [~is_missing(df, c) for c in fitted.columns])
    return rows.unionByName(df.where(~whole).withColumn("prediction", F.lit(None).cast("double")))


def compute_metrics(fitted: Fit, test: DataFrame, handle_invalid: str = "error") -> DataFrame:
    """RMSE and R squared on other rows."""
    return regression_metrics(score(fitted, test, handle_invalid), fitted.label)


def compare_models(fits: Mapping[str, Fit], test: DataFrame, handle_invalid: str = "error") -> DataFrame:
    """The metrics of several models, one named row each.

    The models score the same rows one after the other, and one pass over the
    rows gives all metrics. They must share the label. With `skip` the rows are
    those that have the features of all models.
    """
    label = next(iter(fits.values())).label
    every = list(dict.fromkeys(c for f in fits.values() for c in f.columns))
    rows, names = usable_rows(test, every, handle_invalid), []
    for kind, f in fits.items():
        names.append(f"prediction_{kind}")
        rows = score(f, rows).withColumnRenamed("prediction", names[-1])
    entries = []
    for kind, name in zip(fits, names):
        rmse, r_squared = metric_columns(label, name)
        entries.append(F.struct(F.lit(MODEL_NAMES.get(kind, kind)).alias("model"), rmse.alias("rmse"), r_squared.alias("r_squared")))
    return rows.agg(F.array(*entries).alias("e")).select(F.inline("e"))


def linear_summary(fitted: Fit, spark: SparkSession) -> DataFrame:
    """Coefficients with standard errors, t and p values (M8)."""
    model, s = fitted.model, fitted.model.summary
    terms = [*fitted.features, "(intercept)"]
    values = [*map(float, model.coefficients), float(model.intercept)]
    try:
        errors, t, p = list(s.coefficientStandardErrors), list(s.tValues), list(s.pValues)
    except Exception as error:
        if "available for this LinearRegressionModel" not in str(error):
            raise  # that message says that the features are collinear
        errors = t = p = [None] * len(terms)
    rows = list(zip(terms, values, errors, t, p)) + [(c, 0.0, None, None, None) for c in fitted.dropped]
    return local_table(
        spark, rows, "term string, coefficient double, std_error double, t_value double, p_value double"
    )


def model_overview(fits: Mapping[str, Fit], spark: SparkSession) -> DataFrame:
    """Size of tree models, training fit of linear ones (M8)."""
    rows = []
    for kind, f in fits.items():
        m = f.model
        if hasattr(m, "trees"):
            rows.append((kind, len(m.trees), m.totalNumNodes, max(t.depth for t in m.trees), None, None))
        elif hasattr(m, "numNodes"):
            rows.append((kind, 1, m.numNodes, m.depth, None, None))
        else:
            rows.append((kind, None, None, None, m.summary.rootMeanSquaredError, m.summary.r2))
    return local_table(
        spark, rows, "model string, n_trees int, n_nodes int, depth int, train_rmse double, train_r_squared double"
    )


def feature_importance(fitted: Fit, spark: SparkSession) -> DataFrame:
    """Importance of each feature of a tree model."""
    rows = list(zip(fitted.features, map(float, fitted.model.featureImportances.toArray())))
    return local_table(spark, rows, "feature string, importance double").orderBy(F.desc("importance"), "feature")


def tree_nodes(fitted: Fit, spark: SparkSession) -> DataFrame:
    """The nodes of a decision tree (M8): the root is 1, the children of n are 2n and 2n + 1, and `feature <= threshold` goes to the first."""
    lines = [line.strip() for line in fitted.model.toDebugString.splitlines()]
    rules = [line for line in lines if line.startswith(("If", "Predict"))]  # in preorder
    rows = []

    def read(node: int) -> None:
        line = rules.pop(0)
        if line.startswith("Predict"):
            rows.append((node, None, None, float(line.split(":")[1])))
            return
        number, threshold = re.search(r"feature (\d+) <= (\S+?)\)", line).groups()
        rows.append((node, fitted.features[int(number)], float(threshold), None))
        read(2 * node)
        read(2 * node + 1)

    read(1)
    return local_table(spark, rows, "node bigint, feature string, threshold double, prediction double")


def save_fit(fitted: Fit, path: str) -> None:
    """Keep a fitted model for later sessions (S6): the pipeline beside what `Fit` knows of its columns."""
    spark = SparkSession.active()
    fitted.pipeline.write().overwrite().save(f"{path}/pipeline")
    about = {"label": fitted.label, "features": fitted.features, "dropped": fitted.dropped, "columns": fitted.columns}
    local_table(spark, [(json.dumps(about),)], "value string").coalesce(1).write.mode("overwrite").text(f"{path}/about")


def load_fit(spark: SparkSession, path: str) -> Fit:
    """A model that `save_fit` kept."""
    return Fit(PipelineModel.load(f"{path}/pipeline"), **json.loads(spark.read.text(f"{path}/about").first()["value"]))


def compare_importance(fits: Mapping[str, Fit], spark: SparkSession) -> DataFrame:
    """Importances of several tree models, features ordered by their mean."""
    parts = [
        feature_importance(f, spark).withColumn("model", F.lit(MODEL_NAMES.get(kind, kind)))
        for kind, f in fits.items()
        if hasattr(f.model, "featureImportances")
    ]
    return order_importance(stack_rows(*parts))


def order_importance(rows: DataFrame) -> DataFrame:
    """Add the mean importance of a feature and sort by it (O3)."""
    means = rows.groupBy("feature").agg(F.avg("importance").alias("mean_importance"))
    return rows.join(means, "feature").orderBy("mean_importance", "feature", "model")
