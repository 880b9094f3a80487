"""A random forest whose draws depend on the rows and on nothing else.

Spark draws a forest's bootstrap samples partition by partition, so another
partitioning gives another forest. Here a row's weight in a tree is a Poisson number
drawn from the hash of its key and the tree's number. Candidate splits are set beforehand
from the values of all rows, where Spark would look at a sample of a large table. What
is left to chance are the features a node may use, drawn on the driver from the seed.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Mapping, Sequence
from multiprocessing.pool import ThreadPool
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel, inheritable_thread_target
from pyspark.ml import PipelineModel, Transformer
from pyspark.ml.feature import Bucketizer, VectorAssembler
from pyspark.ml.linalg import DenseVector
from pyspark.ml.regression import RandomForestRegressor
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyweek.functions.columns import other_columns
from tallyweek.operators.clean import keep_present
from tallyweek.operators.models import FEATURES, SEED, Fit, fit_partitions, usable_rows
from tallyweek.operators.quantile import named_quantiles
from tallyweek.operators.split import HASHES, key_hash

# The largest weight a row can have in a tree: the chance of a higher one is under the hash's resolution.
MOST = 12
# Columns with about so many values at most are counted value by value.
COUNTED_VALUES = 200_000
# So many of the lowest hashes tell about how many values a column has.
LOWEST = 1024
# Values are put in order so many rows at a time.
CHUNK = 262_144


def bag_weight(key: Sequence[str], tree: int, seed: int = SEED) -> Column:
    """How often a row is drawn for a tree: Poisson with mean 1, from the hash of its key."""
    at = key_hash(key, seed + tree)
    out, reached = F.when(at < F.lit(0), 0), 0.0
    for weight in range(MOST):
        reached += math.exp(-1) / math.factorial(weight)
        out = out.when(at < F.lit(reached * HASHES), weight)
    return out.otherwise(MOST)


def split_points(df: DataFrame, names: Sequence[str], max_bins: int = 32) -> dict[str, list[float]]:
    """Where each column may be split: between all values if there are at most `max_bins`, else at quantiles of all rows."""
    # Where the driver has this package, executors have it too.
    df.sparkSession.sparkContext.environment.setdefault("PYTHONPATH", str(Path(__file__).resolve().parents[2]))
    values = {c: F.col(c).cast("double") for c in names}
    about = _about_distinct(df.select(*[v.alias(f"v{i}") for i, v in enumerate(values.values())]))
    counted = [c for c, n in zip(names, about) if n <= max(COUNTED_VALUES, max_bins)]
    probs = {f"_q{i}": i / max_bins for i in range(1, max_bins)}
    out = {}
    for c in names:
        if c not in counted:
            row = named_quantiles(df.select(values[c].alias(c)), c, probs).first()
            out[c] = sorted({row[q] for q in probs})
    if counted:
        # One pass counts the values of all these columns.
        pairs = df.select(*[values[c].alias(f"v{i}") for i, c in enumerate(counted)]).mapInArrow(_counts, "at int, v double, n bigint")
        met = pairs.groupBy("at", "v").agg(F.sum("n").alias("n")).toPandas().sort_values("v")
        for i, c in enumerate(counted):
            own = met[met["at"] == i]
            found = own["v"].to_numpy()
            if len(found) <= max_bins:
                out[c] = ((found[:-1] + found[1:]) / 2).tolist()
            else:
                out[c] = sorted(set(_quantiles(found, own["n"].to_numpy(), list(probs.values()))))
    return out


def _found(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Per column the values present in some of the batches, with their counts."""
    held, n = [], 0

    def met() -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        table = pa.Table.from_batches(held)
        for i in range(table.num_columns):
            x = table.column(i).to_numpy()
            yield i, *np.unique(x[~np.isnan(x)] + 0.0, return_counts=True)  # missing values come as NaN, and -0.0 becomes 0.0

    for b in batches:
        held.append(b)
        n += b.num_rows
        if n >= CHUNK:
            yield from met()
            held, n = [], 0
    if n:
        yield from met()


def _counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for i, values, counts in _found(batches):
        yield pa.RecordBatch.from_pydict({"at": np.full(len(values), i, np.int32), "v": values, "n": counts.astype(np.int64)})


def _lowest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    kept: dict[int, np.ndarray] = {}
    for i, values, _ in _found(batches):
        kept[i] = np.union1d(kept.get(i, np.empty(0, np.uint64)), _spread(values))[:LOWEST]
    yield _packed(kept)


def _lowest_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    kept: dict[int, np.ndarray] = {}
    for b in batches:
        for i, low in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
            kept[i] = np.union1d(kept.get(i, np.empty(0, np.uint64)), np.frombuffer(low, np.uint64))[:LOWEST]
    yield _packed(kept)


def _packed(kept: Mapping[int, np.ndarray]) -> pa.RecordBatch:
    return pa.RecordBatch.from_pydict({"at": pa.array(list(kept), pa.int32()), "low": pa.array([v.tobytes() for v in kept.values()], pa.binary())})


def _spread(values: np.ndarray) -> np.ndarray:
    """Numbers to 64 bits that look independent of them."""
    x = values.view(np.uint64)
    for factor in (0xBF58476D1CE4E5B9, 0x94D049BB133111EB):
        x = (x ^ (x >> np.uint64(31))) * np.uint64(factor)
    return x ^ (x >> np.uint64(30))


def _about_distinct(df: DataFrame) -> list[float]:
    """About how many values each column has, by the lowest of their hashes; exact up to LOWEST."""
    kept = [np.empty(0, np.uint64) for _ in df.columns]
    parts = df.mapInArrow(_lowest, "at int, low binary")
    for r in parts.repartition(len(kept), "at").mapInArrow(_lowest_of, "at int, low binary").collect():
        kept[r["at"]] = np.frombuffer(r["low"], np.uint64)
    return [len(x) if len(x) < LOWEST else (LOWEST - 1) / (float(x[-1]) / 2.0**64) for x in kept]


def _quantiles(values: np.ndarray, counts: np.ndarray, probs: Sequence[float]) -> list[float]:
    """Interpolated quantiles, as `named_quantiles` has them, of ordered values that occur so often."""
    ends = counts.cumsum()
    at = np.array(probs) * (ends[-1] - 1)
    low, high = (values[np.searchsorted(ends, f(at), side="right")] for f in (np.floor, np.ceil))
    return np.where(low == high, low, low + (high - low) * (at - np.floor(at))).tolist()


def binner(names: Sequence[str], cuts: Mapping[str, Sequence[float]]) -> Transformer:
    """Rows to vectors of bin numbers."""
    bins = Bucketizer(
        inputCols=list(names), outputCols=[f"_bin_{c}" for c in names],
        splitsArray=[[-math.inf, *(cuts[c] or [0.0]), math.inf] for c in names],
    )
    return PipelineModel([bins, VectorAssembler(inputCols=[f"_bin_{c}" for c in names], outputCol=FEATURES)])


class ForestOfTrees(Transformer):
    """Trees fitted one by one on labels in `unit`-ths; the prediction is their mean."""

    def __init__(self, trees: Sequence, drop: Sequence[str] = (), unit: float = 1.0):
        super().__init__()
        self.members, self._drop, self._unit = list(trees), list(drop), unit

    @property
    def trees(self) -> list:
        return [t for m in self.members for t in m.trees]

    @property
    def totalNumNodes(self) -> int:
        return sum(m.totalNumNodes for m in self.members)

    @property
    def featureImportances(self) -> DenseVector:
        """The mean of the trees' importances, adding up to 1; trees without a split have none."""
        total = sum(m.featureImportances.toArray() for m in self.members)
        return DenseVector(total / total.sum() if total.sum() else total)

    def _transform(self, dataset: DataFrame) -> DataFrame:
        parts = [f"_tree_{i}" for i in range(len(self.members))]
        for m, name in zip(self.members, parts):
            dataset = m.setPredictionCol(name).transform(dataset)
        mean = sum((F.col(c) for c in parts), F.lit(0.0)) / (len(parts) * self._unit)
        return dataset.withColumn("prediction", mean).drop(*parts, *self._drop)


def content_forest(
    train: DataFrame, label: str, features: Sequence[str] | None = None, key: Sequence[str] | None = None, num_trees: int = 20,
    max_depth: int = 5, seed: int = SEED, max_bins: int = 32, feature_subset: str = "onethird", parallelism: int = 8,
    partitions: int | None = None, handle_invalid: str = "error",
) -> Fit:
    """Fit a forest (M5) that is the same however the rows are partitioned.

    `key` names a row in the draws; where it is not given, all columns do, and rows alike in all are drawn
    alike. A task works on as many rows as `fit_partitions` gives it, or the table goes to `partitions`; either
    way the forest stays the same. Trees are fitted side by side on one cached table of bin numbers.
    """
    names = list(features) if features is not None else other_columns(train, label, *(key or []))
    key = list(key or [label, *names])
    rows = usable_rows(keep_present(train, label), names, handle_invalid).select(*dict.fromkeys([label, *names, *key]))
    rows = rows.persist(StorageLevel.MEMORY_AND_DISK)
    to_vector = binner(names, split_points(rows, names, max_bins))
    partitions = partitions or fit_partitions(rows.count())
    # Money in whole cents: sums of labels are then the same in any order.
    cents = F.round(F.col(label).cast("double") * 100)
    table = to_vector.transform(rows.repartition(partitions)).select(cents.alias("_y"), FEATURES, *[F.col(c).alias(f"_key_{c}") for c in key])
    table = table.persist(StorageLevel.MEMORY_AND_DISK)

    def grow(number: int):
        weight = bag_weight([f"_key_{c}" for c in key], number, seed)
        drawn = table.select("_y", FEATURES, weight.cast("double").alias("_w")).where("_w > 0")
        learner = RandomForestRegressor(
            featuresCol=FEATURES, labelCol="_y", weightCol="_w", numTrees=1, maxDepth=max_depth, bootstrap=False,
            maxBins=max(max_bins, 2), featureSubsetStrategy=feature_subset, seed=seed + number,
        )
        return learner.fit(drawn)

    try:
        with ThreadPool(max(1, min(parallelism, num_trees))) as pool:
            trees = pool.map(inheritable_thread_target(train.sparkSession)(grow), range(num_trees), chunksize=1)
    finally:
        table.unpersist()
        rows.unpersist()
    return Fit(PipelineModel([to_vector, ForestOfTrees(trees, [f"_bin_{c}" for c in names], 100.0)]), label, names, [], names)
