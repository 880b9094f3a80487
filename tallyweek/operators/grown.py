"""Trees of large tables grown on cells, each forest block and each boosted ensemble in one task.

A cell holds the rows that fall in the same bins of all features. To a tree a cell is its weight and its sum of labels, so a
large table shrinks to as many numbers as its features have combinations of bins, and a level of a tree is a few counts
over arrays instead of a job over all rows. The rows are read twice: once to sum them up, and once to give them their predictions.

A forest's draws come from the row: its weight in a tree is a Poisson number from the hash of its key and the tree's
number, and the features a node may use come from the hash of tree and node. Forests so depend on neither partitions nor tasks.
"""

from __future__ import annotations

import json
import math
import pickle
from collections.abc import Iterable, Iterator, Mapping, Sequence
from dataclasses import dataclass
from multiprocessing.pool import ThreadPool

import numpy as np
import pyarrow as pa
from pyspark import TaskContext, inheritable_thread_target
from pyspark.ml import Estimator, Model, PipelineModel
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import (
    DecisionTreeRegressionModel, DecisionTreeRegressor, GBTRegressionModel, GBTRegressor, RandomForestRegressionModel, RandomForestRegressor,
)
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyweek.functions.sizing import local_table, saved, scratch_path
from tallyweek.operators import bagging
from tallyweek.operators.models import FEATURES, Fit, fit_partitions

CELL, DRAW = "_cell", "_draw"
# So many groups of a cell's rows by fold fit in the memory of a task (about 100 bytes each); with more, Spark's own learners do the work.
MOST_GROUPS = 3_000_000
# Rows are summed up, and groups scored, so many at a time.
CHUNK = 65_536
# The draws of so many trees go to a task.
BLOCK = 4
# A split must lessen the variance by more than this share of it, which is rounding.
LEAST_GAIN = 1e-13
# Falls of the squared error that differ by a smaller share are equal: sums in another order do not change which split comes first.
SAME = 1e-10
# What a prediction needs to know of the nodes.
SHAPE = ("feature", "bin", "left", "prediction")

Task = tuple[str, int, int, bool]  # learner, grid point, fold left out, and whether the rows kept for an inner choice are fitted on


@dataclass(frozen=True)
class Learner:
    """What the growing of a built estimator depends on."""

    kind: str
    trees: int
    depth: int
    seed: int
    bootstrap: bool
    subset: str
    step: float


def learner(built: Estimator) -> Learner | None:
    """The learner if it can be grown here, else None: squared error, no own weights, no limits on nodes but the depth."""
    if not isinstance(built, (DecisionTreeRegressor, GBTRegressor, RandomForestRegressor)):
        return None
    if built.getMinInstancesPerNode() > 1 or built.getMinInfoGain() or built.getMinWeightFractionPerNode() or built.isSet("weightCol"):
        return None
    if built.getImpurity() != "variance" or built.getLeafCol():
        return None
    if isinstance(built, DecisionTreeRegressor):
        return Learner("tree", 1, built.getMaxDepth(), built.getSeed(), False, "all", 1.0)
    if built.getSubsamplingRate() < 1:
        return None
    if isinstance(built, GBTRegressor):
        whole = built.getFeatureSubsetStrategy() == "all" and built.getLossType() == "squared" and not built.isSet("validationIndicatorCol")
        return Learner("gbt", built.getMaxIter(), built.getMaxDepth(), built.getSeed(), False, "all", built.getStepSize()) if whole else None
    subset = built.getFeatureSubsetStrategy()
    if subset == "auto":
        subset = "onethird" if built.getNumTrees() > 1 else "all"
    if subset not in ("all", "onethird", "sqrt", "log2"):
        return None
    return Learner("forest", built.getNumTrees(), built.getMaxDepth(), built.getSeed(), built.getBootstrap(), subset, 1.0)


def subset_size(subset: str, n: int) -> int:
    """How many of n features a node may use, by Spark's rules."""
    return {"all": n, "onethird": math.ceil(n / 3), "sqrt": math.ceil(math.sqrt(n)), "log2": max(1, math.ceil(math.log2(n)))}[subset]


# Draws


def mixed(x: np.ndarray) -> np.ndarray:
    """64 bits to 64 bits that look independent of them."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _start(seed: int, tree: int) -> np.uint64:
    return mixed(np.array([(seed * 0x9E3779B97F4A7C15 + (tree + 1) * 0xD1342543DE82EF95) % 2**64], dtype=np.uint64))[0]


_ENDS = [min(2**32 - 1, round(sum(math.exp(-1) / math.factorial(j) for j in range(i + 1)) * 2**32)) for i in range(bagging.MOST)]


def drawn(keys: np.ndarray, seed: int, tree: int) -> np.ndarray:
    """How often rows with these hashes are drawn for a tree: Poisson with mean 1."""
    u = (mixed(mixed(keys.view(np.uint64)) + _start(seed, tree)) >> np.uint64(32)).astype(np.uint32)
    out = np.zeros(len(u), dtype=np.uint8)
    for end in _ENDS:
        out += u >= np.uint32(end)
    return out


def allowed(nodes: np.ndarray, n_features: int, size: int, seed: int, tree: int) -> np.ndarray:
    """The features each node may use, in ascending order; a node is known by its place in the full tree."""
    if size == n_features:
        return np.broadcast_to(np.arange(n_features), (len(nodes), n_features))
    at = nodes.astype(np.uint64)[:, None] * np.uint64(n_features) + np.arange(n_features, dtype=np.uint64)
    return np.sort(np.argsort(mixed(mixed(at) ^ _start(seed, ~tree)), axis=1, kind="stable")[:, :size], axis=1)


# Trees


def grow(bins: np.ndarray, n_bins: Sequence[int], w: np.ndarray, s: np.ndarray, depth: int, size: int | None = None, seed: int = 0, tree: int = 0):
    """A tree on cells with weights `w` and sums of labels `s`, and the node every cell ends in.

    `bins` holds a row of bin numbers per feature. Level by level each node takes the split with the largest fall of the
    squared error, the first one of equals. Cells without weight have no say but are led to a node too. The tree is a dictionary of arrays by
    node, parents before children: feature (-1 in a leaf), the last bin that goes left, children, prediction, gain, and weight, sum and sum of squares.
    """
    n_features, n = bins.shape
    size, most = size or n_features, max(n_bins)
    columns = np.arange(n)
    total = w.sum() or 1.0
    mean = s.sum() / total
    # Sums are taken about the mean: the falls of the squared error do not change, and less is lost to rounding.
    c = s - mean * w
    q = np.divide(c * c, w, out=np.zeros(n), where=w > 0)
    least = LEAST_GAIN * max(q.sum() / total, 0.0)
    out = {k: [] for k in ("feature", "bin", "left", "gain", "w", "c", "q")}
    leaf = np.zeros(n, dtype=np.int32)
    cells, node, places = columns, np.zeros(n, dtype=np.intp), np.ones(1, dtype=np.int64)
    first = 0
    for level in range(depth + 1):
        a = len(places)
        wc, cc = (w, c) if len(cells) == n else (w[cells], c[cells])
        nw, nc = np.bincount(node, wc, a), np.bincount(node, cc, a)
        nq = np.bincount(node, q[cells], a)
        feature, cut, left, gain = np.full(a, -1, np.int32), np.zeros(a, np.int32), np.full(a, -1, np.int32), np.full(a, -1.0)
        if level < depth:
            chosen = allowed(places, n_features, size, seed, tree)
            best, place = np.full(a, -np.inf), np.zeros(a, np.int64)
            base = node * most
            for j in range(size):
                if size == n_features:
                    # One feature for all nodes, so its bins lie together.
                    here = bins[j] if len(cells) == n else bins[j][cells]
                else:
                    here = bins[chosen[node, j], cells]
                at = base + here
                lw = np.bincount(at, wc, a * most).reshape(a, most).cumsum(axis=1)
                lc = np.bincount(at, cc, a * most).reshape(a, most).cumsum(axis=1)
                lw, rw = lw[:, :-1], nw[:, None] - lw[:, :-1]
                lc = lc[:, :-1] - (nc / np.where(nw > 0, nw, 1))[:, None] * lw
                ok = (lw > 0.5) & (rw > 0.5)  # weights are whole numbers
                fall = np.where(ok, lc * lc * (1 / np.where(ok, lw, 1) + 1 / np.where(ok, rw, 1)), -np.inf)
                value = fall.max(axis=1)
                top = (fall >= (value * (1 - SAME))[:, None]).argmax(axis=1)
                better = value > best * (1 + SAME)
                best = np.where(better, value, best)
                place = np.where(better, chosen[:, j] * most + top, place)
            with np.errstate(divide="ignore", invalid="ignore"):
                gains = best / nw
            split = gains > least
            feature[split], cut[split] = place[split] // most, place[split] % most
            gain[split] = gains[split]
            left[split] = first + a + 2 * np.arange(split.sum())
        for k, v in (("feature", feature), ("bin", cut), ("left", left), ("gain", gain), ("w", nw), ("c", nc), ("q", nq)):
            out[k].append(v)
        leaf[cells] = first + node
        if level == depth or not (left >= 0).any():
            break
        going = left[node] >= 0
        cells, node = cells[going], node[going]
        right = bins[feature[node], cells] > cut[node]
        node = left[node] - (first + a) + right
        kept = places[left >= 0]
        places = np.stack([2 * kept, 2 * kept + 1], axis=1).ravel()
        first += a
    made = {k: np.concatenate(v) for k, v in out.items()}
    has = np.maximum(made["w"], 1e-300)
    made["prediction"] = mean + made["c"] / has
    made["sum"] = made["c"] + mean * made["w"]
    made["squares"] = made["q"] + 2 * mean * made["c"] + mean * mean * made["w"]
    made["impurity"] = np.maximum(0.0, made["q"] / has - (made["c"] / has) ** 2)
    del made["c"], made["q"]
    return made, leaf


def boost(bins: np.ndarray, n_bins: Sequence[int], w: np.ndarray, s: np.ndarray, trees: int, depth: int, step: float) -> list[dict]:
    """Trees grown one after the other on what the ones before leave, as Spark boosts squared error."""
    y = np.divide(s, w, out=np.zeros(len(w)), where=w > 0)
    made, at, left = [], np.zeros(len(w)), s
    for i in range(trees):
        one, leaf = grow(bins, n_bins, w, left, depth)
        made.append(one)
        at += (1.0 if i == 0 else step) * one["prediction"][leaf]
        left = w * (2 * (y - at))
    return made


def joined(trees: Sequence[Mapping[str, np.ndarray]], weights: Sequence[float]) -> dict[str, np.ndarray | int]:
    """An ensemble as arrays over all its nodes, in which a leaf leads to itself."""
    starts = np.cumsum([0, *[len(t["feature"]) for t in trees]])
    child = []
    for start, t in zip(starts, trees):
        here, inner = np.arange(len(t["left"])), t["left"] >= 0
        child.append(start + np.stack([np.where(inner, t["left"], here), np.where(inner, t["left"] + 1, here)], axis=1).ravel())
    value = np.concatenate([t["prediction"] * x for t, x in zip(trees, weights)])
    feature = np.concatenate([np.maximum(t["feature"], 0) for t in trees]).astype(np.int16)
    cut = np.concatenate([t["bin"] for t in trees]).astype(np.int16)
    deep = max(_depth(t) for t in trees)
    return {"roots": starts[:-1].astype(np.int32), "child": np.concatenate(child).astype(np.int32), "value": value, "feature": feature, "cut": cut, "depth": deep}


def _depth(t: Mapping[str, np.ndarray]) -> int:
    level, at = 0, np.zeros(1, np.int64)
    while len(at := t["left"][at][t["left"][at] >= 0]):
        at = np.concatenate([at, at + 1])
        level += 1
    return level


def predicted(ensemble: Mapping[str, np.ndarray | int], bins: np.ndarray) -> np.ndarray:
    """The sum of the trees' weighted predictions for columns of bin numbers."""
    out = np.zeros(bins.shape[1])
    for i in range(0, bins.shape[1], 4096):
        part = bins[:, i : i + 4096]
        columns = np.arange(part.shape[1])[None, :]
        at = np.repeat(ensemble["roots"][:, None], part.shape[1], axis=1)
        for _ in range(ensemble["depth"]):
            at = ensemble["child"][2 * at + (part[ensemble["feature"][at], columns] > ensemble["cut"][at])]
        out[i : i + 4096] = ensemble["value"][at].sum(axis=0)
    return out


# Cells


def unpacked(cells: np.ndarray, n_bins: Sequence[int]) -> np.ndarray:
    """The bin numbers of each feature, a row per feature."""
    out = np.empty((len(n_bins), len(cells)), dtype=np.uint8 if max(n_bins) <= 256 else np.int32)
    for i in reversed(range(len(n_bins))):
        cells, out[i] = np.divmod(cells, n_bins[i])
    return out


def _chunks(batches: Iterable[pa.RecordBatch], rows: int) -> Iterator[pa.Table]:
    """Batches put together until they have so many rows."""
    held, n = [], 0
    for b in batches:
        held.append(b)
        n += b.num_rows
        if n >= rows:
            yield pa.Table.from_batches(held)
            held, n = [], 0
    if n:
        yield pa.Table.from_batches(held)


def _column(table: pa.Table, name: str, kind: type) -> np.ndarray:
    return table[name].combine_chunks().to_numpy(zero_copy_only=False).astype(kind, copy=False)


def cell_rows(rows: DataFrame, names: Sequence[str], cuts: Mapping[str, Sequence[float]], label: str, key: Sequence[str] | None, n_rows: int) -> tuple[DataFrame, list[int]]:
    """The rows with the number of their cell and the hash their draws come from, near the other rows of the cell; and the bins of each feature."""
    n_bins = [len(cuts[c] or [0.0]) + 1 for c in names]
    binned = bagging.binner(names, cuts).stages[0].transform(rows)
    cell = F.lit(0).cast("bigint")
    for c, n in zip(names, n_bins):
        cell = cell * F.lit(n).cast("bigint") + F.col(f"_bin_{c}").cast("bigint")
    cell = F.coalesce(cell, F.raise_error(F.lit("a feature is missing")).cast("bigint"))
    out = binned.withColumns({CELL: cell, DRAW: F.xxhash64(*[F.col(c) for c in key or [label, *names]])}).drop(*[f"_bin_{c}" for c in names])
    out = out.repartitionByRange(2 * fit_partitions(n_rows), CELL, DRAW).sortWithinPartitions(CELL)
    return out, n_bins


def countable(cuts: Mapping[str, Sequence[float]]) -> bool:
    """Can a cell have a number of 64 bits?"""
    return math.prod(len(c) + 2 for c in cuts.values()) < 1 << 62


def bags(learners: Mapping[object, Learner]) -> list[tuple[int, int]]:
    """The draws that forests need: seed and number of the tree."""
    return sorted({(h.seed, i) for h in learners.values() if h.bootstrap for i in range(h.trees)})


def groups(table: DataFrame, label: str, fold: str, inner: str | None, bags: Sequence[tuple[int, int]]) -> DataFrame | None:
    """Rows summed up by cell, fold and inner part, in packed arrays: block -1 holds count, mean and squared deviations, block i the draws of BLOCK trees.

    None if there are more than MOST_GROUPS groups. A group may come in several pieces, as the rows of a cell may lie in several chunks.
    """
    shown = [F.col(CELL), F.col(fold).cast("int").alias("fold"), (F.col(inner) == 0 if inner else F.lit(False)).alias("inner"), F.col(label).cast("double").alias("y"), F.col(DRAW)]

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        for number, rows in enumerate(_chunks(batches, CHUNK)):
            cell, of, kept = _column(rows, CELL, np.int64), _column(rows, "fold", np.int64), _column(rows, "inner", bool)
            order = np.lexsort((kept, of, cell))
            cell, of, kept, y, keys = (x[order] for x in (cell, of, kept, _column(rows, "y", np.float64), _column(rows, DRAW, np.int64)))
            new = np.r_[True, (cell[1:] != cell[:-1]) | (of[1:] != of[:-1]) | (kept[1:] != kept[:-1])]
            at = np.flatnonzero(new)
            n = np.diff(np.r_[at, len(cell)])
            mean = np.add.reduceat(y, at) / n
            off = np.add.reduceat((y - np.repeat(mean, n)) ** 2, at)
            packed = [{"cell": cell[at], "fold": of[at].astype(np.int16), "inner": kept[at], "n": n.astype(np.int32), "mean": mean, "off": off}]
            for i in range(0, len(bags), BLOCK):
                weights = [drawn(keys, *bag) for bag in bags[i : i + BLOCK]]
                w = np.stack([np.add.reduceat(x, at, dtype=np.int32) for x in weights])
                s = np.stack([np.add.reduceat(x * y, at) for x in weights])
                packed.append({"w": w, "s": s})
            yield pa.RecordBatch.from_pydict({
                "chunk": pa.array([part * 1_000_000 + number] * len(packed), pa.int64()), "block": pa.array(range(-1, len(packed) - 1), pa.int32()),
                "size": pa.array([len(at)] + [0] * (len(packed) - 1), pa.int64()), "data": pa.array([pickle.dumps(p, 5) for p in packed], pa.binary()),
            })

    packed = saved(table.select(*shown).mapInArrow(sums, "chunk bigint, block int, size bigint, data binary"), "groups")
    return packed if (packed.agg(F.sum("size")).first()[0] or 0) <= MOST_GROUPS else None


def _units(tasks: Sequence[Task], learners: Mapping[tuple[str, int], Learner], bags: Sequence[tuple[int, int]]) -> list[tuple[int, list]]:
    """Pieces of work, the longest first, each with the block of draws it needs (-1 for none): an ensemble that is boosted, some trees of forests, all single trees."""
    out: list[tuple[int, list]] = []
    blocks: dict[tuple[int, int], list] = {}
    for t in tasks:
        how = learners[t[0], t[1]]
        if how.kind == "gbt":
            out.append((-1, [(t, how, None, None)]))
            continue
        for i in range(how.trees):
            drawn_by = bags.index((how.seed, i)) if how.bootstrap else None
            group = (-1 if drawn_by is None else drawn_by // BLOCK, -1 if drawn_by is not None else i // BLOCK)
            blocks.setdefault(group, []).append((t, how, i, None if drawn_by is None else drawn_by % BLOCK))
    out += [(block, jobs) for (block, _), jobs in blocks.items()]
    return sorted(out, key=lambda u: -sum((h.trees if i is None else 1) * h.depth for _, h, i, _ in u[1]))


def fit(packed: DataFrame, tasks: Sequence[Task], learners: Mapping[tuple[str, int], Learner], n_bins: Sequence[int], bags: Sequence[tuple[int, int]]) -> tuple[dict[Task, list[dict]], DataFrame]:
    """The trees of every task, as far as predictions need them, and the table of all that is known of their nodes."""
    units, order = _units(tasks, learners, bags), {t: i for i, t in enumerate(tasks)}

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        base, draws, unit = {}, {}, None
        for b in batches:
            for unit, chunk, block, data in zip(*(b.column(i).to_pylist() for i in range(4))):
                (base if block < 0 else draws)[chunk] = pickle.loads(data)
        if unit is None:
            return
        chunks = sorted(base)
        of, kept, n, mean = (np.concatenate([base[i][k] for i in chunks]) for k in ("fold", "inner", "n", "mean"))
        cells, place = np.unique(np.concatenate([base.pop(i)["cell"] for i in chunks]), return_inverse=True)
        bins, jobs = unpacked(cells, n_bins), units[unit][1]
        w_drawn, s_drawn = (np.concatenate([draws[i][k] for i in chunks], axis=1) if draws else None for k in ("w", "s"))
        draws.clear()
        for number, whole in sorted({(t[2], t[3]) for t, *_ in jobs}):
            used = (of != number) & (whole | ~kept)
            at = place[used]
            for t, how, i, j in jobs:
                if (t[2], t[3]) != (number, whole):
                    continue
                w, s = (n[used].astype(float), n[used] * mean[used]) if j is None else (w_drawn[j][used].astype(float), s_drawn[j][used])
                w, s = np.bincount(at, w, len(cells)), np.bincount(at, s, len(cells))
                has = w > 0
                here, w, s = (bins, w, s) if has.all() else (bins[:, has], w[has], s[has])
                if how.kind == "gbt":
                    made, numbers = boost(here, n_bins, w, s, how.trees, how.depth, how.step), range(how.trees)
                else:
                    size = subset_size(how.subset, len(n_bins))
                    made, numbers = [grow(here, n_bins, w, s, how.depth, size, how.seed, i)[0]], [i]
                yield pa.RecordBatch.from_pydict({
                    "task": pa.array([order[t]] * len(made), pa.int32()), "tree": pa.array(numbers, pa.int32()),
                    "shape": pa.array([pickle.dumps({k: m[k] for k in SHAPE}, 5) for m in made], pa.binary()), "data": pa.array([pickle.dumps(m, 5) for m in made], pa.binary()),
                })

    needed = F.array(*[F.struct(F.lit(i).alias("unit"), F.lit(block).alias("of")) for i, (block, _) in enumerate(units)])
    spread = packed.select(F.inline(F.filter(needed, lambda u: (F.col("block") < 0) | (u["of"] == F.col("block")))), "chunk", "block", "data")
    spread = spread.select("unit", "chunk", "block", "data").repartitionById(len(units), F.col("unit"))
    made = saved(spread.mapInArrow(work, "task int, tree int, shape binary, data binary"), "trees")
    out: dict[Task, dict[int, dict]] = {t: {} for t in tasks}
    for r in made.select("task", "tree", "shape").toArrow().to_pylist():
        out[tasks[r["task"]]][r["tree"]] = pickle.loads(r["shape"])
    return {t: [trees[i] for i in sorted(trees)] for t, trees in out.items()}, made


def weights(how: Learner) -> list[float]:
    """What each tree counts in the model."""
    return [1.0] + [how.step] * (how.trees - 1) if how.kind == "gbt" else [1.0] * how.trees


def ensembles(fits: Mapping[Task, Sequence[dict]], learners: Mapping[tuple[str, int], Learner]) -> dict[Task, dict]:
    out = {}
    for t, trees in fits.items():
        how = learners[t[0], t[1]]
        out[t] = joined(trees, [x / how.trees for x in weights(how)] if how.kind == "forest" else weights(how))
    return out


def scores(packed: DataFrame, fits: Mapping[Task, Sequence[dict]], learners: Mapping[tuple[str, int], Learner], n_bins: Sequence[int]) -> dict[Task, tuple[float, float, float | None]]:
    """Per task the RMSE to choose by, on the rows fitted on or those kept for an inner choice, and RMSE and R squared of the fold left out."""
    told = packed.sparkSession.sparkContext.broadcast(ensembles(fits, learners))
    order = list(fits)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[tuple[int, bool], list[float]] = {}
        labels: dict[int, tuple[float, float, float]] = {}
        held, size = [], 0

        def flush() -> None:
            cell, of, kept, n, mean, off = (np.concatenate([h[k] for h in held]) for k in ("cell", "fold", "inner", "n", "mean", "off"))
            cells, place = np.unique(cell, return_inverse=True)
            bins = unpacked(cells, n_bins)
            for i in np.unique(of).tolist():
                here = of == i
                m = n[here].sum()
                middle = (n[here] * mean[here]).sum() / m
                labels[i] = _merged(labels.get(i, (0.0, 0.0, 0.0)), (float(m), middle, off[here].sum() + (n[here] * (mean[here] - middle) ** 2).sum()))
            for i, t in enumerate(order):
                error = off + n * (mean - predicted(told.value[t], bins)[place]) ** 2
                out, seen = of == t[2], (of != t[2]) & (t[3] | kept)
                for held_out, rows in ((True, out), (False, seen)):
                    entry = sums.setdefault((i, held_out), [0.0, 0.0])
                    entry[0] += n[rows].sum()
                    entry[1] += error[rows].sum()

        for b in batches:
            for data in b.column(0).to_pylist():
                held.append(pickle.loads(data))
                size += len(held[-1]["n"])
                if size >= CHUNK:
                    flush()
                    held.clear()
                    size = 0
        if held:
            flush()
        rows = [(i, h, n, e, 0.0) for (i, h), (n, e) in sums.items()] + [(-1 - i, False, *v) for i, v in labels.items()]
        yield pa.RecordBatch.from_pylist([dict(zip(("at", "held_out", "n", "a", "b"), map(_plain, r))) for r in rows], schema=shape)

    shape = pa.schema([("at", pa.int32()), ("held_out", pa.bool_()), ("n", pa.float64()), ("a", pa.float64()), ("b", pa.float64())])
    found: dict[tuple[int, bool], list[float]] = {}
    label: dict[int, tuple[float, float, float]] = {}
    base = packed.where("block < 0").select("data")
    for r in base.mapInArrow(work, "at int, held_out boolean, n double, a double, b double").toArrow().to_pylist():
        if r["at"] < 0:
            label[-1 - r["at"]] = _merged(label.get(-1 - r["at"], (0.0, 0.0, 0.0)), (r["n"], r["a"], r["b"]))
        else:
            entry = found.setdefault((r["at"], r["held_out"]), [0.0, 0.0])
            entry[0] += r["n"]
            entry[1] += r["a"]
    told.unpersist()
    out = {}
    for i, t in enumerate(order):
        (n, error), (m, other) = found[i, True], found[i, False]
        spread = label[t[2]][2]
        out[t] = (math.sqrt(other / m) if m else math.nan, math.sqrt(error / n), 1 - error / spread if spread else None)
    return out


def _plain(x):
    return x.item() if isinstance(x, np.generic) else x


def _merged(one: tuple[float, float, float], other: tuple[float, float, float]) -> tuple[float, float, float]:
    """Count, mean and squared deviations of two sets of numbers together."""
    n = one[0] + other[0]
    apart = other[1] - one[1]
    return n, one[1] + apart * other[0] / n, one[2] + other[2] + apart * apart * one[0] * other[0] / n


def predictions(table: DataFrame, fold: str, fits: Mapping[Task, Sequence[dict]], learners: Mapping[tuple[str, int], Learner], n_bins: Sequence[int]) -> DataFrame:
    """The rows, each with the prediction of every learner's model that left its fold out, in a column `_prediction_` and the learner's place."""
    told = table.sparkSession.sparkContext.broadcast({(t[0], t[2]): e for t, e in ensembles(fits, learners).items()})
    names = list(dict.fromkeys(t[0] for t in fits))
    shown = [c for c in table.columns if c not in (CELL, DRAW)]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            cells, place = np.unique(b.column("_at").to_numpy(), return_inverse=True)
            of, bins = b.column("_of").to_numpy(), unpacked(cells, n_bins)
            out = {n: np.zeros(b.num_rows) for n in names}
            for i in np.unique(of).tolist():
                rows = of == i
                met, at = np.unique(place[rows], return_inverse=True)
                for n in names:
                    out[n][rows] = predicted(told.value[n, i], bins[:, met])[at]
            columns = [b.column(c) for c in shown] + [pa.array(out[n]) for n in names]
            yield pa.RecordBatch.from_arrays(columns, names=[*shown, *[f"_prediction_{i}" for i in range(len(names))]])

    schema = table.select(*shown).schema
    for i in range(len(names)):
        schema = schema.add(f"_prediction_{i}", "double")
    rows = table.select(*shown, F.col(CELL).alias("_at"), F.col(fold).cast("int").alias("_of"))
    return saved(rows.mapInArrow(work, schema), "predictions")


# Models as Spark knows them


_MODELS = {"tree": DecisionTreeRegressionModel, "gbt": GBTRegressionModel, "forest": RandomForestRegressionModel}


class Shaper:
    """Makes Spark's models of grown trees, by the files that Spark itself writes for a model of one tree."""

    def __init__(self, spark: SparkSession, built: Estimator, label: str, n_features: int):
        self.spark, self.how, self.path = spark, learner(built), scratch_path(spark, "model")
        few = {"gbt": "maxIter", "forest": "numTrees"}
        columns = [f"_x{i}" for i in range(n_features)]
        rows = local_table(spark, [(float(i), *[float(i)] * n_features) for i in range(2)], ", ".join(f"{c} double" for c in [label, *columns]))
        one = {built.labelCol: label, built.maxDepth: 1} | ({built.getParam(few[self.how.kind]): 1} if self.how.kind in few else {})
        built.copy(one).fit(VectorAssembler(inputCols=columns, outputCol=FEATURES).transform(rows)).write().save(f"{self.path}/shape")
        self.about = json.loads(spark.read.text(f"{self.path}/shape/metadata").first()["value"])
        self.trees = spark.read.parquet(f"{self.path}/shape/treesMetadata") if self.how.kind in few else None
        self.tree = json.loads(self.trees.first()[1]) if self.trees else None
        self.few = few.get(self.how.kind)

    def model(self, built: Estimator, trees: DataFrame, name: str) -> Model:
        how, at = learner(built), f"{self.path}/{name}"
        changed = {"maxDepth": how.depth, "seed": how.seed} | ({self.few: how.trees} if self.few else {})
        about = self.about | {"paramMap": self.about["paramMap"] | changed, "uid": built.uid} | ({"numTrees": how.trees} if self.few else {})
        local_table(self.spark, [(json.dumps(about),)], "value string").coalesce(1).write.text(f"{at}/metadata")
        node = nodes(trees)
        if not self.few:
            node = node.select("nodeData.*")
        node.write.parquet(f"{at}/data")
        if self.few:
            params = self.tree["paramMap"] | {"maxDepth": how.depth, "seed": how.seed}
            rows = [(i, json.dumps(self.tree | {"paramMap": params, "uid": f"{self.tree['uid']}_{i}"}), x) for i, x in enumerate(weights(how))]
            ids, texts, xs = self.trees.columns
            local_table(self.spark, rows, f"{ids} int, {texts} string, {xs} double").coalesce(1).write.parquet(f"{at}/treesMetadata")
        return _MODELS[how.kind].load(at)


def nodes(trees: DataFrame) -> DataFrame:
    """The nodes of grown trees in Spark's form."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for tree, data in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                made = pickle.loads(data)
                n = len(made["left"])
                yield pa.RecordBatch.from_pydict({"treeID": np.full(n, tree, np.int32), "id": np.arange(n, dtype=np.int32)} | {k: made[k] for k in known})

    known = ("prediction", "impurity", "w", "sum", "squares", "gain", "left", "feature", "bin")
    kinds = ["int", "int", *["double"] * 6, "int", "int", "int"]
    flat = trees.select("tree", "data").mapInArrow(work, ", ".join(f"{c} {kind}" for c, kind in zip(("treeID", "id", *known), kinds)))
    inner = F.col("feature") >= 0
    cut = F.when(inner, F.array(F.col("bin") + F.lit(0.5))).otherwise(F.array().cast("array<double>"))
    return flat.select("treeID", F.struct(
        "id", "prediction", "impurity", F.array("w", "sum", "squares").alias("impurityStats"), F.col("w").cast("bigint").alias("rawCount"), "gain",
        F.col("left").alias("leftChild"), F.when(inner, F.col("left") + 1).otherwise(-1).alias("rightChild"),
        F.struct(F.col("feature").alias("featureIndex"), cut.alias("leftCategoriesOrThreshold"), F.lit(-1).alias("numCategories")).alias("split"),
    ).alias("nodeData"))


def shaped(spark: SparkSession, built: Mapping[Task, Estimator], trees: Mapping[Task, DataFrame], label: str, n_features: int, parallelism: int) -> dict[Task, Model]:
    """The tasks' trees as Spark's models."""
    threaded = inheritable_thread_target(spark)
    with ThreadPool(max(1, parallelism)) as pool:
        names = list(dict.fromkeys(t[0] for t in built))
        first = {n: next(b for t, b in built.items() if t[0] == n) for n in names}
        shapers = dict(zip(names, pool.map(threaded(lambda n: Shaper(spark, first[n], label, n_features)), names, chunksize=1)))
        made = pool.map(threaded(lambda t: shapers[t[0]].model(built[t], trees[t], f"{t[1]}_{t[2]}")), list(built), chunksize=1)
    return dict(zip(built, made))


def fit_all(rows: DataFrame, label: str, names: Sequence[str], made: Mapping[str, Estimator], n_rows: int, parallelism: int) -> dict[str, Fit]:
    """Those of the built estimators that can be grown on cells, fitted on all rows; none if there are too many cells."""
    learners = {(kind, 0): how for kind, built in made.items() if (how := learner(built))}
    widths = {made[kind].getMaxBins() for kind, _ in learners}
    if len(widths) != 1:
        return {}
    cuts = bagging.split_points(rows, names, widths.pop())
    if not countable(cuts):
        return {}
    table, n_bins = cell_rows(rows.withColumn("_fold", F.lit(1)), names, cuts, label, None, n_rows)
    packed = groups(table, label, "_fold", None, bags(learners))
    if packed is None:
        return {}
    tasks = [(kind, 0, 0, True) for kind, _ in learners]  # no row is in fold 0
    trees = fit(packed, tasks, learners, n_bins, bags(learners))[1]
    shapes = shaped(rows.sparkSession, {t: made[t[0]] for t in tasks}, {t: trees.where(F.col("task") == i) for i, t in enumerate(tasks)}, label, len(names), parallelism)
    to_bins = bagging.binner(names, cuts)
    return {t[0]: Fit(PipelineModel([to_bins, shapes[t]]), label, list(names), [], list(names)) for t in tasks}
