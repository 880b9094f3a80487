"""Pearson correlations in long form."""

from __future__ import annotations

from collections.abc import Sequence
from itertools import combinations

import numpy as np
from pyspark.ml.feature import PCA, StandardScaler, VectorAssembler
from pyspark.ml.stat import Correlation, Summarizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyweek.functions.columns import is_missing, numeric_columns
from tallyweek.functions.sizing import local_table


def _profile(df: DataFrame, names: Sequence[str]) -> dict[str, tuple[bool, bool]]:
    """For each column: is it constant, has it missing values."""
    aggs = [F.count(F.lit(1))]
    for c in names:
        seen = F.when(~is_missing(df, c), F.col(c))
        aggs += [F.count(seen), F.min(seen), F.max(seen)]
    row = list(df.agg(*aggs).first())
    rows, rest = row[0], row[1:]
    return {
        c: (rest[3 * i + 1] == rest[3 * i + 2], rest[3 * i] < rows) for i, c in enumerate(names)
    }


def _vectors(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """The named columns as one vector, rows with missing values left out."""
    to_vector = VectorAssembler(inputCols=list(names), outputCol="v", handleInvalid="skip")
    return to_vector.transform(df.select(*names)).select("v")


def _complete_pairs(df: DataFrame, names: Sequence[str]) -> dict[tuple[str, str], float | None]:
    """Correlation of every two columns over the rows that have both, NULL if a side is constant there.

    Each row becomes one vector of its standardised values (0 where missing), their
    squares and marks of presence. The products of these, summed in one pass, hold
    counts, sums, squares and cross products of every pair. Where a side varies little
    over the shared rows, next to its whole column, these are too coarse and the pair
    is computed again.
    """
    seen = {c: ~is_missing(df, c) for c in names}
    aggs = [f(F.when(seen[c], F.col(c).cast("double"))) for c in names for f in (F.avg, F.stddev_pop)]
    row = df.agg(*aggs).first()
    scale = {c: (row[2 * i] or 0.0, row[2 * i + 1] or 1.0) for i, c in enumerate(names)}
    z = {c: F.when(seen[c], (F.col(c).cast("double") - m) / s).otherwise(0.0) for c, (m, s) in scale.items()}
    p = len(names)
    parts = [z[c].alias(f"z{i}") for i, c in enumerate(names)]
    parts += [(z[c] * z[c]).alias(f"q{i}") for i, c in enumerate(names)]
    parts += [seen[c].cast("double").alias(f"m{i}") for i, c in enumerate(names)]
    to_vector = VectorAssembler(inputCols=[f"{k}{i}" for k in "zqm" for i in range(p)], outputCol="v")
    rows = to_vector.transform(df.select(*parts)).select("v")
    moments = rows.agg(Summarizer.metrics("mean", "std", "count").summary(F.col("v")).alias("s")).first()["s"]
    n, mean, sd = moments["count"], moments["mean"].toArray(), moments["std"].toArray()
    if n < 2:
        return {pair: None for pair in combinations(names, 2)}
    r = np.nan_to_num(Correlation.corr(rows, "v").first()[0].toArray())
    product = r * np.outer(sd, sd) * (n - 1) + n * np.outer(mean, mean)
    out: dict[tuple[str, str], float | None] = {}
    narrow = []
    for (i, a), (j, b) in combinations(enumerate(names), 2):
        both = product[2 * p + i, 2 * p + j]
        sa, sb, saa, sbb, sab = product[i, 2 * p + j], product[j, 2 * p + i], product[p + i, 2 * p + j], product[p + j, 2 * p + i], product[i, j]
        va, vb = both * saa - sa * sa, both * sbb - sb * sb
        if both < 1.5:
            out[a, b] = None
        elif min(va, vb) <= 1e-9 * both * both:
            narrow.append((a, b))
        else:
            out[a, b] = float((both * sab - sa * sb) / np.sqrt(va * vb))
    return out | _narrow_pairs(df, narrow)


def _narrow_pairs(df: DataFrame, pairs: Sequence[tuple[str, str]], at_once: int = 200) -> dict[tuple[str, str], float | None]:
    """Correlation of the given pairs from the ranges and means of their shared rows, NULL if a side is constant there."""
    if len(pairs) > at_once:
        return _narrow_pairs(df, pairs[:at_once], at_once) | _narrow_pairs(df, pairs[at_once:], at_once)
    if not pairs:
        return {}
    sides = []
    for a, b in pairs:
        shared = ~is_missing(df, a) & ~is_missing(df, b)
        sides += [F.when(shared, F.col(c).cast("double")) for c in (a, b)]
    row = list(df.agg(*[f(v) for v in sides for f in (F.min, F.max, F.avg)]).first())
    spread = [row[i + 1] - row[i] for i in range(0, len(row), 3)]
    scaled = [(v - row[3 * i + 2]) / d if 0 < d < float("inf") else None for i, (v, d) in enumerate(zip(sides, spread))]
    varying = [k for k in range(len(pairs)) if scaled[2 * k] is not None and scaled[2 * k + 1] is not None]
    out: dict[tuple[str, str], float | None] = dict.fromkeys(pairs)
    if varying:
        found = df.agg(*[F.corr(scaled[2 * k], scaled[2 * k + 1]) for k in varying]).first()
        out |= {pairs[k]: r for k, r in zip(varying, found)}
    return out


def correlation_matrix(df: DataFrame, columns: Sequence[str] | None = None, upper: bool = False) -> DataFrame:
    """Correlation of every two numeric columns: x, y, r.

    Missing values are left out pair by pair, and a column that does not vary
    has NULL correlations. `upper` keeps the upper triangle and the diagonal (A27).
    """
    names = list(columns or numeric_columns(df))
    profile = _profile(df, names)
    constant = {c for c in names if profile[c][0]}
    whole = [c for c in names if c not in constant and not profile[c][1]]
    known: dict[tuple[str, str], float | None] = {(c, c): None if c in constant else 1.0 for c in names}
    if len(whole) > 1:
        r = Correlation.corr(_vectors(df, whole), "v").first()[0].toArray()
        known |= {(a, b): float(r[i, j]) for (i, a), (j, b) in combinations(enumerate(whole), 2)}
    known |= {p: None for p in combinations(names, 2) if constant & set(p)}
    open_pairs = [p for p in combinations(names, 2) if p not in known]
    if open_pairs:
        found = _complete_pairs(df, [c for c in names if c not in constant])
        known |= {p: found[p] for p in open_pairs}
    rows = [(a, b, v) for (a, b), v in known.items()]
    out = local_table(df.sparkSession, rows, "x string, y string, r double")
    if upper:
        return out
    mirrored = out.where("x <> y").select(F.col("y").alias("x"), F.col("x").alias("y"), "r")
    return out.unionByName(mirrored)


def first_component_order(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Columns ordered by their loading on the first principal component.

    Constant columns have no place in it. Rows with missing values are left
    out, and the sign is the one that makes the largest loading positive.
    """
    names = list(columns or numeric_columns(df))
    profile = _profile(df, names)
    varying = [c for c in names if not profile[c][0]]
    rows = _vectors(df, varying)
    scaler = StandardScaler(inputCol="v", outputCol="_z", withMean=True, withStd=True).fit(rows)
    component = PCA(k=1, inputCol="_z", outputCol="_p").fit(scaler.transform(rows)).pc.toArray()[:, 0]
    if component[abs(component).argmax()] < 0:
        component = -component
    # Columns that go together in full have equal loadings but for rounding; they go by name.
    loads = sorted(zip(varying, map(float, component)), key=lambda t: (round(t[1], 9), t[0]))
    table = [(i, c, v) for i, (c, v) in enumerate(loads, start=1)]
    return local_table(df.sparkSession, table, "position int, column string, loading double")


def screen_features(
    df: DataFrame, target: str, columns: Sequence[str] | None = None, threshold: float = 0.1
) -> DataFrame:
    """Correlation of each column with the target and whether to keep it."""
    names = [c for c in (columns or numeric_columns(df)) if c != target]
    table = correlation_matrix(df, [*names, target], upper=True)
    rows = table.where((F.col("y") == target) & (F.col("x") != target))
    return rows.select(
        F.col("x").alias("feature"), "r", F.coalesce(F.abs("r") >= threshold, F.lit(False)).alias("keep")
    )
