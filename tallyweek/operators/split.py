"""Splits and folds that depend on row content only."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from itertools import accumulate

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


# The hash of a key takes this many values.
HASHES = 1 << 32


def key_hash(key: Sequence[str], seed: int | None = None) -> Column:
    """0..HASHES-1 from the md5 of the key; another seed, another order."""
    parts = [F.lit(str(seed))] if seed is not None else []
    text = F.concat_ws("|", *parts, *[F.col(c).cast("string") for c in key])
    return F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("bigint")


def hash_bucket(key: Sequence[str], buckets: int, seed: int | None = None) -> Column:
    """Bucket 0..buckets-1 by the hash of the key."""
    return (key_hash(key, seed) % buckets).cast("int")


def part_name(weights: Mapping[str, float], key: Sequence[str], seed: int | None = None) -> Column:
    """Name of the part a row falls in: its hash against the cumulated weights."""
    ends = [e / sum(weights.values()) * HASHES for e in accumulate(weights.values())]
    at, *names = key_hash(key, seed), *weights
    out = F.when(at < F.lit(ends[0]), names[0])
    for name, end in zip(names[1:-1], ends[1:-1]):
        out = out.when(at < F.lit(end), name)
    return out.otherwise(names[-1]) if len(names) > 1 else F.lit(names[0])


def split(
    df: DataFrame,
    weights: Mapping[str, float],
    key: Sequence[str] | None = None,
    seed: int | None = None,
    method: str = "hash",
) -> dict[str, DataFrame]:
    """Named parts with the given weights (M2).

    `hash` puts a row where its key says, whatever the partitioning; the key is
    all columns if not given. `random` is Spark's own split, repeatable for a
    seed only if the partitioning repeats.
    """
    if method == "random":
        return dict(zip(weights, df.randomSplit(list(map(float, weights.values())), seed)))
    part = part_name(weights, key or df.columns, seed)
    return {name: df.where(part == name) for name in weights}


def with_fold(df: DataFrame, k: int = 5, key: Sequence[str] | None = None, seed: int | None = None) -> DataFrame:
    """Add `fold`, 1..k."""
    return df.withColumn("fold", hash_bucket(key or df.columns, k, seed) + 1)
