"""Exact quantiles of any number of rows per group.

Spark's `percentile` holds the distinct values of a group in one task. Here the
values are counted in ordered buckets, only the buckets in which a wanted rank
falls are looked at again, and a bucket is sorted once it is known to be small.
Each pass reads two columns, shuffles bucket counts, and moves no rows.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyweek.functions.sizing import saved

# A bucket with at most this many rows is sorted rather than divided again.
SORT_ROWS = 1_000_000
# A bucket to be divided is cut into this many equal widths.
PARTS = 65_536


def _first_bucket(x: Column) -> Column:
    """Ordered bucket of a number: 64 per factor e, negative values mirrored."""
    size = F.floor(F.least(F.ln(F.abs(x)) * 64, F.lit(1e6))) + 100_000
    return F.when(x == 0, F.lit(0)).when(x > 0, size).otherwise(-size).cast("long")


def _same(left: Sequence[str], right: Sequence[str]) -> Column:
    return reduce(lambda a, b: a & b, [F.col(a).eqNullSafe(F.col(b)) for a, b in zip(left, right)])


def _placed(buckets: DataFrame, keys: Sequence[str], by: str) -> DataFrame:
    """Add to each bucket how many rows of its key come before it and up to its end."""
    upto = F.sum("_n").over(Window.partitionBy(*keys).orderBy(by))
    return buckets.withColumn("_end", upto).withColumn("_start", F.col("_end") - F.col("_n"))


def quantiles(
    df: DataFrame, value: str, probs: Sequence[float], group: Sequence[str] = (), **how: int | None
) -> DataFrame:
    """Interpolated quantiles in long form: group columns, prob, quantile."""
    wide = named_quantiles(df, value, {f"_p{i}": p for i, p in enumerate(probs)}, group, **how)
    entries = [
        F.struct(F.lit(float(p)).alias("prob"), F.col(f"_p{i}").alias("quantile")) for i, p in enumerate(probs)
    ]
    return wide.select(*group, F.inline(F.array(*entries)))


def named_quantiles(
    df: DataFrame,
    value: str,
    probs: Mapping[str, float],
    group: Sequence[str] = (),
    approx: int | None = None,
    sort_rows: int = SORT_ROWS,
    parts: int = PARTS,
) -> DataFrame:
    """Interpolated quantiles, a named column each and one row per group.

    Missing values are left out, and so are groups with no other. The exact
    answer takes two passes for buckets up to `sort_rows` rows and one more per
    further division; it is computed here, not lazily, from the two columns, which are cached meanwhile. `approx` gives the accuracy of
    a one-pass estimate instead.
    """
    group, names = list(group), list(probs)
    gs = [f"_g{i}" for i in range(len(group))]
    rows = df.select(*[F.col(g).alias(a) for g, a in zip(group, gs)], F.col(value).cast("double").alias("_x"))
    # Every pass reads these columns again, so they are kept for the call.
    rows = rows.where(F.col("_x").isNotNull() & ~F.isnan("_x")).persist()
    at = [float(p) for p in probs.values()]
    if approx:
        found = rows.groupBy(*gs).agg(F.percentile_approx("_x", at, approx).alias("_q")).where(F.col("_q").isNotNull())
        columns = [F.col("_q")[i].alias(name) for i, name in enumerate(names)]
    else:
        found = _exact(rows, at, gs, sort_rows, parts)
        rows.unpersist()
        columns = [F.col(f"_q{i}").alias(name) for i, name in enumerate(names)]
    return found.select(*[F.col(a).alias(g) for g, a in zip(group, gs)], *columns)


def _exact(rows: DataFrame, probs: Sequence[float], gs: list[str], sort_rows: int, parts: int) -> DataFrame:
    stats = [F.count(F.lit(1)).alias("_n"), F.min("_x").alias("_lo"), F.max("_x").alias("_hi")]
    state = ["_prob", "_frac", "_rank", "_n", "_lo", "_hi"]

    # First division. Its counts give the one or two ranks that each quantile
    # lies between, and the buckets these fall in.
    first = rows.groupBy(*gs, _first_bucket(F.col("_x")).alias("_b")).agg(*stats)
    first = first.withColumn("_total", F.sum("_n").over(Window.partitionBy(*gs)))
    ranks = []
    for p in probs:
        at = F.lit(p) * (F.col("_total") - 1)
        for rank in (F.floor(at), F.ceil(at)):
            ranks.append(F.struct(F.lit(p).alias("_prob"), (at - F.floor(at)).alias("_frac"), rank.alias("_rank")))
    placed = _placed(first, gs, "_b").withColumn("_ranks", F.array_distinct(F.array(*ranks)))
    inside = F.filter("_ranks", lambda r: (r["_rank"] >= F.col("_start")) & (r["_rank"] < F.col("_end")))
    hits = placed.select(*gs, "_n", "_lo", "_hi", F.col("_start").alias("_below"), F.inline(inside))
    found = saved(hits.select(*gs, *state, "_below"), "ranks")

    def look_again(todo: DataFrame, by: Column, measures: list[Column]) -> DataFrame:
        """Count the rows of the buckets in `todo` by a finer key and find the ranks there."""
        finer = _within(rows, todo, gs).groupBy(*gs, "_l", "_h", by.alias("_b")).agg(*measures)
        ws = [f"_w{i}" for i in range(len(gs))]
        wanted = todo.select(
            *[F.col(g).alias(w) for g, w in zip(gs, ws)],
            F.col("_lo").alias("_wl"), F.col("_hi").alias("_wh"), "_prob", "_frac", "_rank", "_below",
        )
        here = (F.col("_rank") >= F.col("_below") + F.col("_start")) & (F.col("_rank") < F.col("_below") + F.col("_end"))
        return _placed(finer, [*gs, "_l", "_h"], "_b").join(wanted, _same([*gs, "_l", "_h"], [*ws, "_wl", "_wh"]) & here)

    # Divide the buckets that are still too large to sort. A bucket is known by
    # its group and its range, and holds every row of the group in that range.
    large = (F.col("_n") > sort_rows) & (F.col("_lo") < F.col("_hi"))
    part = F.floor((F.col("_x") - F.col("_l")) / (F.col("_h") - F.col("_l")) * (parts - 1))
    while _any(found, sort_rows):
        hits = look_again(found.where(large), part, stats)
        hits = hits.select(*gs, *state, (F.col("_below") + F.col("_start")).alias("_below"))
        found = saved(found.where(~large).select(*gs, *state, "_below").unionByName(hits), "ranks")

    # Sort the rest: distinct values with counts, at most `sort_rows` a bucket.
    ends = found.where(F.col("_lo") == F.col("_hi")).select(*gs, "_prob", "_frac", F.col("_lo").alias("_v"))
    todo = found.where(F.col("_lo") < F.col("_hi"))
    if _any(found, 0):
        hits = look_again(todo, F.col("_x"), [F.count(F.lit(1)).alias("_n")])
        ends = ends.unionByName(hits.select(*gs, "_prob", "_frac", F.col("_b").alias("_v")))
    columns = []
    for i, p in enumerate(probs):
        v, frac = F.when(F.col("_prob") == p, F.col("_v")), F.when(F.col("_prob") == p, F.col("_frac"))
        low, high = F.min(v), F.max(v)
        columns.append(F.when(low == high, low).otherwise(low + (high - low) * F.max(frac)).alias(f"_q{i}"))
    answer = ends.groupBy(*gs).agg(*columns)
    # Over no rows at all an ungrouped aggregate still gives one.
    return saved(answer if gs else answer.where(F.col("_q0").isNotNull()), "quantiles")


def _any(found: DataFrame, rows: int) -> bool:
    """Is there a bucket with different values and more than `rows` rows?"""
    return not found.where((F.col("_n") > rows) & (F.col("_lo") < F.col("_hi"))).isEmpty()


def _within(rows: DataFrame, todo: DataFrame, gs: list[str]) -> DataFrame:
    """The rows that lie in one of the buckets of `todo`, with its range."""
    names = [f"_t{i}" for i in range(len(gs))]
    ranges = todo.select(
        *[F.col(g).alias(t) for g, t in zip(gs, names)],
        F.col("_lo").alias("_l"), F.col("_hi").alias("_h"), _first_bucket(F.col("_lo")).alias("_tb"),
    ).distinct()
    inside = (_first_bucket(F.col("_x")) == F.col("_tb")) & (F.col("_x") >= F.col("_l")) & (F.col("_x") <= F.col("_h"))
    match = _same(gs, names) & inside if gs else inside
    return rows.join(ranges, match).drop(*names, "_tb")
