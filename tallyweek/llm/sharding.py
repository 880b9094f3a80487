"""Shards by a consistent-hash ring with virtual nodes and bounded loads.

Every shard has `nodes` places on a ring of 64-bit hashes. A row belongs to the arc
its key falls on, and so to the shard whose node ends that arc. No shard takes more than
its capacity: what overflows goes on clockwise to the next node whose shard has
room, and so on. With no slack the capacities are the row count dealt evenly, so
that shard sizes differ by one row at most (law `rows`); a row leaves its home
shard only where that is full.

Overflow depends on counts alone. Spark counts the rows of each arc; the ring
of shards * nodes arcs (bounded by parameters, never by data) is walked once on the driver, which
says for each arc how many of its rows, in ring order, go to which shard and slots.
Rows then look their place up by their rank within their arc. Ranks are numbered within
small buckets of an arc and shifted by the counts of the buckets before, so no
task sorts a whole arc. Rows alike in all columns are counted as one and dealt with
as a run of ranks, and rows alike in key only lie in different buckets, so a hot
key is no hot bucket.

Cases: a null text has size 1 and crc 0; null ids hash like a value of their own;
repeated rows are rows like any other; an empty table gives an empty result; other
columns are not read.
"""

from __future__ import annotations

from collections import deque

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallyweek.llm.common import small, written

SHARDS, NODES = 16, 64
# Rows a bucket should hold, and over how many buckets equal keys may spread.
BUCKET_ROWS = 20_000


def ring(n_shards: int, nodes: int = NODES) -> list[tuple[int, int]]:
    """(end of the arc as a signed hash, shard) of every virtual node, clockwise."""
    place = lambda shard, i: xxhash.xxh64_intdigest(f"{shard}/{i}", 1) - (1 << 63)
    return sorted((place(shard, i), shard) for shard in range(n_shards) for i in range(nodes))


def capacities(n: int, n_shards: int, slack: float = 0.0) -> list[int]:
    """The row count dealt evenly, or with slack (1 + slack) times the mean for each."""
    if slack > 0:
        return [-int(-n * (1 + slack) // n_shards)] * n_shards
    return [n // n_shards + (shard < n % n_shards) for shard in range(n_shards)]


def walk(arcs: list[tuple[int, int]], counts: list[int], room: list[int]) -> list[tuple[int, int, int, int, int]]:
    """(arc, first rank, last rank, shard, first slot): where the rows of each arc go.

    Rows take room in their home shards first; the rest is carried clockwise, first come first served.
    """
    room, used, out = list(room), [0] * len(room), []

    def place(arc: int, first: int, n: int, shard: int) -> int:
        take = min(n, room[shard])
        if take:
            out.append((arc, first, first + take - 1, shard, used[shard]))
            room[shard] -= take
            used[shard] += take
        return take

    over = []
    for arc, (_, shard) in enumerate(arcs):
        took = place(arc, 0, counts[arc], shard)
        over.append((arc, took, counts[arc] - took))
    carried: deque[tuple[int, int, int]] = deque()
    for arc, (_, shard) in [*enumerate(arcs)] * 2:
        while carried and room[shard]:
            source, first, n = carried.popleft()
            took = place(source, first, n, shard)
            if took < n:
                carried.appendleft((source, first + took, n - took))
        if over and over[0][0] == arc:
            carried.append(over.pop(0))
    return out


def assign(rows: DataFrame, key: str, n_shards: int = SHARDS, nodes: int = NODES, slack: float = 0.0) -> DataFrame:
    """`rows` with home_shard, shard and slot, which is gapless from 0 within a shard.

    Rows alike in all columns are counted first and told apart again at the end.
    """
    columns = rows.columns
    arcs = ring(n_shards, nodes)
    ends, shard_of = np.array([end for end, _ in arcs], np.int64), np.array([shard for _, shard in arcs], np.int32)

    @F.pandas_udf("int")
    def arc(position: pd.Series) -> pd.Series:
        """The first node at or after a position; past the last one, the first again."""
        return pd.Series(np.searchsorted(ends, position.to_numpy()) % len(ends))

    alike = rows.groupBy(*columns).agg(F.count("*").alias("_n")).withColumn("_position", F.xxhash64(key))
    alike = written(alike.withColumn("_arc", arc("_position")).withColumn("_order", F.xxhash64("_position", *columns)), "ring")
    per_arc = {r["_arc"]: r["n"] for r in alike.groupBy("_arc").agg(F.sum("_n").alias("n")).collect()}
    counts = [per_arc.get(i, 0) for i in range(len(arcs))]
    plan = walk(arcs, counts, capacities(sum(counts), n_shards, slack))

    # Ranks within small buckets of an arc, shifted by the buckets before.
    n_buckets = max(1, sum(counts) // (BUCKET_ROWS * len(arcs)))
    dealt = alike.withColumn("_bucket", F.pmod("_order", F.lit(n_buckets)))
    bucket = Window.partitionBy("_arc", "_bucket").orderBy("_order", "_position", *columns)
    ranked = dealt.withColumn("_upto", F.sum("_n").over(bucket.rowsBetween(Window.unboundedPreceding, 0)))
    sizes = dealt.groupBy("_arc", "_bucket").agg(F.sum("_n").alias("_rows"))
    before = F.sum("_rows").over(Window.partitionBy("_arc").orderBy("_bucket")) - F.col("_rows")
    offsets = small(written(sizes.select("_arc", "_bucket", before.alias("_before")), "buckets"))
    placed = ranked.join(offsets, ["_arc", "_bucket"]).withColumn("_first", F.col("_before") + F.col("_upto") - F.col("_n"))
    each = placed.select(*columns, "_arc", F.explode(F.sequence("_first", F.col("_first") + F.col("_n") - 1)).alias("_rank"))

    base = np.concatenate([[0], np.cumsum(counts)])
    runs = sorted((int(base[a]) + first, shard, slot) for a, first, _, shard, slot in plan)
    starts, shards, slots = (np.array([run[i] for run in runs], np.int64) for i in range(3))

    @F.pandas_udf("shard int, slot long, home_shard int")
    def place(arc: pd.Series, rank: pd.Series) -> pd.DataFrame:
        at = base[arc.to_numpy()] + rank.to_numpy()
        i = np.searchsorted(starts, at, side="right") - 1
        return pd.DataFrame({"shard": shards[i].astype(np.int32), "slot": slots[i] + at - starts[i], "home_shard": shard_of[arc.to_numpy()]})

    return each.withColumn("_placed", place("_arc", "_rank")).select(*columns, "_placed.*")


def shards(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", n_shards: int = SHARDS, nodes: int = NODES) -> DataFrame:
    """(doc_id, size, text_crc32, law, shard, slot, grown_shard, home_shard) of every document."""
    data = F.encode(F.coalesce(F.col(text_col), F.lit("")), "UTF-8")
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), (F.octet_length(data) + 1).cast("long").alias("size"), F.crc32(data).alias("text_crc32"))
    out = assign(rows, "doc_id", n_shards, nodes)
    return out.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"), "home_shard")
