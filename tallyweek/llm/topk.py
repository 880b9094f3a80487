"""Exact top-k search by distributed histogram selection.

Every query is scored against every candidate, in blocks: a query block meets each
candidate block once, and a matrix product gives the scores. Nothing keeps the
scores. Passes narrow down where each query's k-th highest score lies:

1. A block pair counts its scores in bins of the query's current range. Only the
   topmost bins that hold the pair's own k best can matter, so a pair
   sends k bins per query at most. Summed over all pairs they tell in
   which bin the k-th score lies and how many scores lie above; that bin is the
   next range. BINS bins a pass find an exact score of 64 bits in few passes; a
   query is done when its bin is a single score.
2. With the k-th score known, pairs send the scores above it, and of those equal to it
   the k smallest ids; a ranking by score and id gives the answer.

Work grows with queries times candidates, which the task asks for. Traffic
is one copy of the candidates per query block, and k rows per pair and query.

Cases: vectors that are null, or hold null or non-finite components, take no part;
vectors of another length than the query's are not candidates of it; fewer than k candidates give
all; scores must stay below 2^62; repeated vectors are ranked by id; of repeated ids every row is a candidate,
and a query's own row is every row of its id; an empty table gives an empty
result; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyweek.llm.common import written

BINS = 256
# Rows of a block; and the most blocks a small table is dealt into.
QUERY_ROWS, CANDIDATE_ROWS, LEAST_BLOCKS = 512, 4096, 16
# Beyond this the sums could leave double precision; such blocks are multiplied as integers.
_EXACT = float(1 << 53)
# The k-th score where there are fewer than k.
_LEAST = -(1 << 63)


def quantised(vectors: DataFrame, id_col: str, vector_col: str, scale: float) -> DataFrame:
    """(id, dim, v): floor(scale * x) of each usable vector."""
    x = F.transform(F.col(vector_col).cast("array<double>"), lambda c: F.floor(c * F.lit(float(scale))))
    usable = F.forall(F.col(vector_col), lambda c: c.isNotNull() & (F.abs(c.cast("double")) < F.lit(float("inf"))) & ~F.isnan(c.cast("double")))
    return vectors.where(F.col(id_col).isNotNull() & F.coalesce(usable, F.lit(False)) & (F.size(vector_col) > 0)).select(F.col(id_col).cast("long").alias("id"), F.size(vector_col).alias("dim"), x.alias("v"))


def packed(rows: DataFrame, n_blocks: int, rows_per_block: int, kind: str, *more: str) -> DataFrame:
    """(dim, ids, data, more...): rows dealt evenly to blocks of one vector length, each column as one buffer."""
    names = ["dim", "ids", "data", *more]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            dims = b.column("dim").to_numpy()
            for dim in np.unique(dims):
                own = b.filter(pa.array(dims == dim))
                for start in range(0, own.num_rows, rows_per_block):
                    part = own.slice(start, rows_per_block)
                    data = part.column("v").flatten().to_numpy().astype(kind)
                    buffers = [part.column("id").to_numpy(), data, *(part.column(c).to_numpy() for c in more)]
                    yield pa.RecordBatch.from_arrays([pa.array([dim], pa.int32()), *(pa.array([x.tobytes()], pa.binary()) for x in buffers)], names)

    return rows.repartition(n_blocks).mapInArrow(run, "dim int, " + ", ".join(f"{c} binary" for c in names[1:]))


def _pairs(queries: DataFrame, candidates: DataFrame, n_groups: int) -> DataFrame:
    """Every query block beside every candidate block of its vector length."""
    q = queries.withColumn("g", F.explode(F.sequence(F.lit(0), F.lit(n_groups - 1))))
    c = candidates.select("dim", F.pmod(F.xxhash64("ids"), F.lit(n_groups)).cast("int").alias("g"), F.col("ids").alias("c_ids"), F.col("data").alias("c_data"))
    return q.join(c, ["dim", "g"])


def _scored(batches: Iterator[pa.RecordBatch], kind: str) -> Iterator[tuple]:
    """Of each pair of blocks (query ids, rows, low, span, need, candidate ids, scores, which of them count)."""
    for b in batches:
        for i in range(b.num_rows):
            longs = lambda name: np.frombuffer(b.column(name)[i].as_buffer(), np.int64)  # noqa: B023, E731
            dim = b.column("dim")[i].as_py()
            q, c = (np.frombuffer(b.column(name)[i].as_buffer(), kind).reshape(-1, dim) for name in ("data", "c_data"))
            high = lambda x: float(np.abs(x.astype(np.float64)).max(initial=0.0))
            exact = high(q) * high(c) * dim < _EXACT
            scores = (q.astype(np.float64) @ c.T.astype(np.float64)).astype(np.int64) if exact else q.astype(np.int64) @ c.T.astype(np.int64)
            ids, c_ids = longs("ids"), longs("c_ids")
            yield ids, longs("row"), longs("low"), longs("span"), longs("need"), c_ids, scores, ids[:, None] != c_ids[None, :]


def _counted(pairs: DataFrame, kind: str) -> DataFrame:
    """(row, bin, n): of each pair and open query the topmost bins that hold as many scores as are needed."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, row, low, span, need, _, scores, counts in _scored(batches, kind):
            out = [np.empty((3, 0), np.int64)]
            for j in np.flatnonzero(span > 0):
                own = scores[j][counts[j]]
                # Scores above the range have been counted before; those below cannot be the k-th.
                own = own[(own >= low[j]) & (own - low[j] < span[j])]
                n = np.bincount((own - low[j]) // -(-span[j] // BINS), minlength=BINS)[::-1]
                top = np.flatnonzero(n[: int(np.searchsorted(np.cumsum(n), need[j])) + 1])
                out.append(np.array([np.full(len(top), row[j]), BINS - 1 - top, n[top]], np.int64))
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in np.concatenate(out, axis=1)], ["row", "bin", "n"])

    return pairs.mapInArrow(run, "row long, bin long, n long")


def _chosen(pairs: DataFrame, kind: str, k: int) -> DataFrame:
    """(row, query_id, vec_id, score): of each pair the scores above the k-th, and of those equal to it the k smallest ids."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, row, low, _, _, c_ids, scores, counts in _scored(batches, kind):
            out = [np.empty((4, 0), np.int64)]
            for j in range(len(ids)):
                above = np.flatnonzero(counts[j] & (scores[j] > low[j]))
                equal = np.flatnonzero(counts[j] & (scores[j] == low[j]))
                at = np.concatenate([above, equal[np.argsort(c_ids[equal], kind="stable")][:k]])
                out.append(np.array([np.full(len(at), row[j]), np.full(len(at), ids[j]), c_ids[at], scores[j][at]], np.int64))
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in np.concatenate(out, axis=1)], ["row", "query_id", "vec_id", "score"])

    return pairs.mapInArrow(run, "row long, query_id long, vec_id long, score long")


def _narrowed(state: DataFrame, counted: DataFrame) -> DataFrame:
    """The ranges after a pass: the bin that holds the k-th score, or the score itself (span 0)."""
    down = Window.partitionBy("row").orderBy(F.col("bin").desc())
    upto = counted.withColumn("upto", F.sum("n").over(down)).join(state.select("row", "need"), "row")
    at = upto.where((F.col("upto") >= F.col("need")) & (F.col("upto") - F.col("n") < F.col("need")))
    joined = state.join(at.select("row", "bin", (F.col("upto") - F.col("n")).alias("above")), "row", "left")
    found, width = F.col("bin").isNotNull(), F.ceil(F.col("span") / BINS).cast("long")
    low = F.when(found, F.col("low") + F.col("bin") * width).when(F.col("span") > 0, F.lit(_LEAST)).otherwise(F.col("low"))
    span = F.when(found & (width > 1), F.least(width, F.col("span") - F.col("bin") * width)).otherwise(F.lit(0))
    need = F.when(found, F.col("need") - F.col("above")).otherwise(F.col("need"))
    return joined.select("row", low.alias("low"), span.cast("long").alias("span"), need.alias("need"))


def search(vectors: DataFrame, is_query: Column, id_col: str = "vec_id", vector_col: str = "embedding", k: int = 20, scale: float = 64.0, query_rows: int = QUERY_ROWS, candidate_rows: int = CANDIDATE_ROWS) -> DataFrame:
    """(query_id, rank, vec_id, score): of each query row the k best of all other rows by inner product."""
    if k < 1:
        raise ValueError("k must be 1 at least")
    usable = written(quantised(vectors, id_col, vector_col, scale), "quantised")
    asked = quantised(vectors.where(is_query), id_col, vector_col, scale)
    asked = written(asked.withColumn("row", F.monotonically_increasing_id()), "queries")
    highest = F.max(F.array_max(F.transform("v", F.abs)))
    (n, largest), n_queries = usable.agg(F.count("*"), highest).first(), asked.count()
    kind = "<i4" if (largest or 0) < 1 << 31 else "<i8"
    n_blocks, q_blocks = max(LEAST_BLOCKS, -(-n // candidate_rows)), max(1, -(-n_queries // query_rows))
    n_groups = max(LEAST_BLOCKS, n_blocks // 64)
    candidates = written(packed(usable, n_blocks, candidate_rows, kind), "candidates")
    # The first range holds every possible score of a query: its absolute sum times the largest component.
    bound = F.aggregate("v", F.lit(0).cast("long"), lambda a, x: a + F.abs(x)) * F.lit(largest or 0)
    state = written(asked.select("row", (-bound).alias("low"), (2 * bound + 1).alias("span"), F.lit(k).cast("long").alias("need")), "ranges")

    def pairs() -> DataFrame:
        rows = asked.join(state, "row")
        return _pairs(packed(rows, q_blocks, query_rows, kind, "row", "low", "span", "need"), candidates, n_groups)

    while state.where("span > 0").limit(1).count():
        counted = _counted(pairs(), kind).groupBy("row", "bin").agg(F.sum("n").alias("n"))
        state = written(_narrowed(state, counted), "ranges")
    order = Window.partitionBy("row").orderBy(F.col("score").desc(), "vec_id")
    best = _chosen(pairs(), kind, k).withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return best.select("query_id", "rank", "vec_id", "score")
