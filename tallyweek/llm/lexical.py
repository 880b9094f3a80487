"""Ranked lexical search over bit-sliced Bloom signatures, with exact results.

Index. Every document is a column of a Bloom filter of its distinct terms; documents
of like size share a block, and a block is stored by bit: one bitmap of documents for each bit
(a slice). A term's presence in the documents of a block is the AND of its slices, so a
term is never missed, only sometimes seen where it is not. Terms that occur 2, 4, 8
and 16 times or more enter again under that level, so that presence also bounds how often they occur.

Bounds. For each query and document the weights of the terms seen at a level are added
up, level by level, and multiplied by what an occurrence count of that level can
give at most in a document of that length. That sum is never below the score.

Search. (1) The PROBES documents with the highest bounds of each query are scored
exactly; the k-th score is a threshold that the k-th best document reaches. (2) All
documents whose bound reaches the threshold, hence all that are not provably
excluded, are scored exactly from their whole texts, and the best k are kept, first per
task, then per query. Neither a false hit in a filter nor two rows with one key change a result.

Scores are whole numbers: terms are weighted by floor(1000 ln((2N + 2) / (2 df + 1))) and
saturate by document length, see `Scoring`.

Queries are taken in blocks of QUERY_BLOCK, whose terms are broadcast; the index is built
once. Memory of a task is bounded by a block of the index, SLICE_BYTES unless a single document
needs more, and by k or PROBES entries a query.

Cases: terms are runs of digits, letters A-Z without case, and characters beyond
ASCII; null texts and texts without a term score nothing and do not count in N; repeated
rows are documents of their own, equal scores go by id, null ids last; query rows alike in id and text
count once, other rows that share an id are ranked each for itself; queries without a
term find nothing; empty tables give an empty result; other columns are not read.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, Row, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyweek.llm.common import blocks, content_key, held, slices, small, written

NOT_TERM = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
TOP, PROBES, QUERY_BLOCK = 10, 40, 1000
# Bits of a filter for each of its entries, and slices of a term.
BITS_PER_ENTRY, HASHES = 10, 6
# Level l holds the terms that occur 2 ** l times or more.
LEVELS = 5
# Texts that are taken apart together, and bytes of a block of slices.
BATCH_BYTES, SLICE_BYTES, BLOCK_DOCS = 4 << 20, 1 << 20, 1024
_GOLDEN = np.uint64(0x9E3779B97F4A7C15)


@dataclass(frozen=True)
class Scoring:
    """What a term that occurs tf times in a document of n terms is worth, given the corpus.

    tf saturates against a length norm of 25 + 75 n / (mean length), in whole numbers.
    """

    documents: int
    terms: int

    def weight(self, df: int) -> int:
        return math.floor(1000 * math.log((2 * self.documents + 2) / (2 * df + 1)))

    def share(self, tf: np.ndarray, n: np.ndarray) -> np.ndarray:
        tf = tf.astype(np.int64)
        return (1_000_000_000 * tf) // (1000 * tf + 8 * (25 + (75 * n.astype(np.int64) * self.documents) // self.terms))


def term_counts(texts: pa.Array) -> tuple[pa.Array, np.ndarray, np.ndarray, np.ndarray]:
    """(vocabulary, row, term, tf): every distinct term of every text, by row and then by number of the term."""
    parts, of_row = [], []
    for i, text in enumerate(texts):
        data = (text.as_py() or "").encode("utf-8", "surrogatepass")
        for block in blocks(data):
            parts.append(block)
            of_row.append(i)
    lists = pc.split_pattern_regex(pc.ascii_lower(pa.array(parts, pa.binary()).cast(pa.string())), NOT_TERM)
    rows = np.repeat(np.array(of_row, np.int64), np.diff(lists.offsets.to_numpy()))
    flat = lists.flatten()
    filled = pc.not_equal(flat, "")
    coded = flat.filter(filled).dictionary_encode()
    rows, n = rows[filled.to_numpy(zero_copy_only=False).astype(bool)], max(1, len(coded.dictionary))
    entries, tf = np.unique(rows * n + coded.indices.to_numpy().astype(np.int64), return_counts=True)
    return coded.dictionary, entries // n, entries % n, tf


def _hashes(terms: list[str]) -> np.ndarray:
    return np.fromiter((xxhash.xxh3_64_intdigest(t) for t in terms), np.uint64, len(terms))


def _positions(hashes: np.ndarray, level: int, bits: int) -> np.ndarray:
    """The slices (one row of HASHES numbers each) of terms at a level."""
    h = (hashes ^ np.uint64((level + 1) * 0x9E3779B97F4A7C15 % (1 << 64))) * _GOLDEN
    h ^= h >> np.uint64(29)
    h *= np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(32)
    step = (h >> np.uint64(32)) | np.uint64(1)
    at = (h & np.uint64(0xFFFFFFFF))[:, None] + step[:, None] * np.arange(HASHES, dtype=np.uint64)
    return (at % np.uint64(bits)).astype(np.int64)


def _size_class(entries: int) -> int:
    """Bits of the filter of a document with that many entries: it is filled to between 71 % and 100 % of its design."""
    return int(BITS_PER_ENTRY * 2 ** (math.ceil(2 * math.log2(max(8, entries))) / 2))


class _Block:
    """A block of the index while it is being filled."""

    def __init__(self, bits: int):
        self.bits, self.docs = bits, max(8, min(BLOCK_DOCS, SLICE_BYTES * 8 // bits // 8 * 8))
        self.slices = np.zeros((bits, self.docs // 8), np.uint8)
        self.keys: list[int] = []
        self.lengths: list[int] = []

    def add(self, key: int, n: int, positions: np.ndarray) -> bool:
        at = len(self.keys)
        self.slices[positions, at >> 3] |= np.uint8(128 >> (at & 7))
        self.keys.append(key)
        self.lengths.append(n)
        return len(self.keys) == self.docs

    def batch(self) -> pa.RecordBatch:
        width = (len(self.keys) + 7) // 8
        data = np.ascontiguousarray(self.slices[:, :width]).tobytes()
        values = [pa.array([x], t) for x, t in ((self.bits, pa.int64()), (self.keys, pa.list_(pa.int64())), (self.lengths, pa.list_(pa.int64())), (data, pa.binary()))]
        return pa.RecordBatch.from_arrays(values, ["bits", "keys", "lengths", "slices"])


def build_index(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(bits, keys, lengths, slices): blocks of documents that have a term, by row key, with their lengths in terms."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held("lexical", dict)
        filling: dict[int, _Block] = {}
        for b in batches:
            for part in slices(b, 1, BATCH_BYTES):
                vocabulary, rows, terms, tf = term_counts(part.column(1))
                hashes = _hashes(vocabulary.to_pylist())
                keys = part.column(0).to_pylist()
                starts = np.searchsorted(rows, np.arange(len(keys) + 1))
                for key, i, j in zip(keys, starts[:-1].tolist(), starts[1:].tolist()):
                    if i == j:
                        continue
                    own, times = hashes[terms[i:j]], tf[i:j]
                    levels = [own[times >= 1 << level] for level in range(LEVELS)]
                    bits = _size_class(sum(map(len, levels)))
                    block = filling.setdefault(bits, _Block(bits))
                    positions = np.concatenate([_positions(h, level, bits).ravel() for level, h in enumerate(levels)])
                    if block.add(key, int(times.sum()), positions):
                        yield filling.pop(bits).batch()
        for block in filling.values():
            yield block.batch()

    read = docs.select(content_key(id_col, text_col).alias("key"), F.col(text_col).alias("text"))
    return read.mapInArrow(run, "bits long, keys array<long>, lengths array<long>, slices binary")


def document_frequencies(docs: DataFrame, terms: list[str], text_col: str = "text") -> tuple[Scoring, dict[str, int]]:
    """The corpus's size, and how many documents hold each of the given terms."""
    shared = docs.sparkSession.sparkContext.broadcast(terms)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held("lexical", dict)
        wanted = pa.array(shared.value, pa.string())
        found, total = np.zeros(len(wanted) + 1, np.int64), 0
        for b in batches:
            for part in slices(b, 0, BATCH_BYTES):
                vocabulary, rows, terms, tf = term_counts(part.column(0))
                at = pc.fill_null(pc.index_in(vocabulary, wanted), -1).to_numpy()[terms]
                found[:-1] += np.bincount(at[at >= 0], minlength=len(wanted))
                found[-1] += len(np.unique(rows))
                total += int(tf.sum())
        at = np.append(np.flatnonzero(found), -1)
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int64()), pa.array(np.append(found[at[:-1]], total), pa.int64())], ["at", "n"])

    counts = docs.select(F.col(text_col).alias("text")).mapInArrow(run, "at long, n long").groupBy("at").agg(F.sum("n").alias("n"))
    n = {r["at"]: r["n"] for r in counts.collect()}  # no more rows than terms were asked for
    return Scoring(n.get(len(terms), 0), n.get(-1, 0)), {t: n.get(i, 0) for i, t in enumerate(terms)}


@dataclass(frozen=True)
class Queries:
    """Queries as rows of weighted terms: for each query the numbers of its terms and what each adds."""

    scoring: Scoring
    terms: list[str]
    starts: np.ndarray
    term: np.ndarray
    weight: np.ndarray

    def bounds(self, bits: int, lengths: np.ndarray, data: bytes, hashes: np.ndarray) -> np.ndarray:
        """(queries, documents): no document's score is above its bound."""
        stored = np.frombuffer(data, np.uint8).reshape(bits, -1)
        out = np.zeros((len(self.starts) - 1, len(lengths)))
        alive, seen, below = np.arange(len(self.terms)), None, 0
        for level in range(LEVELS):
            masks = np.bitwise_and.reduce(stored[_positions(hashes[alive], level, bits)], axis=1)
            if seen is not None:
                masks &= seen
            some = masks.any(axis=1)
            alive, seen = alive[some], masks[some]
            if not len(alive):
                break
            present = np.unpackbits(seen, axis=1, count=len(lengths)).astype(np.float64)
            most = np.minimum(lengths, (2 << level) - 1) if level + 1 < LEVELS else lengths
            share = self.scoring.share(most, lengths)
            row = np.full(len(self.terms), -1)
            row[alive] = np.arange(len(alive))
            row = row[self.term]
            for q, (i, j) in enumerate(zip(self.starts[:-1].tolist(), self.starts[1:].tolist())):
                held_here = row[i:j] >= 0
                if held_here.any():
                    out[q] += (self.weight[i:j][held_here] @ present[row[i:j][held_here]]) * (share - below)
            below = share
        return out

    def scores(self, n: int, counts: np.ndarray, asked: np.ndarray) -> list[int]:
        """The exact scores of a document of n terms for the queries asked, given its counts of all terms."""
        share = self.scoring.share(counts, np.int64(n))
        return [int(self.weight[i:j] @ share[self.term[i:j]]) for i, j in zip(self.starts[asked], self.starts[asked + 1])]


def make_queries(docs: DataFrame, texts: list[str | None], text_col: str = "text") -> Queries:
    """The texts as queries on these documents."""
    vocabulary, rows, terms, times = term_counts(pa.array(texts, pa.string()))
    terms_of = vocabulary.to_pylist()
    scoring, df = document_frequencies(docs, terms_of, text_col)
    weight = np.array([scoring.weight(df[t]) if df[t] else 0 for t in terms_of], np.int64)
    return Queries(scoring, terms_of, np.searchsorted(rows, np.arange(len(texts) + 1)), terms, weight[terms] * times)


def _scan(index: DataFrame, queries: Queries, thresholds: np.ndarray | None) -> DataFrame:
    """(key, query, bound): without thresholds the PROBES best bounds of each query and task, else all that reach their query's threshold."""
    shared = index.sparkSession.sparkContext.broadcast((queries, thresholds))

    def pairs(key: np.ndarray, query: np.ndarray, bound: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(key, pa.int64()), pa.array(query, pa.int32()), pa.array(bound, pa.float64())], ["key", "query", "bound"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held("lexical", dict)
        of, limits = shared.value
        hashes, n = _hashes(of.terms), len(of.starts) - 1
        best, best_keys = np.zeros((n, 0)), np.zeros((n, 0), np.int64)
        for b in batches:
            for i in range(b.num_rows):
                bits, keys, lengths, data = (b.column(c)[i] for c in range(4))
                keys = np.array(keys.as_py(), np.int64)
                bound = of.bounds(bits.as_py(), np.array(lengths.as_py(), np.int64), data.as_buffer(), hashes)
                if limits is not None:
                    query, at = np.nonzero(bound >= limits[:, None])
                    yield pairs(keys[at], query, bound[query, at])
                    continue
                best = np.concatenate([best, bound], axis=1)
                best_keys = np.concatenate([best_keys, np.broadcast_to(keys, bound.shape)], axis=1)
                if best.shape[1] > PROBES:
                    top = np.argpartition(-best, PROBES - 1, axis=1)[:, :PROBES]
                    best, best_keys = np.take_along_axis(best, top, 1), np.take_along_axis(best_keys, top, 1)
        if limits is None:
            query, at = np.nonzero(best > 0)
            yield pairs(best_keys[query, at], query, best[query, at])

    return index.mapInArrow(run, "key long, query int, bound double")


def _scored(docs: DataFrame, asked: DataFrame, queries: Queries, k: int, id_col: str, text_col: str) -> DataFrame:
    """(query, doc_id, score): the best k documents of each query and task among (key, queries), scored exactly."""
    shared = docs.sparkSession.sparkContext.broadcast(queries)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held("lexical", dict)
        of = shared.value
        wanted = pa.array(of.terms, pa.string())
        best: dict[int, list[tuple]] = {}
        for b in batches:
            for part in slices(b, 1, BATCH_BYTES):
                vocabulary, rows, terms, tf = term_counts(part.column(1))
                number = pc.fill_null(pc.index_in(vocabulary, wanted), -1).to_numpy()
                starts = np.searchsorted(rows, np.arange(part.num_rows + 1)).tolist()
                for at in range(part.num_rows):
                    i, j = starts[at], starts[at + 1]
                    own, times = number[terms[i:j]], tf[i:j]
                    counts = np.zeros(len(wanted), np.int64)
                    counts[own[own >= 0]] = times[own >= 0]
                    doc_id = part.column(0)[at].as_py()
                    ask = np.unique(np.array([q for qs in part.column(2)[at].as_py() for q in qs], np.int64))
                    for q, score in zip(ask.tolist(), of.scores(int(times.sum()), counts, ask)):
                        if score > 0:
                            kept = best.setdefault(q, [])
                            kept.append((-score, doc_id is None, doc_id))
                            if len(kept) >= 8 * k:
                                kept[:] = sorted(kept)[:k]
        found = [(q, *entry) for q, kept in best.items() for entry in sorted(kept)[:k]]
        columns = [pa.array([f[0] for f in found], pa.int32()), pa.array([f[3] for f in found], pa.int64()), pa.array([-f[1] for f in found], pa.int64())]
        yield pa.RecordBatch.from_arrays(columns, ["query", "doc_id", "score"])

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"), content_key(id_col, text_col).alias("key"))
    return rows.join(asked, "key").select("doc_id", "text", "queries").mapInArrow(run, "query int, doc_id long, score long")


def _best(rows: DataFrame, k: int, *order) -> DataFrame:
    """The first k rows of each query, of which each task has brought few, with their rank."""
    return rows.withColumn("rank", F.row_number().over(Window.partitionBy("query").orderBy(*order))).where(F.col("rank") <= k)


def _by_key(pairs: DataFrame) -> DataFrame:
    """(key, queries): rows alike in id and text share a key and have the same queries, which one set holds once."""
    sets = pairs.groupBy("key", "query").agg(F.max("bound").alias("bound")).groupBy("key").agg(F.collect_list("query").alias("each"))
    return sets.select("key", F.array("each").alias("queries"))


def search(docs: DataFrame, items: DataFrame, k: int = TOP, id_col: str = "doc_id", text_col: str = "text", item_id: str = "item_id", item_text: str = "text", probes: int = PROBES) -> DataFrame:
    """(item_id, rank, doc_id, score): each item's k best documents with a score above 0."""
    spark = docs.sparkSession
    kind = items.schema[item_id].dataType
    schema = T.StructType([T.StructField("query", T.IntegerType()), T.StructField("item_id", kind)])
    index = written(build_index(docs, id_col, text_col), "lexical_index")
    found = None
    for ids, texts in query_blocks(items, item_id, item_text):
        ranked = _search_block(docs, index, texts, k, probes, id_col, text_col)
        names = spark.createDataFrame([Row(query=i, item_id=x) for i, x in enumerate(ids)], schema)
        block = ranked.join(F.broadcast(names), "query").select("item_id", F.col("rank").cast("int").alias("rank"), "doc_id", "score")
        found = block if found is None else found.union(block)
    if found is None:
        return spark.createDataFrame([], T.StructType([T.StructField("item_id", kind), *T.StructType.fromDDL("rank int, doc_id long, score long")]))
    return found


def query_blocks(items: DataFrame, item_id: str, item_text: str, size: int = QUERY_BLOCK) -> Iterator[tuple[list, list]]:
    """The distinct queries, `size` at a time; the driver never holds more."""
    ids: list = []
    texts: list = []
    for row in items.select(F.col(item_id).alias("i"), F.col(item_text).alias("t")).distinct().toLocalIterator():
        ids.append(row["i"])
        texts.append(row["t"])
        if len(ids) == size:
            yield ids, texts
            ids, texts = [], []
    if ids:
        yield ids, texts


def _search_block(docs: DataFrame, index: DataFrame, texts: list[str | None], k: int, probes: int, id_col: str, text_col: str) -> DataFrame:
    queries = make_queries(docs, texts, text_col)
    if not queries.scoring.terms or not queries.terms:
        return docs.sparkSession.createDataFrame([], "query int, doc_id long, score long, rank int")
    probed = _best(_scan(index, queries, None), probes, F.desc("bound"), "key")
    first = _scored(docs, small(written(_by_key(probed), "probes")), queries, k, id_col, text_col)
    reached = _best(first, k, F.desc("score")).where(F.col("rank") == k).collect()  # one row a query
    thresholds = np.ones(len(texts))
    for row in reached:
        thresholds[row["query"]] = row["score"]
    asked = written(_by_key(_scan(index, queries, thresholds)), "candidates")
    return written(_best(_scored(docs, asked, queries, k, id_col, text_col), k, F.desc("score"), F.asc_nulls_last("doc_id")), "ranked")
