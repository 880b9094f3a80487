"""SimHash near-duplicates: fingerprints of word shingles, linked within a bit distance.

Links come from an inverted index over byte positions. Two fingerprints of eight
bytes that differ in at most d bits agree in at least 8 - d byte positions. The index has
a posting list for each choice of POSITIONS of them and the bytes there. How often
a pair meets is tallied; a near pair meets in C(8 - d, POSITIONS) lists at least (15 for
two bits and four positions), so pairs with fewer meetings are dropped and the others are verified bit by bit.

Lists over single positions would hold 1/256 of all fingerprints each, which grows
with the square of the input. A list that is long all the same (a ball of near copies, or
bytes that many texts have) is never gathered: its members are
linked in linear work instead of by pairs, as fingerprints at most two bits apart are
those that share a neighbour at most one bit away. A pair that shares no such list
has all its meetings in short ones, so its tally is whole.

Cases: null or wordless texts have fingerprint zero, linked like any other; fewer
words than the width make one shingle; repeated rows and equal texts share a
fingerprint; null ids never name a component unless it has no other id; an empty
table gives an empty result; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations
from math import comb

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyweek.llm.common import blocks, components, content_key, free_name, held, small, written

BYTES, POSITIONS = 8, 4
# Beyond this length a posting list is linked by shared neighbours.
LONG_LIST = 8
_BITS = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1, bitorder="little").astype(np.int64)


def fingerprint(text: str | None, width: int = 3, seed: int = 42) -> int:
    """Signed 64 bits: each is set if it is set in over half of the shingle hashes."""
    tail: list[bytes] = []
    ones, total, rest = np.zeros((BYTES, 256), np.int64), 0, b""
    for block in blocks((text or "").encode("utf-8", "surrogatepass").lower()):
        tokens = tail + block.split()
        grams = [b" ".join(g) for g in zip(*(tokens[i:] for i in range(width)))]
        if grams:
            hashes = np.fromiter((xxhash.xxh64_intdigest(g, seed) for g in grams), np.uint64, len(grams))
            places = hashes.view(np.uint8).reshape(-1, BYTES) + (np.arange(BYTES, dtype=np.int64) << 8)
            ones += np.bincount(places.ravel(), minlength=256 * BYTES).reshape(BYTES, 256)
            total += len(grams)
        tail = tokens[-(width - 1) :] if width > 1 else []
        rest = b" ".join(tokens) if not total else b""
    if not total:
        return int(np.uint64(xxhash.xxh64_intdigest(rest, seed)).astype(np.int64)) if rest else 0
    bits = (ones @ _BITS).ravel() * 2 > total
    return int(np.packbits(bits, bitorder="little").view("<i8")[0])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 3, seed: int = 42) -> DataFrame:
    """(id, row_key, fp) of every row; row_key is a hash of id and text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held("simhash", dict)
        for b in batches:
            found = [fingerprint(t.as_py(), width, seed) for t in b.column(2)]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(found, pa.int64())], ["id", "row_key", "fp"])

    read = docs.select(F.col(id_col).cast("long").alias("id"), content_key(id_col, text_col).alias("row_key"), F.col(text_col).alias("text"))
    return read.mapInArrow(run, "id long, row_key long, fp long")


def met_pairs(short: DataFrame, max_bits: int, positions: int = POSITIONS) -> DataFrame:
    """(a, b), a > b, that meet in as many of the gathered lists as near pairs are bound to."""
    pairs = short.select("fps", F.explode("fps").alias("a")).select("a", F.explode("fps").alias("b")).where("a > b")
    return pairs.groupBy("a", "b").agg(F.count("*").alias("met")).where(F.col("met") >= comb(BYTES - max_bits, positions)).select("a", "b")


def links(distinct_fps: DataFrame, max_bits: int = 2, long_list: int = LONG_LIST, positions: int = POSITIONS) -> DataFrame:
    """Edges (a, b), a > b, whose components are those of all pairs within `max_bits` (1 or 2) bits."""
    if max_bits not in (1, 2) or not 1 <= positions <= BYTES - max_bits:
        raise ValueError("max_bits must be 1 or 2, positions at most 8 less max_bits")
    masks = [sum(0xFF << 8 * i for i in kept) for kept in combinations(range(BYTES), positions)]
    keys = [F.col("fp").bitwiseAND(F.lit(int(np.uint64(m).astype(np.int64)))) for m in masks]
    postings = distinct_fps.select("fp", F.posexplode(F.array(*keys)).alias("positions", "shared"))
    key = ["positions", "shared"]
    # Nearly all lists have one member and link nothing; only the keys of the others are looked up again.
    shared = written(postings.groupBy(*key).agg(F.count("*").alias("n")).where("n > 1"), "shared_lists")
    long = shared.where(F.col("n") > long_list).select(*key)
    few = shared.where(F.col("n") <= long_list).select(*key)
    # These lists hold at most long_list fingerprints each.
    short = postings.join(small(few), key, "left_semi").groupBy(*key).agg(F.collect_list("fp").alias("fps"))
    near = F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= max_bits
    verified = met_pairs(short, max_bits, positions).where(near)

    flips = [F.col("fp").bitwiseXOR(F.lit(int(np.uint64(1 << i).astype(np.int64)))) for i in range(8 * BYTES)]
    if max_bits == 2:  # what two share is a neighbour
        around_fp = F.array(F.col("fp"), *flips)
    else:  # what two share is the edge between them
        around_fp = F.array(*[F.struct(F.least("fp", f).alias("lo"), F.greatest("fp", f).alias("hi")) for f in flips])
    members = written(postings.join(small(long), key, "left_semi").select("fp").distinct(), "members")
    around = members.select("fp", F.explode(around_fp).alias("z"))
    centres = around.groupBy("z").agg(F.min("fp").alias("b"))
    far = around.join(centres, "z").where("fp != b").select(F.col("fp").alias("a"), "b")
    return written(verified.union(far).distinct(), "links")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 3, max_bits: int = 2, seed: int = 42) -> DataFrame:
    """(id, row_key, fp, root, component_id) of every row.

    root tells components apart: it is the smallest fingerprint in one. component_id is its
    smallest id, a label that components share where ids are null or repeated.
    """
    rows = written(fingerprints(docs, id_col, text_col, width, seed), "fingerprints")
    fps = written(rows.groupBy("fp").agg(F.min("id").alias("first_id")), "distinct_fps")
    nodes = components(links(fps.select("fp"), max_bits))
    rooted = fps.join(nodes.withColumnRenamed("node", "fp"), "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    roots = rooted.groupBy("root").agg(F.min("first_id").alias("component_id"))
    named = written(rooted.join(roots, "root").select("fp", "root", "component_id"), "components")
    return rows.join(named, "fp").select("id", "row_key", "fp", "root", "component_id")


def fingerprint_hex(fp: str = "fp"):
    return F.lower(F.lpad(F.hex(fp), 16, "0"))


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 3, max_bits: int = 2) -> DataFrame:
    """The rows of `docs`, one of each component: that with the smallest id (and row key, among equals)."""
    found = near_duplicates(docs, id_col, text_col, width, max_bits)
    first = F.min(F.struct(F.col("id").isNull(), "id", "row_key")).alias("first")
    keep = written(found.groupBy("root").agg(first).select("first.row_key"), "kept")
    key = free_name(docs, "_row_key")
    kept = docs.withColumn(key, content_key(id_col, text_col)).join(keep.select(F.col("row_key").alias(key)), key, "left_semi")
    # Rows repeated with id and text alike share a key; of those one stays.
    return (kept.dropDuplicates([key]) if _repeats(found) else kept).select(docs.columns)


def _repeats(found: DataFrame) -> bool:
    rows, keys = found.agg(F.count("*"), F.countDistinct("row_key")).first()
    return rows > keys
