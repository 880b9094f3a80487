"""Benchmark decontamination: items found inside documents by MinHash containment.

A document contains an item if at least 80 % of the item's distinct five-word
shingles occur in it. The search takes the items by size. Items of a size class
(up to u shingles) are represented by their k smallest hash values, where
k = floor(0.2 u) + 1: a document that has 80 % of an item's shingles lacks at
most k - 1 of them, so it has one of the k. That holds for any k of them, so shingles that
few items hold (counted by powers of two) come before those of many, and hashes decide among the rest: an
opening that thousands of items share does not make them all candidates. A document's shingles are looked up
among these minima; each (document, item) met is a candidate, and no document that
contains an item is missed, however long it is. Banded signatures of the documents
would miss nearly all: an item of 30 shingles inside 20,000 has Jaccard 0.0015.

Candidates are then verified: the shared shingles are counted exactly, words
compared as text.

Everything is DataFrame expressions. Explicit broadcasts are of written tables of
at most BROADCAST_ROWS rows; larger item sets are joined by shuffle.

Cases: words are runs of digits, letters and characters beyond ASCII, in lower
case; null or wordless texts have no shingles; an item of fewer than five words has
one shingle, its whole word sequence, and documents are read at that width too; rows of documents
or items that are alike in id and text count as one; items are told apart by id and text, so that
ids may be null or repeated; empty tables give an empty result; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyweek.llm.common import content_key, free_name, small, words, written

WIDTH, SHARE = 5, 0.8


def _grams(tokens: Column, width: int, fields: int) -> Column:
    """Every run of `width` words as a struct of `fields` words, the last ones empty."""
    n = F.greatest(F.size(tokens) - width + 1, F.lit(0))
    parts = [F.slice(tokens, i + 1, n) if i < width else F.array_repeat(F.lit(""), n) for i in range(fields)]
    return F.arrays_zip(*[part.alias(f"w{i}") for i, part in enumerate(parts)])


def _words(text_col: str) -> Column:
    return words(F.lower(F.coalesce(F.col(text_col), F.lit(""))))


def _hashed(each: DataFrame, width: int) -> DataFrame:
    return each.withColumn("h", F.xxhash64(*[f"gram.w{i}" for i in range(width)]))


def shingles(rows: DataFrame, text_col: str, width: int, widths: Sequence[int], *keep: str) -> DataFrame:
    """(keep..., gram, h): every run of `widths` words each."""
    tokens = _words(text_col)
    return _hashed(rows.select(*keep, F.explode(F.concat(*[_grams(tokens, w, width) for w in widths])).alias("gram")), width)


def item_shingles(items: DataFrame, id_col: str, text_col: str, width: int, share: float) -> DataFrame:
    """(item_key, item_id, n, width, gram, h, is_minimum) of every item's distinct shingles; item_key is a hash of id and text."""
    rows = items.select(content_key(id_col, text_col).alias("item_key"), F.col(id_col).alias("item_id"), _words(text_col).alias("words")).where(F.size("words") > 0)
    grams = F.lit(None)
    for w in range(1, width + 1):
        at_width = F.size("words") == w if w < width else F.size("words") >= w
        grams = F.when(at_width, _grams(F.col("words"), w, width)) if w == 1 else grams.when(at_width, _grams(F.col("words"), w, width))
    each = rows.select("item_key", "item_id", F.least(F.size("words"), F.lit(width)).alias("width"), F.explode(grams).alias("gram"))
    each = written(_hashed(each.distinct(), width), "item_grams")
    held_by = each.groupBy("h").agg(F.floor(F.log2(F.count("*").cast("double"))).alias("held_by"))
    of = Window.partitionBy("item_key")
    # The size class is the power of two above n; its bound gives the number of minima.
    missing = F.floor((1 - F.lit(share)) * (F.pow(2.0, F.floor(F.log2("n")) + 1) - 1) + 1e-9)
    ranked = each.join(held_by, "h").withColumn("n", F.count("*").over(of)).withColumn("rank", F.row_number().over(of.orderBy("held_by", F.xxhash64("h"), "h", "gram")))
    return ranked.select("item_key", "item_id", "n", "width", "gram", "h", (F.col("rank") <= missing + 1).alias("is_minimum"))


def by_passage(items: DataFrame, item_text: str = "text") -> DataFrame:
    """(item_id, text) of every row of `items`, with a hash of the text as id: no passage is left out or merged with another."""
    return items.select(content_key(item_text).alias("item_id"), F.col(item_text).alias("text"))


def contained_items(docs: DataFrame, items: DataFrame, doc_id: str = "doc_id", doc_text: str = "text", item_id: str = "item_id", item_text: str = "text", width: int = WIDTH, share: float = SHARE) -> DataFrame:
    """(doc_key, doc_id, item_id, n_shingles, n_shared, containment) of every document and item it contains.

    doc_key is a hash of id and text; rows alike in both are counted once.
    """
    wanted = written(item_shingles(items, item_id, item_text, width, share), "item_shingles")
    minima = written(wanted.where("is_minimum").select("h", "item_key").distinct(), "item_minima")
    # At most `width` numbers.
    widths = sorted(r.width for r in wanted.select("width").distinct().collect()) or [width]
    texts = docs.select(F.col(doc_id).alias("doc_id"), F.col(doc_text).alias("text"), content_key(doc_id, doc_text).alias("doc_key"))

    looked_up = shingles(texts, "text", width, widths, "doc_key").select("doc_key", "h")
    met = written(looked_up.join(small(minima), "h").select("doc_key", "item_key").distinct(), "candidates")
    of_docs = written(met.select("doc_key").distinct(), "candidate_docs")
    rows = texts.join(small(of_docs), "doc_key", "left_semi").dropDuplicates(["doc_key"])
    grams = shingles(rows, "text", width, widths, "doc_key", "doc_id")
    of_items = wanted.select("h", "gram", "item_key", "item_id", "n")
    shared = grams.join(small(of_items), ["h", "gram"]).groupBy("doc_key", "doc_id", "item_key", "item_id", "n").agg(F.countDistinct("gram").alias("n_shared"))
    found = shared.join(met, ["doc_key", "item_key"], "left_semi").where(F.col("n_shared") >= F.lit(share) * F.col("n") - 1e-9)
    return found.select("doc_key", "doc_id", "item_id", F.col("n").alias("n_shingles"), "n_shared", (F.col("n_shared") / F.col("n")).alias("containment"))


def clean(docs: DataFrame, items: DataFrame, doc_id: str = "doc_id", doc_text: str = "text", **options) -> DataFrame:
    """The rows of `docs` that contain no item."""
    key = free_name(docs, "_doc_key")
    bad = written(contained_items(docs, items, doc_id, doc_text, **options).select(F.col("doc_key").alias(key)).distinct(), "contaminated")
    return docs.withColumn(key, content_key(doc_id, doc_text)).join(small(bad), key, "left_anti").select(docs.columns)
