"""Removal of byte strings that occur more than once in a corpus, by prefix-free parsing.

A byte goes if a string of `length` bytes that covers it also starts anywhere else.

Parse. A position is a trigger if the rolling hash of the 8 bytes there is the
smallest within `reach` positions on both sides. Triggers depend on nothing
but the bytes around them, so equal strings have equal triggers inside. They cut a
text into phrases of some 2 * reach bytes. All strings that have the same first
trigger in common start within one phrase: a unit. A unit is known by two hashes:
its core, the 3/8 length bytes from the trigger on, which lie in each of its
strings, and its cover, all bytes from its first string's start to its last one's
end.

Dictionary. Units are grouped by core and cover, which are the dictionary of
distinct phrases and their counts in the parse. (1) A core that occurs once: none of the
unit's strings occurs elsewhere. (2) A cover that occurs again: all do. (3) Else, only
phrase suffixes of covers whose core is shared are looked at, once for each distinct
cover: first STEP starts together, by the same three cases, then those still open
one by one. This touches a few phrases at the edges of each repeat.

The order of the corpus's suffixes is never written out: 8 bytes for each byte of
text is many times the input, and which strings are equal follows from the
classes alone. Strings without a trigger in the first 5/8
are units of their own, known by all their bytes. All keys are hashes of 128 bits
together.

Groups are only counted, never gathered; what is gathered per document is bounded
by its own length.

Cases: null counts as empty; texts shorter than `length` have no such string;
overlapping repeats count, in one document too; repeated rows are repeats of each
other and each gets its row; an empty table gives an empty result; other columns
are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence
from itertools import islice

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyweek.llm.common import content_key, discard, free_name, held, written

LENGTH = 400
WIDTH = 8
# Starts of a unit that are looked at together where its cover is not repeated.
STEP = 8
# Units that a task holds before it hands them on, however long a text is.
UNITS_HELD = 50_000
_MIX = np.uint64(0x9E3779B97F4A7C15)
_BLOCK = 1 << 20


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def triggers(data: bytes, reach: int) -> np.ndarray:
    """Positions whose 8-byte hash is not above those of the `reach` positions before and after."""
    found = []
    # Blocks overlap by what a trigger depends on, so that memory is bounded for any text.
    for start in range(0, len(data), _BLOCK):
        part = data[start : start + _BLOCK + 2 * reach + WIDTH]
        n = len(part) - WIDTH + 1
        if n <= 2 * reach:
            break
        raw = np.ndarray((n,), "<u8", part, strides=(1,))
        h = raw * _MIX
        h = ((h ^ (h >> np.uint64(29))) * _MIX >> np.uint64(32)).astype(np.uint32)
        low, width = h, 1  # low[i] = min(h[i : i + width])
        while 2 * width <= reach:
            low = np.minimum(low[:-width], low[width:])
            width *= 2
        if width < reach:
            low = np.minimum(low[: len(low) - (reach - width)], low[reach - width :])
        centre = h[reach : n - reach]
        is_one = (centre <= low[: len(centre)]) & (centre <= low[reach + 1 : reach + 1 + len(centre)])
        at = np.flatnonzero(is_one) + (start + reach)
        found.append(at[at < start + reach + _BLOCK])
    return np.concatenate(found) if found else np.empty(0, np.int64)


def units(data: bytes, length: int = LENGTH) -> Iterator[tuple[int, int, int, int]]:
    """(first start, number of starts, core, cover) of every unit of a text; the last start can lie beyond the last string's."""
    if length < 32:
        raise ValueError("length must be 32 at least")
    last, reach, core = len(data) - length, length // 10, length * 3 // 8
    if last < 0:
        return
    view, xxh = memoryview(data), xxhash.xxh3_64_intdigest
    at = triggers(data, reach)
    at = np.append(at[at - reach <= last + length], len(data) + length)
    lows = np.maximum(np.append(0, at[:-1] - reach + 1), 0)
    highs = np.minimum(at - reach, last)
    firsts = np.maximum(lows, at - (length - core))
    # A text of equal bytes has as many triggers as bytes, so they become Python numbers by blocks.
    for i in range(0, len(at), _BLOCK >> 4):
        block = (column[i : i + (_BLOCK >> 4)].tolist() for column in (at, lows, firsts, highs))
        for t, low, first, high in zip(*block):
            for s in range(low, min(first, high + 1)):
                bare = view[s : s + length]
                yield s, 1, _signed(xxh(bare, 1)), _signed(xxh(bare, 2))
            if first <= high:
                yield first, t - reach - first + 1, _signed(xxh(view[t : t + core])), _signed(xxh(view[first : high + length]))


def _texts(docs: DataFrame, id_col: str, text_col: str, *more: Column) -> DataFrame:
    return docs.select(*more, content_key(id_col, text_col).alias("doc_key"), F.encode(F.coalesce(F.col(text_col), F.lit("")), "UTF-8").alias("data"))


def _units_of(texts: DataFrame, length: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held("substrings", dict)
        for b in batches:
            keys, rows = [], []
            for key, data in zip(b.column(0), b.column(1)):
                key, found = key.as_py(), units(data.as_py(), length)
                while some := list(islice(found, UNITS_HELD)):
                    rows.extend(some)
                    keys.extend([key] * len(some))
                    if len(rows) >= UNITS_HELD:
                        yield batch(keys, rows)
                        keys, rows = [], []
            yield batch(keys, rows)

    def batch(keys, rows):
        table = np.array(rows, np.int64).reshape(-1, 4)
        return pa.RecordBatch.from_arrays(
            [pa.array(keys, pa.int64()), pa.array(table[:, 0].astype(np.int32)), pa.array(table[:, 1].astype(np.int32)), pa.array(table[:, 2]), pa.array(table[:, 3])],
            ["doc_key", "first", "starts", "core", "cover"],
        )

    return texts.mapInArrow(run, "doc_key long, first int, starts int, core long, cover long")


def _parts_of(texts: DataFrame, wanted: DataFrame, length: int) -> DataFrame:
    """The wanted units in parts of STEP starts, counted from the trigger: (core, cover, unit, doc_key, first, strings).

    core: a hash of the bytes that all strings of a part have; cover: of all its bytes; strings: of each of its strings.
    """
    per_doc = wanted.groupBy("doc_key").agg(F.collect_list(F.struct("first", "starts", "unit")).alias("units"))
    reach = length // 10
    schema = "core long, cover long, unit long, doc_key long, first int, n int, strings binary"
    names = [field.split()[0] for field in schema.split(", ")]

    def parts(key: int, data: memoryview, units: list[dict]) -> Iterator[tuple]:
        xxh, final = xxhash.xxh3_64_intdigest, len(data) - length
        for u in units:
            low, high = u["first"], min(u["first"] + u["starts"] - 1, final)
            t = u["first"] + u["starts"] - 1 + reach
            for i in range((t - high) // STEP, (t - low) // STEP + 1):
                a, b = t - i * STEP - STEP + 1, t - i * STEP  # the part's first and last start if nothing limits it
                core = xxh(data[b : a + length])
                a, b = max(a, low), min(b, high)
                strings = np.fromiter((xxh(data[s : s + length], core) for s in range(a, b + 1)), np.uint64, b - a + 1)
                yield _signed(core), _signed(xxh(data[a : b + length])), u["unit"], key, a, b - a + 1, strings.tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows: list[tuple] = []
            for key, data, found in zip(b.column(0), b.column(1), b.column(2)):
                rows.extend(parts(key.as_py(), memoryview(data.as_buffer()), found.as_py()))
                if len(rows) > 20_000:
                    yield batch(rows)
                    rows = []
            yield batch(rows)

    def batch(rows: list[tuple]) -> pa.RecordBatch:
        columns = list(zip(*rows)) or [[]] * 7
        kinds = [pa.int64()] * 4 + [pa.int32()] * 2 + [pa.binary()]
        return pa.RecordBatch.from_arrays([pa.array(c, kind) for c, kind in zip(columns, kinds)], names)

    return texts.join(per_doc, "doc_key").mapInArrow(run, schema)


def _strings_of(parts: DataFrame) -> DataFrame:
    """(string, unit, doc_key, start) of every string of the parts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            n = b.column("n").to_numpy()
            joined = b"".join(b.column("strings").to_pylist())
            starts = np.arange(len(joined) // 8, dtype=np.int64) + np.repeat(b.column("first").to_numpy() - (np.cumsum(n) - n), n)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.frombuffer(joined, np.int64)), *(pa.array(np.repeat(b.column(c).to_numpy(), n)) for c in ("unit", "doc_key")), pa.array(starts.astype(np.int32))],
                ["string", "unit", "doc_key", "start"],
            )

    return parts.select("strings", "n", "unit", "doc_key", "first").mapInArrow(run, "string long, unit long, doc_key long, start int")


def repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH) -> DataFrame:
    """(doc_key, starts): per document runs of starts whose strings occur elsewhere, as first, last, first, ...; none, no row.

    doc_key is a hash of id and text; a last start can lie beyond the last string's.
    """
    texts = _texts(docs, id_col, text_col)
    parsed = written(_units_of(texts, length), "units")
    # Grouped keys are written before they are joined: then adaptive execution can split a hot one.
    shared = written(parsed.groupBy("core").agg(F.count("*").alias("n")).where("n > 1").select("core"), "shared_cores")
    kept = written(parsed.join(shared, "core", "left_semi"), "shared_units")
    discard(parsed)

    one = F.min(F.struct("doc_key", "first", "starts")).alias("one")
    covers = written(kept.groupBy("core", "cover").agg(F.count("*").alias("n"), one), "covers")
    whole = kept.join(covers.where("n > 1").select("core", "cover"), ["core", "cover"], "left_semi")
    whole = written(whole.select("doc_key", "first", (F.col("first") + F.col("starts") - 1).alias("last")), "whole_units")
    discard(kept)

    mixed = written(covers.groupBy("core").agg(F.count("*").alias("m"), F.min("n").alias("least")).where("m > 1 AND least = 1").select("core"), "mixed_cores")
    wanted = covers.join(mixed, "core", "left_semi").select("one.*", F.xxhash64("core", "cover").alias("unit"))
    parts = written(_parts_of(texts, wanted, length), "parts")
    discard(covers)
    # The same again for the parts, then for the single strings of parts that differ around a shared core.
    bounds = [F.min("unit").alias("low"), F.max("unit").alias("high")]
    covers = written(parts.groupBy("core", "cover").agg(*bounds), "part_covers")
    again = parts.join(covers.where("low < high").select("core", "cover"), ["core", "cover"], "left_semi").select("doc_key", "first", (F.col("first") + F.col("n") - 1).alias("last"))
    mixed = written(covers.groupBy("core").agg(F.count("*").alias("m"), F.max(F.col("low") == F.col("high")).alias("alone")).where("m > 1 AND alone").select("core"), "mixed_parts")
    strings = written(_strings_of(parts.join(mixed, "core", "left_semi")), "strings")
    equal = written(strings.groupBy("string").agg(*bounds).where("low < high").select("string"), "equal_strings")
    single = strings.join(equal, "string", "left_semi").select("doc_key", F.col("start").alias("first"), F.col("start").alias("last"))

    runs = whole.union(again).union(single).distinct()
    found = written(runs.groupBy("doc_key").agg(F.flatten(F.collect_list(F.array("first", "last"))).alias("starts")), "repeats")
    for table in (whole, parts, covers, strings):
        discard(table)
    return found


def removed(n: int, starts: Sequence[int], length: int) -> list[tuple[int, int]]:
    """Maximal runs of a text's n bytes covered by the strings at the given starts."""
    spans: list[tuple[int, int]] = []
    for low, last in sorted(zip(starts[::2], starts[1::2])):
        high = min(last + length, n)
        if spans and low <= spans[-1][1]:
            spans[-1] = (spans[-1][0], max(high, spans[-1][1]))
        else:
            spans.append((low, high))
    return spans


def _kept(data: bytes, spans: list[tuple[int, int]]) -> bytes:
    edges = [0, *(x for span in spans for x in span), len(data)]
    return b"".join(data[a:b] for a, b in zip(edges[::2], edges[1::2]))


def digests(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256) of every row."""
    found = repeats(docs, id_col, text_col, length)
    rows = _texts(docs, id_col, text_col, F.col(id_col).cast("long").alias("doc_id"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = []
            for data, starts in zip(b.column("data"), b.column("starts")):
                data = data.as_py()
                spans = removed(len(data), starts.as_py() or (), length)
                out.append((len(data), sum(e - s for s, e in spans), len(spans), hashlib.sha256(_kept(data, spans)).hexdigest()))
            columns = list(zip(*out)) or [[], [], [], []]
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), *(pa.array(c, pa.int64()) for c in columns[:3]), pa.array(columns[3], pa.string())],
                ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"],
            )

    joined = rows.join(found, "doc_key", "left").select("doc_id", "data", "starts")
    return joined.mapInArrow(run, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string")


def without_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH) -> DataFrame:
    """The rows of `docs` with the repeated bytes cut out of the text.

    A character of which a cut leaves only some bytes is dropped; null stays null.
    """
    key, cuts = free_name(docs, "_doc_key"), free_name(docs, "_starts")
    found = repeats(docs, id_col, text_col, length).select(F.col("doc_key").alias(key), F.col("starts").alias(cuts))

    @F.pandas_udf("string")
    def cut(text: pd.Series, starts: pd.Series) -> pd.Series:
        return pd.Series([_cut(t, s.tolist(), length) for t, s in zip(text, starts)])

    joined = docs.withColumn(key, content_key(id_col, text_col)).join(found, key, "left")
    text = F.when(F.col(cuts).isNull(), F.col(text_col)).otherwise(cut(F.coalesce(text_col, F.lit("")), F.coalesce(cuts, F.array().cast("array<int>"))))
    return joined.withColumn(text_col, text).select(docs.columns)


def _cut(text: str, starts: list[int], length: int) -> str:
    data = text.encode("utf-8", "surrogatepass")
    return _kept(data, removed(len(data), starts, length)).decode("utf-8", "ignore") if starts else text
