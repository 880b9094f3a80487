"""Exact top-k, shards and license scans against brute force."""

import math
import random
import re
import zlib

import duckdb
import pytest
from pyspark.sql import functions as F

from tallyweek.llm import licenses, sharding, topk
from tallyweek.llm.queries import ORACLES, QUERIES

VECTORS = "vec_id long, embedding array<float>, row string"


def best(vectors, is_query, k, scale=64):
    usable = [(i, [math.floor(scale * x) for x in v]) for i, v in vectors if i is not None and v and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for q, a in usable:
        if is_query(q):
            found = sorted((-sum(x * y for x, y in zip(a, b)), c) for c, b in usable if c != q and len(a) == len(b))[:k]
            out += [(q, rank, c, -s) for rank, (s, c) in enumerate(found, 1)]
    return sorted(out)


def test_topk_same_as_sql(spark, small):
    db = duckdb.connect()
    db.execute(f"CREATE VIEW embeddings AS SELECT * FROM '{small}/embeddings.parquet'")
    want = db.execute(ORACLES["op1_exact_topk"]).fetchall()
    assert sorted(map(tuple, QUERIES["op1_exact_topk"](spark, small).collect())) == sorted(want)


def test_topk_edges(spark):
    r = random.Random(5)
    vectors = [(i, [r.uniform(-1, 1) for _ in range(4)]) for i in range(60)]
    vectors += [(i, [0.5, 0.5, 0.5, 0.5]) for i in range(60, 110)]  # a third are ties
    vectors += [(200, None), (201, [1.0, None, 0.0, 0.0]), (202, [float("nan")] * 4), (203, [float("inf")] * 4), (204, []), (None, [1.0] * 4)]
    vectors += [(220, [1.0, 2.0]), (240, [2.0, 1.0]), vectors[0], vectors[65], (5, [9e8, -9e8, 1e9, 3.0])]
    single = [(i, v if v is None else [None if x is None else float(__import__("numpy").float32(x)) for x in v]) for i, v in vectors]
    df = spark.createDataFrame([(i, v, "x") for i, v in single], VECTORS)
    for k in (1, 7, 200):
        got = topk.search(df, F.col("vec_id") % 20 == 0, k=k, query_rows=3, candidate_rows=16)
        assert sorted(map(tuple, got.collect())) == best(single, lambda i: i % 20 == 0, k)
    assert topk.search(df.limit(0), F.lit(True)).collect() == []
    with pytest.raises(ValueError):
        topk.search(df, F.lit(True), k=0)


def test_shards(spark):
    texts = [(i, f"text {i}" * (i % 5)) for i in range(500)] + [(7, "hot")] * 260 + [(8, f"same id {i}") for i in range(200)] + [(None, None), (None, None), (1000, "é")]
    df = spark.createDataFrame([(i, t, "x", 1) for i, t in texts], "doc_id long, text string, shard string, slot int")
    got = sharding.shards(df).collect()
    assert sorted((r.doc_id is None, r.doc_id, r.size, r.text_crc32) for r in got) == sorted((i is None, i, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for i, t in texts)
    slots = {}
    for row in got:
        slots.setdefault(row.shard, []).append(row.slot)
    assert set(slots) == set(range(16)) and all(sorted(s) == list(range(len(s))) for s in slots.values())
    sizes = [len(s) for s in slots.values()]
    assert max(sizes) - min(sizes) <= 1 and {r.law for r in got} == {"rows"} and {r.grown_shard for r in got} == {None}
    again = sharding.shards(df.repartition(5)).collect()
    assert sorted(map(repr, again)) == sorted(map(repr, got))
    assert sharding.shards(df.limit(0)).collect() == []


def test_ring_keeps_most_rows_at_home(spark):
    rows = spark.range(20_000).withColumnRenamed("id", "key")
    placed = sharding.assign(rows, "key", slack=0.25)
    assert placed.where("shard = home_shard").count() > 19_000
    loads = [r["count"] for r in placed.groupBy("shard").count().collect()]
    assert max(loads) <= 1563


def test_walk_by_hand():
    arcs = [(-5, 0), (0, 1), (5, 0), (9, 2)]
    assert sharding.walk(arcs, [4, 0, 1, 1], [2, 2, 2]) == [(0, 0, 1, 0, 0), (3, 0, 0, 2, 0), (0, 2, 3, 1, 0), (2, 0, 0, 2, 1)]


WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def places(text):
    w = WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    found = [(i, label) for phrase, label in licenses.BASE for p in [phrase.split()] for i in range(len(w)) if w[i : i + len(p)] == p]
    at = [i for i, _ in found]
    return len(w), len(at), min(at, default=None), max(at, default=None), ",".join(sorted({x for _, x in found}))


def test_license_scan_same_as_brute_force(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    edge = [(-1, None), (-2, ""), (-3, "cc"), (-4, "CC BY-NC, cc by nc;cc\nby\tNC! cc by"), (-4, "Under the MIT license under the K MIT license"), (-5, "K cc by ncé cc by nc"), (-6, "x " * 30_000 + "Apache License, Version 2.0")]
    edge += [(-7, "under the mit license")] * 3
    both = docs.select("doc_id", "text", F.col("lang").alias("label")).union(spark.createDataFrame([(i, t, "x") for i, t in edge], "doc_id long, text string, label string"))
    got = [tuple(r)[:6] for r in licenses.scan(both).collect()]
    want = [(r.doc_id, *places(r.text)) for r in both.collect()]
    assert sorted(map(repr, got)) == sorted(map(repr, want))


def test_license_labels_of_the_method(spark):
    texts = [
        "This work is licensed under the GNU General Public License, version 3.",
        "this work IS licensed under the very GNU general public license version 3",  # one word more
        "this work is licensed under the GNU general license, version 3",  # one word less
        "licensed under the moon",
        "general public",
    ]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: (r.labels, r.base_labels, round(r.score, 3)) for r in licenses.scan(df).collect()}
    assert [got[i][0] for i in range(5)] == ["gpl-3", "gpl-3", "gpl-3", "", ""]
    assert got[0][2] == 1.0 and 0.8 <= got[2][2] < 1 and got[3][2] == 0.0 and all(g[1] == "" for g in got.values())
    assert licenses.scan(df.limit(0)).collect() == []


def test_templates_of_any_length(spark, monkeypatch):
    texts = [text for text, _ in licenses.TEMPLATES if len(text.split()) > licenses.CHUNK]
    assert len(texts) >= 4 and max(len(t.split()) for t in texts) > 3 * licenses.CHUNK
    w = texts[0].split()
    cut, broken = w[:40] + ["added", "words"] + w[40:], w[:50] + w[100:]
    docs = [(0, " ".join(w)), (1, "before " * 70 + ", ".join(cut)), (2, " ".join(broken)), (3, " ".join(w[100:])), (4, " ".join(w)), (4, " ".join(w))]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    own = [(texts[0], "whole")]
    got = sorted((r.doc_id, r.labels, round(r.score, 4)) for r in licenses.scan(df, templates=own).collect())
    # What an added word tears apart is on neighbouring diagonals and counts together.
    assert got == [(0, "whole", 1.0), (1, "whole", 1.0), (2, "", 0.0), (3, "", 0.0), (4, "whole", 1.0), (4, "whole", 1.0)]
    monkeypatch.setattr(licenses, "COPIES", 1)
    assert sorted((r.doc_id, r.labels) for r in licenses.scan(df, templates=own).collect()) == [(i, label) for i, label, _ in got]
    found = {r.doc_id: r.labels for r in licenses.scan(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()}
    assert found == {0: "mit", 1: "apache-2", 2: "bsd,bsd-3", 3: "isc"}


@pytest.mark.parametrize("first,n", [(0, 3), (58, 3), (59, 3), (119, 2), (0, 130)])
def test_bits_of(first, n):
    got = [c * licenses.CHUNK + i for c, bits in licenses.bits_of(first, n) for i in range(licenses.CHUNK) if bits >> i & 1]
    assert got == list(range(first, first + n))
