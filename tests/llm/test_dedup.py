"""SimHash, repeated strings and benchmark containment against brute force."""

import hashlib
import random
from collections import Counter

import duckdb
import pytest
import xxhash
from pyspark.sql import functions as F

from tallyweek.llm import common, decontaminate, simhash, substrings
from tallyweek.llm.queries import ORACLES, QUERIES

SCHEMA = "doc_id long, text string, fp string, starts int"


def frame(spark, docs):
    return spark.createDataFrame([(i, t, "x", 0) for i, t in docs], SCHEMA)


def signed(x):
    return x - (1 << 64) if x >> 63 else x


def simple_fingerprint(text):
    w = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "").encode().split()
    grams = [b" ".join(w[i : i + 3]) for i in range(len(w) - 2)] or ([b" ".join(w)] if w else [])
    hashes = [xxhash.xxh64_intdigest(g, 42) for g in grams]
    return sum(1 << i for i in range(64) if 2 * sum(h >> i & 1 for h in hashes) > len(hashes))


def groups(prints, near):
    """Each position's smallest linked position."""
    root = list(range(len(prints)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for a in range(len(prints)):
        for b in range(a):
            if near(prints[a], prints[b]):
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return [find(i) for i in range(len(prints))]


def test_simhash_same_as_brute_force(spark, small):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{small}/documents.parquet").select("doc_id", "text").collect()]
    base = docs[0][1]
    near = base.split(" ")
    for k in range(12):
        near[40 + 9 * k] = "changed"
        docs.append((1000 + k, " ".join(near)))
    docs += [(2000, None), (2001, ""), (2002, " \t\n"), (2003, "one"), (2004, "ONE two"), (2005, "É é"), (5, docs[5][1]), (5, docs[5][1]), (2006, "w " * 40_000)]
    prints = [simple_fingerprint(t) for _, t in docs]
    root = groups(prints, lambda a, b: (a ^ b).bit_count() <= 2)
    least = {}
    for (i, _), r in zip(docs, root):
        least[r] = min(i, least.get(r, i))
    want = sorted((i, f"{p:016x}", least[r]) for (i, _), p, r in zip(docs, prints, root))
    found = simhash.near_duplicates(frame(spark, docs)).select("id", simhash.fingerprint_hex(), "component_id")
    assert sorted(map(tuple, found.collect())) == want
    assert len(set(root)) < len(set(prints))


@pytest.mark.parametrize("bits", [1, 2])
@pytest.mark.parametrize("long_list", [1, 4, 1000])
def test_links_of_a_ball(spark, bits, long_list):
    r = random.Random(bits)
    centres = [r.getrandbits(64) for _ in range(4)]
    prints = sorted({c ^ sum(1 << b for b in r.sample(range(64), r.randrange(4))) for c in centres for _ in range(60)} | {0, (1 << 64) - 1})
    table = spark.createDataFrame([(signed(p),) for p in prints], "fp long")
    got = {row.node: row.root for row in common.components(simhash.links(table, bits, long_list)).collect()}
    root = groups([signed(p) for p in prints], lambda a, b: ((a ^ b) & ((1 << 64) - 1)).bit_count() <= bits)
    sets = {}
    for p, x in zip(prints, root):
        sets.setdefault(x, []).append(signed(p))
    assert got == {p: min(s) for s in sets.values() if len(s) > 1 for p in s}


def test_tally_drops_pairs_before_they_are_verified(spark):
    base = random.Random(8).getrandbits(64)
    near, far = base ^ 0b1 ^ (1 << 60), base ^ int("ff" * 3, 16)
    fps = [signed(p) for p in (base, near, far)]
    pairs = lambda count: [(max(x, fps[0]), min(x, fps[0])) for x in fps[1 : 1 + count]]
    lists = spark.createDataFrame([([fps[0], fps[1]],)] * 15 + [([fps[0], fps[2]],)] * 5, "fps array<long>")
    assert [tuple(r) for r in simhash.met_pairs(lists, 2).collect()] == pairs(1)
    table = spark.createDataFrame([(f,) for f in fps], "fp long")
    assert [tuple(r) for r in simhash.links(table).collect()] == pairs(1)
    for bad in ({"max_bits": 3}, {"positions": 7}):
        with pytest.raises(ValueError):
            simhash.links(table, **bad)


def test_long_texts_in_blocks():
    text = "word " * 100 + "other\tword\n" * 50
    blocks = list(common.blocks(text.encode(), 37))
    assert b"".join(blocks) == text.encode() and max(map(len, blocks)) < 60


def test_keep_one(spark):
    docs = [(3, "a b c d e"), (1, "A b c d e"), (2, "x y z"), (2, "x y z"), (4, None), (None, "x y z"), (6, "other words here")]
    kept = simhash.keep_one(frame(spark, docs)).collect()
    assert sorted((r.doc_id, r.text) for r in kept) == [(1, "A b c d e"), (2, "x y z"), (4, None), (6, "other words here")]
    assert simhash.keep_one(frame(spark, docs).limit(0)).count() == 0 and kept[0].fp == "x"


def test_keep_one_where_ids_do_not_tell_components_apart(spark):
    docs = [(None, "a b c d e"), (None, "x y z"), (None, "x y z"), (None, "X Y Z"), (1, "one two three"), (1, "quite other words here"), (2, "one two three")]
    kept = sorted((str(r.doc_id), r.text.lower()) for r in simhash.keep_one(frame(spark, docs)).collect())
    assert kept == [("1", "one two three"), ("1", "quite other words here"), ("None", "a b c d e"), ("None", "x y z")]
    found = simhash.near_duplicates(frame(spark, docs)).collect()
    assert len({r.root for r in found}) == 4 and {r.component_id for r in found} == {None, 1}


def chain(n):
    return [(i + 1, i) for i in range(n)]


@pytest.mark.parametrize("edges", [[], chain(40), [(i, 0) for i in range(1, 30)], chain(5) + [(x + 10, y + 10) for x, y in chain(6)], [(1, 1), (2, 1), (1, 2)]])
def test_components(spark, edges):
    root = {}
    for a, b in edges:
        if a != b:
            x, y = ({root.get(v, v)} for v in (a, b))
            low = min(x | y)
            root = {v: low if r in x | y else r for v, r in (root | {a: root.get(a, a), b: root.get(b, b)}).items()}
    got = common.components(spark.createDataFrame(edges, "a long, b long")).collect()
    assert {r.node: r.root for r in got} == root and len(got) == len(root)


def brute(texts, length):
    seen = Counter(t[i : i + length] for t in texts for i in range(len(t) - length + 1))
    out = []
    for t in texts:
        covered = bytearray(len(t))
        for i in range(len(t) - length + 1):
            if seen[t[i : i + length]] > 1:
                covered[i : i + length] = b"\1" * length
        kept = bytes(b for b, x in zip(t, covered) if not x)
        runs = sum(1 for i in range(len(t)) if covered[i] and not (i and covered[i - 1]))
        out.append((len(t), sum(covered), runs, hashlib.sha256(kept).hexdigest()))
    return out


@pytest.mark.parametrize("length, letters", [(32, "ab"), (32, "abcdefgh "), (60, "abcdefghijklmnopqé "), (100, "abc ü")])
def test_repeats_same_as_brute_force(spark, length, letters):
    r = random.Random(length)
    base = ["".join(r.choice(letters) for _ in range(r.randrange(700))) for _ in range(20)]
    docs = []
    for _ in range(70):
        text = ""
        for _ in range(r.randrange(4)):
            b = r.choice(base)
            i = r.randrange(len(b) + 1)
            text += b[i : i + r.randrange(400)] + "".join(r.choice(letters) for _ in range(r.randrange(30)))
        docs.append(text)
    docs += ["a" * 300, "ab" * 150, "xyz " * 60, None, "", docs[3], docs[3]]
    rows = list(enumerate(docs)) + [(0, docs[0]), (None, docs[1])]
    got = substrings.digests(frame(spark, rows), length=length).collect()
    want = [(i, *d) for (i, _), d in zip(rows, brute([(t or "").encode() for _, t in rows], length))]
    assert sorted(map(repr, map(tuple, got))) == sorted(map(repr, want))
    cut = {r.doc_id: r.text for r in substrings.without_repeats(frame(spark, rows), length=length).collect()}
    assert all(hashlib.sha256(cut[i].encode()).hexdigest() == d[4] for i, d in enumerate(want[: len(docs)]) if docs[i] and docs[i].isascii())
    assert cut[docs.index(None)] is None


def test_repeats_of_given_table(spark, small):
    rows = sorted((r.doc_id, r.text.encode()) for r in spark.read.parquet(f"{small}/documents.parquet").collect())
    got = [tuple(r) for r in QUERIES["op7_suffix_array_dedup"](spark, small).orderBy("doc_id").collect()]
    assert got == [(i, *d) for (i, _), d in zip(rows, brute([t for _, t in rows], 400))]
    assert substrings.digests(frame(spark, []), "doc_id").collect() == []


def test_units_in_blocks(monkeypatch):
    data = b"a" * 3000 + bytes(range(256)) * 4
    whole = list(substrings.units(data, 40))
    monkeypatch.setattr(substrings, "_BLOCK", 1 << 10)
    monkeypatch.setattr(substrings, "triggers", lambda d, r, at=substrings.triggers(data, 4): at)
    assert len(whole) > 2000 and list(substrings.units(data, 40)) == whole


def test_triggers_in_blocks(monkeypatch):
    data = random.Random(1).randbytes(5000) + b"ab" * 400 + b"\0" * 300
    whole = substrings.triggers(data, 10).tolist()
    monkeypatch.setattr(substrings, "_BLOCK", 333)
    assert substrings.triggers(data, 10).tolist() == whole and len(whole) > 100
    with pytest.raises(ValueError):
        list(substrings.units(data, 31))


def test_contained_items_same_as_sql(spark, small):
    db = duckdb.connect()
    for name in ("documents", "benchmark"):
        db.execute(f"CREATE VIEW {name} AS SELECT * FROM '{small}/{name}.parquet'")
    want = db.execute(ORACLES["op9_benchmark_decontamination"]).fetchall()
    got = QUERIES["op9_benchmark_decontamination"](spark, small).collect()
    assert sorted(map(tuple, got)) == sorted(want) and want


def word_list(text):
    return "".join(c if c.isalnum() or ord(c) > 127 else " " for c in (text or "").lower()).split()


def grams(text):
    """Five-word shingles, of fewer words the whole sequence."""
    w = word_list(text)
    return {tuple(w[i : i + 5]) for i in range(len(w) - 4)} or {tuple(w)} - {()}


def shared(item, text):
    """How many of the item's shingles the text has."""
    w, n = word_list(text), grams(item)
    width = len(next(iter(n), ()))
    return len(n & {tuple(w[i : i + width]) for i in range(len(w) - width + 1)})


def test_containment_edges(spark):
    r = random.Random(2)
    word = lambda: r.choice("abcdefghij") + r.choice("klmnop") + str(r.randrange(20))
    items = [(i, " ".join(word() for _ in range(r.randrange(1, 60)))) for i in range(40)] + [(100, None), (101, ""), (102, "four words are few"), (None, "one two three four five six"), (None, "seven eight nine ten eleven twelve"), (5, "another text under an id that is taken"), (5, "another text under an id that is taken")]
    docs = [(0, None), (1, ""), (2, "tiny"), (3, "one two three four five six"), (4, "well: Four words are few."), (5, "seven eight nine ten eleven twelve another text under an id that is taken")]
    for k in range(60):
        w = items[k % 40][1].split()
        for _ in range(r.randrange(4)):
            w[r.randrange(len(w))] = "changed"
        docs.append((10 + k, " ".join([word() for _ in range(r.randrange(3000))] + [x.upper() for x in w] + [word() for _ in range(50)])))
    docs += [docs[10], docs[10], (10, docs[11][1])]
    want = set()
    for i, t in set(docs):
        for j, u in set(items):
            n = len(grams(u))
            if n and shared(u, t) / n >= 0.8:
                want.add((i, t, j, u, n, shared(u, t)))
    df, bench = frame(spark, docs), spark.createDataFrame([(j, u, 1) for j, u in items], "item_id long, text string, h int")
    got = decontaminate.contained_items(df, bench).collect()
    assert sorted(repr((x.doc_id, x.item_id, x.n_shingles, x.n_shared)) for x in got) == sorted(repr((i, j, n, m)) for i, _, j, _, n, m in want)
    assert {w[2] for w in want} >= {None, 5, 102}
    bad = {(i, t) for i, t, *_ in want}
    clean = decontaminate.clean(df, bench).collect()
    assert sorted(map(repr, ((x.doc_id, x.text) for x in clean))) == sorted(map(repr, (d for d in docs if d not in bad)))
    assert decontaminate.contained_items(df.limit(0), bench).collect() == [] == decontaminate.contained_items(df, bench.limit(0)).collect()


def test_a_shared_opening_names_no_candidates(spark):
    opening = "read the passage below and answer the question that follows it"
    items = [(i, f"{opening} " + " ".join(f"w{i}x{k}" for k in range(40))) for i in range(300)]
    found = decontaminate.item_shingles(spark.createDataFrame(items, "item_id long, text string"), "item_id", "text", 5, 0.8).where("is_minimum")
    most = found.groupBy("h").count().orderBy("count", ascending=False).first()["count"]
    assert most == 1 and found.select("item_key").distinct().count() == 300
    docs = spark.createDataFrame([(1, f"{opening} nothing else"), (2, "so: " + items[7][1])], "doc_id long, text string")
    bench = spark.createDataFrame(items, "item_id long, text string")
    assert [(r.doc_id, r.item_id) for r in decontaminate.contained_items(docs, bench).collect()] == [(2, 7)]


def test_shuffled_where_the_items_are_many(spark, small, monkeypatch):
    plain = sorted(map(tuple, QUERIES["op9_benchmark_decontamination"](spark, small).collect()))
    monkeypatch.setattr(decontaminate, "small", lambda df: df)
    assert sorted(map(tuple, QUERIES["op9_benchmark_decontamination"](spark, small).collect())) == plain
    assert F is not None
