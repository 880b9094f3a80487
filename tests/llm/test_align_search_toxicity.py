"""Tokenizer alignment, lexical search and the toxicity grammar against brute force."""

import collections
import hashlib
import math
import random
import re
import zlib
from pathlib import Path

import duckdb
import numpy as np
import pytest

from tallyweek.llm import align, lexical, toxicity
from tallyweek.llm.queries import ORACLES, QUERIES

ODD_TEXTS = [
    "a plain text", "two  spaces and\n\n lines\t tab ", " leading", "   ", "\n", "é ü ß 漢字 🙂", "a▁b c", "<s> [INST] <|endoftext|> <0x41> </s>",
    "x\x1c y  z  q", "repeat repeat repeat", "can't won't 1234 56", "end. \nNext", "a" * 300, "null\x00byte",
]


@pytest.fixture(scope="module")
def aligner():
    return align.Aligner(Path(align.BYTE_MODEL).read_bytes(), Path(align.PIECE_MODEL).read_bytes())


def tokens(aligner, text):
    """(A ids, A ends, B ids, B ends) of a text with a space in front, or None where the bytes do not come back."""
    a, b = aligner.a.encode(" " + text, add_special_tokens=False).ids, aligner.b.encode(text)
    parts = [[aligner.a_bytes[i] for i in a], [aligner.b_bytes[i] for i in b]]
    if any(b"".join(p) != (" " + text).encode() for p in parts):
        return None
    return a, np.cumsum([len(x) for x in parts[0]]).tolist(), b, np.cumsum([len(x) for x in parts[1]]).tolist()


def brute_links(kind, a_ends, b_ends):
    shared = sorted(set(a_ends) & set(b_ends))
    spans = [[(e[i - 1] if i else 0, e[i]) for i in range(len(e))] for e in (a_ends, b_ends)]
    out = {}
    for i, (s, e) in enumerate(spans[0]):
        for j, (t, f) in enumerate(spans[1]):
            if kind == "ends" and e == f or kind == "group" and sum(c < e for c in shared) == sum(c < f for c in shared):
                out[i, j] = 1
            elif kind == "overlap" and min(e, f) > max(s, t):
                out[i, j] = min(e, f) - max(s, t)
    return out


def brute_alignment(aligner, texts, kind="ends"):
    found, counts = [], collections.Counter()
    for text in texts:
        got = tokens(aligner, text) if text else None
        if got is None:
            found.append(None)
            continue
        a, a_ends, b, b_ends = got
        pairs = [(a[i], b[j]) for i, j in brute_links(kind, a_ends, b_ends)]
        counts.update(pairs)
        cut = sorted(set(a_ends) & set(b_ends))
        groups = [[",".join(str(x) for x, e in zip(ids, ends) if sum(c < e for c in cut) == g) for ids, ends in ((a, a_ends), (b, b_ends))] for g in range(len(cut))]
        found.append((len(a), len(b), len(cut), pairs, hashlib.sha256(";".join("|".join(g) for g in groups).encode()).hexdigest()))
    best = collections.Counter()
    for (_, b), n in counts.items():
        best[b] = max(best[b], n)
    return [
        (0, 0, 0, 0, 0, 0, "") if f is None else (*f[:3], len(f[3]), sum(counts[p] == best[p[1]] for p in f[3]), sum(counts[p] for p in f[3]), f[4])
        for f in found
    ]


def test_links_are_products(aligner):
    for text in ("internationalisation, of course", "über 漢字 x"):
        _, a_ends, _, b_ends = tokens(aligner, text)
        for kind in align.LINKS:
            rows, columns, values = align.links(kind, np.array(a_ends), np.array(b_ends))
            want = brute_links(kind, a_ends, b_ends)
            assert dict(zip(zip(rows.tolist(), columns.tolist()), values.tolist())) == want
    with pytest.raises(ValueError):
        align.links("none", np.array([1]), np.array([1]))


def test_gustavson_same_as_dense():
    r = np.random.default_rng(1)
    a, b = r.integers(0, 2, (7, 5)), r.integers(0, 2, (5, 6))
    sparse = [align.Csr(np.concatenate([[0], np.cumsum(m.sum(1))]), np.nonzero(m)[1]) for m in (a, b)]
    rows, columns, values = align.gustavson(*sparse, 6)
    dense = np.zeros((7, 6), int)
    dense[rows, columns] = values
    assert (dense == a @ b).all()
    back = align.transposed(sparse[0], 5)
    assert (back.columns == np.nonzero(a.T)[1]).all() and (np.diff(back.starts) == a.T.sum(1)).all()


@pytest.mark.parametrize("kind", align.LINKS)
def test_alignment_same_as_brute_force(spark, aligner, kind):
    texts = [*ODD_TEXTS, *ODD_TEXTS[:3], None, "", "a plain text again and again"]
    df = spark.createDataFrame([(i, t, "x", 1) for i, t in enumerate(texts)], "doc_id long, text string, pair string, row int").repartition(3)
    got = {r[0]: tuple(r)[1:] for r in align.align(df, links=kind).collect()}
    assert [got[i] for i in range(len(texts))] == brute_alignment(aligner, texts, kind)
    assert got[ODD_TEXTS.index("a▁b c")][0] == 0 and got[7][0] > 0


def test_alignment_edges(spark, monkeypatch):
    df = spark.createDataFrame([(None, "same text"), (5, "same text"), (5, "same text"), (6, None)], "doc_id long, text string")
    got = align.align(df).collect()
    assert len(got) == 4 and len({tuple(r)[1:] for r in got if r.doc_id != 6}) == 1
    assert align.align(df.limit(0)).collect() == []
    monkeypatch.setattr(align, "small", lambda d: d)  # the same without a broadcast
    assert sorted(map(str, align.align(df).collect())) == sorted(map(str, got))
    long = spark.createDataFrame([(1, "word " * 300_000), (2, "z" * 30_000)], "doc_id long, text string")
    assert {r.doc_id: r.n_b for r in align.align(long).collect()}[1] > 300_000


TERM = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute_search(docs, items, k=10):
    bags = [(i, collections.Counter(TERM.findall((t or "").translate(LOWER)))) for i, t in docs]
    total, n_docs = sum(sum(b.values()) for _, b in bags), sum(bool(b) for _, b in bags)
    df = collections.Counter(t for _, b in bags for t in b)
    out = []
    for item, text in items:
        found = []
        for i, bag in bags:
            n, score = sum(bag.values()), 0
            for t in TERM.findall((text or "").translate(LOWER)):
                if tf := bag[t]:
                    score += math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (1_000_000_000 * tf // (1000 * tf + 8 * (25 + 75 * n * n_docs // total)))
            if score > 0:
                found.append((-score, i is None, i))
        out += [(item, rank, i, -s) for rank, (s, _, i) in enumerate(sorted(found)[:k], 1)]
    return sorted(out, key=str)


def test_search_same_as_sql(spark, small):
    db = duckdb.connect()
    for name in ("documents", "benchmark"):
        db.execute(f"CREATE VIEW {name} AS SELECT * FROM '{small}/{name}.parquet'")
    want = db.execute(ORACLES["op13_bitsliced_search"]).fetchall()
    assert sorted(map(tuple, QUERIES["op13_bitsliced_search"](spark, small).collect())) == sorted(want)


def test_search_edges(spark, monkeypatch):
    docs = [(i, f"alpha w{i % 7} w{i % 11} " + "beta " * (i % 40)) for i in range(120)]
    docs += [(i, "hot copy of alpha w3") for i in range(200, 280)] + [(None, "gamma alone"), (None, "Gamma ALONE"), (300, None), (301, " .. "), (302, "gamma alone"), (302, "gamma alone")]
    docs += [(303, "delta " + "filler " * 40_000), (304, "É é Straße")]
    items = [(1, "alpha w3 w3 copy"), (2, "Gamma?"), (3, None), (4, "nowhere to be found"), (5, "beta delta é"), (5, "w5"), (None, "w1"), (2, "Gamma?")]
    left = spark.createDataFrame([(i, t, 1, "x") for i, t in docs], "doc_id long, text string, key int, queries string").repartition(5)
    right = spark.createDataFrame([(i, t, 1) for i, t in items], "item_id long, text string, rank int")
    want = brute_search(docs, list(dict.fromkeys(items)))
    got = sorted(map(tuple, lexical.search(left, right).collect()), key=str)
    assert got == want
    monkeypatch.setattr(lexical, "QUERY_BLOCK", 2)
    monkeypatch.setattr(lexical.query_blocks, "__defaults__", (3,))
    assert sorted(map(tuple, lexical.search(left, right, probes=1).collect()), key=str) == want
    assert lexical.search(left.limit(0), right).collect() == [] and lexical.search(left, right.limit(0)).collect() == []
    assert sorted(map(tuple, lexical.search(left, right, k=2).collect()), key=str) == brute_search(docs, list(dict.fromkeys(items)), 2)


def test_bounds_are_never_below_scores(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    texts = [r.text for r in spark.read.parquet(f"{small}/benchmark.parquet").collect()]
    queries = lexical.make_queries(docs, texts)
    keyed = {r.key: r.text for r in docs.select(lexical.content_key("doc_id", "text").alias("key"), "text").collect()}
    hashes, seen, above = lexical._hashes(queries.terms), 0, 0
    for block in lexical.build_index(docs).collect():
        bounds = queries.bounds(block.bits, np.array(block.lengths), block.slices, hashes)
        for at, key in enumerate(block.keys):
            bag = collections.Counter(TERM.findall(keyed[key].translate(LOWER)))
            assert sum(bag.values()) == block.lengths[at]
            exact = queries.scores(block.lengths[at], np.array([bag[t] for t in queries.terms]), np.arange(len(texts)))
            assert (bounds[:, at] >= exact).all()
            seen, above = seen + len(texts), above + int((bounds[:, at] > 3 * np.array(exact) + 1e9).sum())
    assert seen == len(keyed) * len(texts) and above < 0.1 * seen


def clause_scores(text, insults=("idiot",)):
    model = toxicity.Model({w: 3.0 for w in insults}, toxicity.PRIOR.curve)
    lexicon, strengths = model.lexicon()
    words = (lexicon.get(t) or toxicity.MARKS.get(t) for t in toxicity.TOKEN.findall(text.lower()))
    return [round(x, 6) for x in toxicity.Matcher(toxicity.grammar(strengths, 1.0)).clauses(w for w in words if w)]


def test_grammar():
    assert clause_scores("nothing here. at all") == []
    assert clause_scores("what an idiot") == [1.0]
    assert clause_scores("you idiot") == [1.5]
    assert clause_scores("an idiot like you") == [1.5]  # the target comes later
    assert clause_scores("an idiot. you") == [1.0]  # in another clause it does not count
    assert clause_scores("not an idiot") == [0.2]
    assert clause_scores("not now, an idiot") == [1.0]  # a break ends the negation
    assert clause_scores("they said, an idiot. an idiot") == [0.3, 1.0]
    assert clause_scores('the "idiot" idiot') == [1.3]
    assert clause_scores('an open " idiot. idiot') == [0.3, 1.0]
    assert clause_scores("kill the lights") == [0.0]  # a threat needs somebody
    assert clause_scores("i will kill you") == [1.5]
    assert clause_scores("she said you are not an idiot") == [round(1.5 * 0.2 * 0.3, 6)]
    assert clause_scores("idiot idiot; idiot") == [2.0, 1.0]


def test_composition_same_as_stepwise():
    """The composed transducer pays what the parts pay one after the other, on the best path."""

    def outputs(fst, symbols):
        paths = [(fst.start, (), 0.0)]
        for c in symbols:
            paths = [(to, (*out, o), w + v) for s, out, w in paths for to, o, v in fst.arcs.get((s, c), ())]
        return [(out, w) for _, out, w in paths]

    parts = [toxicity.target_fst(), toxicity.negation_fst(), toxicity.reported_fst(), toxicity.score_fst([0.1, 0.4, 0.7, 1.0], 1.0)]
    whole = toxicity.grammar([0.1, 0.4, 0.7, 1.0], 1.0)
    r = np.random.default_rng(3)
    for _ in range(60):
        symbols = [*r.choice(toxicity.CLASSES, 6), toxicity.STOP]
        rows = [(tuple(symbols), 0.0)]
        for part in parts:
            rows = [(out, w + v) for row, w in rows for out, v in outputs(part, row)]
        assert max(w for _, w in rows) == pytest.approx(max(w for _, w in outputs(whole, symbols)))


def test_toxicity_finds_held_out_labels(spark, small):
    folder = small.replace("sf0.001", "sf0.1")
    got = {r.doc_id: r for r in QUERIES["op12_toxicity_grammar"](spark, folder).collect()}
    docs = {r.doc_id: r.lang for r in spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "lang").collect()}
    assert set(got) == set(docs) and all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.7) for r in got.values())
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in got.values())
    labels = [(r.toxic, got[r.doc_id]) for r in spark.read.parquet(f"{folder}/labels.parquet").collect() if got[r.doc_id].held_out]
    caught = [r.predicted for toxic, r in labels if toxic]
    wrong = [r.predicted for toxic, r in labels if not toxic]
    assert np.mean(caught) >= 0.8 and np.mean(wrong) <= 0.005


def test_toxicity_edges(spark):
    r = random.Random(7)
    words = ["".join(r.choices("aeioulmnst", k=5)) for _ in range(300)]
    text = lambda i, bad: " ".join("grobuk" + "xyzvwpqrt"[r.randrange(9)] if bad and j % 4 == 2 else r.choice(words) for j in range(12))
    rows = [(i, text(i, i % 4 == 0)) for i in range(400)] + [(None, "you idiot"), (900, None), (901, ""), (902, "?!"), (903, "idiot " * 200_000), (5, "twice"), (5, "twice")]
    docs = spark.createDataFrame([(i, t, 0.5, 1) for i, t in rows], "doc_id long, text string, score double, evidence int").repartition(4)
    labels = spark.createDataFrame([(i, int(i % 4 == 0)) for i in range(400)] + [(901, None), (902, 7), (None, 1)], "doc_id long, toxic int")
    model = toxicity.learn(docs, labels)
    assert any(w.startswith("gro") and w.endswith("*") for w in model.insults)  # the stem, not its nine words
    got = toxicity.score(docs, model).collect()
    assert len(got) == len(rows)
    assert all(r.predicted == int(r.doc_id % 4 == 0) for r in got if r.doc_id is not None and r.doc_id < 400 and r.doc_id != 5)
    by_id = {r.doc_id: r for r in got}
    assert by_id[900].score == by_id[901].score == by_id[902].score < 0.3 and by_id[903].predicted == 1 and by_id[None].held_out is None
    # Labels of held-out rows make no difference.
    flipped = labels.toPandas()
    out = flipped.doc_id.map(lambda i: i == i and zlib.crc32(str(int(i)).encode()) % 3 == 1)
    flipped.loc[out, "toxic"] = 1 - flipped.loc[out, "toxic"]
    flipped = [(None if i != i else int(i), None if t != t else int(t)) for i, t in zip(flipped.doc_id, flipped.toxic)]
    again = toxicity.learn(docs, spark.createDataFrame(flipped, "doc_id long, toxic int"))
    assert again.insults == model.insults and again.curve == pytest.approx(model.curve)
    bare = toxicity.learn(docs, labels.limit(0))
    assert bare == toxicity.PRIOR and toxicity.score(docs.limit(0), bare).collect() == []
