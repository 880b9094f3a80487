"""Language ID, pieces, chat and WARC: accuracy, round trips and brute force."""

import hashlib
import random
import time
import zlib

import duckdb
import pandas as pd
import pytest
import sentencepiece

from tallyweek.llm import chat, language, pieces, warc
from tallyweek.llm.queries import ORACLES, PROBE, QUERIES
from tools.check_queries import normal


def same_as_sql(spark, folder, name, table):
    db = duckdb.connect()
    db.execute(f"CREATE VIEW {table} AS SELECT * FROM '{folder}/{table}.parquet'")
    got, want = QUERIES[name](spark, folder).toPandas(), db.execute(ORACLES[name]).df()
    assert normal(got) == normal(want) and len(want)


def occurs(text, word):
    """Cross-parsing by plain search."""
    n, i = 0, 0
    while i < len(word):
        k = 1
        while i + k < len(word) and word[i : i + k + 1] in text:
            k += 1
        n, i = n + 1, i + k
    return n


def test_automaton_is_plain_search():
    r = random.Random(3)
    for letters in ("ab", "abcdef "):
        text = "".join(r.choice(letters) for _ in range(300))
        automaton = language.Automaton(text)
        for _ in range(300):
            word = "".join(r.choice(letters + "z") for _ in range(r.randrange(1, 20)))
            assert automaton.phrases(word) == occurs(text, word)


def test_language_accuracy(spark, small):
    found = QUERIES["op8_language_id"](spark, small).toPandas()
    truth = pd.read_parquet(f"{small}/documents.parquet", columns=["doc_id", "lang"])
    both = found.merge(truth, on="doc_id")
    assert len(found) == len(truth) and both.score.between(0, 1).all()
    assert (both.lang_pred == both.lang)[both.held_out].mean() >= 0.95
    assert both.held_out.any() and not both.held_out.all()


def test_language_edges(spark):
    docs = [(i, "the thing with words " * 3, "en") for i in range(20)] + [(100 + i, "le chat est où la mère", "fr") for i in range(20)]
    docs += [(300, None, "en"), (301, "", "en"), (302, "123 !!", "fr"), (303, "THE THING", None), (303, "THE THING", None), (None, "la mère", None), (304, "où " * 50_000, None)]
    df = spark.createDataFrame([(*d, 0.5) for d in docs], "doc_id long, text string, lang string, score double")
    texts = language.learn(df)
    assert sorted(texts) == ["en", "fr"]
    got = [(r.id, r.lang_pred, r.score) for r in language.predict(df, texts).collect()]
    said = {i: lang for i, lang, _ in got}
    assert len(got) == len(docs) and said[300] == said[301] == said[302] == "und" and said[303] == "en" and said[304] == said[None] == "fr"
    parser = language.Parser(texts)
    for i, lang, score in got:
        text = next(d[1] for d in docs if d[0] == i)
        if lang != "und":
            if len(text) > 3000:  # plain search takes too long
                continue
            costs = {name: occurs(texts[name], f" {language.letters(text)} ") * weight for name, weight in zip(parser.names, parser.weights)}
            assert lang == min(costs, key=lambda n: (costs[n], n)) and score == pytest.approx(1 - min(costs.values()) / max(costs.values()))
    assert {r.lang_pred for r in language.predict(df, {}).collect()} == {"und"}
    assert language.predict(df.limit(0), texts).collect() == [] and language.learn(df.limit(0)) == {}
    kept = language.keep_known(df)
    assert kept.columns == df.columns and kept.count() == len(docs) - 3


def test_never_learned_from_held_out_rows(spark):
    out = [i for i in range(400) if zlib.crc32(str(i).encode()) % 4 == 2]
    df = spark.createDataFrame([(i, "nur hier", "de") for i in out] + [(None, "some words", "en")], "doc_id long, text string, lang string")
    assert sorted(language.learn(df)) == ["en"]


def test_known_texts_stay_whatever_was_learned(spark):
    schema = "doc_id long, text string, lang string"
    docs = [(1, "some words here"), (None, "other words"), (3, "123 !!"), (4, None), (5, "")]
    for label in (None, language.UNKNOWN):
        kept = language.keep_known(spark.createDataFrame([(*d, label) for d in docs], schema))
        assert sorted(r.text for r in kept.collect()) == ["other words", "some words here"]


def test_numerals_are_no_letters():
    assert language.letters("½ ² Ⅷ ٣ _ 7") == "" and language.letters("Ab3c_d ªé漢½x") == "ab c d ªé漢 x"


def test_phrases_run_across_words():
    automaton = language.Automaton(" one two three one ")
    assert automaton.phrases(" one two ") == 1 and automaton.phrases(" two one ") == 2


@pytest.mark.parametrize("block, stretch, cells", [(1, 1, 0), (7, 3, 1 << 22), (64, 16, 0), (1000, 256, 1 << 22), (1 << 20, 256, 1 << 22)])
def test_texts_parsed_at_once_are_parsed_as_one_by_one(monkeypatch, block, stretch, cells):
    r = random.Random(5)
    for name, value in (("BLOCK", block), ("STRETCH", stretch), ("DENSE_CELLS", cells)):
        monkeypatch.setattr(language, name, value)
    learned = {"a": " ab abba baab aab ", "b": " " + "".join(r.choices("ab漢字 ", k=200)) + " "}
    parser = language.Parser(learned)
    texts = [" " + "".join(r.choices("abz漢 ", k=r.randrange(1, 40))) + " " for _ in range(40)] + [" aba " * 30, "ab" * 100, "z" * 70, "a", " "]
    assert parser.phrases(texts).tolist() == [[occurs(learned[name], t) for name in parser.names] for t in texts]
    assert parser.predict(["", "ab ba", ""])[::2] == [("und", 0.0)] * 2 and parser.predict([]) == []


def test_parsing_takes_less_than_some_plain_loops_over_the_text():
    r = random.Random(6)
    words = {name: ["".join(r.choices(letters, k=r.randrange(2, 9))) for _ in range(3000)] for name, letters in (("x", "abcdefghiê"), ("y", "efghijklmn"), ("z", "ijklmnopqß"), ("w", "mnopqrstuv"))}
    parser = language.Parser({name: f" {' '.join(of)} " for name, of in words.items()})
    texts = [", ".join(r.choices(of, k=200)) for of in words.values() for _ in range(100)]
    language.letters("a")

    def seconds(run):
        start = time.process_time()
        run()
        return time.process_time() - start

    def loop():
        for text in texts * len(words):
            for c in text:
                c in words  # noqa: B015

    found = min(seconds(lambda: parser.predict([language.letters(t) for t in texts])) for _ in range(3))
    assert found < 5 * min(seconds(loop) for _ in range(3))
    assert [lang for lang, _ in parser.predict(texts)] == [name for name in words for _ in range(100)]


def test_passages_are_drawn_from_whole_texts(spark):
    text = " ".join("abcdefghij"[k % 10] * 3 + "klmnopqrst"[k // 10 % 10] * 4 for k in range(100)) * 100
    texts = language.learn(spark.createDataFrame([(1, text, "en")], "doc_id long, text string, lang string"), passages=20, chars=50)
    assert 500 < len(texts["en"]) < 2000
    drawn = language.learn(spark.createDataFrame([(1, "head " * 400 + "tail " * 400, "en")], "doc_id long, text string, lang string"), passages=40, chars=50)
    assert "head head" in drawn["en"] and "tail tail" in drawn["en"]


def test_more_languages_than_the_bound_are_refused(spark):
    docs = spark.createDataFrame([(i, "words", f"l{i}") for i in range(40)], "doc_id long, text string, lang string")
    with pytest.raises(ValueError, match="languages"):
        language.learn(docs, languages=5)


def test_prediction_decides_what_stays(spark, monkeypatch):
    docs = [(i, "the thing with words " * 3, "en") for i in range(12)] + [(100 + i, "le chat est où la mère", "fr") for i in range(12)]
    # Held-out ids, so that wrong labels are not learned.
    a, b, c, d, e = [i for i in range(200, 400) if zlib.crc32(str(i).encode()) % 4 == 2][:5]
    docs += [(a, "the words", None), (b, "la mère", None), (c, "la mère", "en"), (d, "the thing", "fr"), (e, "12", None), (a, "the words", None)]
    df = spark.createDataFrame(docs, "doc_id long, text string, lang string")
    late = lambda found: sorted((r.doc_id, r.lang) for r in found.collect() if r.doc_id >= 200)
    assert late(language.keep_known(df)) == [(a, "en"), (a, "en"), (b, "fr"), (c, "en"), (d, "fr")]
    assert late(language.keep_known(df, languages=["en"])) == [(a, "en"), (a, "en"), (d, "fr")]
    # With the languages learned the wrong way round, other rows stay.
    right = language.learn(df)
    monkeypatch.setattr(language, "learn", lambda *_: {"en": right["fr"], "fr": right["en"]})
    assert late(language.keep_known(df, languages=["en"])) == [(b, "en"), (c, "en")]


@pytest.mark.parametrize("doc_id", [None, 1, 2, 3])
def test_sample_is_drawn_by_content(spark, doc_id):
    words = ["".join("abcdefghij"[int(c)] for c in f"{k:04}") for k in range(2000)]
    rows = [(doc_id, w, "en") for w in words] + [(doc_id, "kkkk", "fr")] * 2000 + [(doc_id, "llll", "fr")]
    texts = language.learn(spark.createDataFrame(rows, "doc_id long, text string, lang string"), passages=100)
    assert 50 < len(texts["en"].split()) < 150 and texts["fr"].split() == ["kkkk", "llll"]


@pytest.fixture(scope="module")
def model():
    return open(pieces.MODEL, "rb").read()


def hard_texts():
    r = random.Random(4)
    kinds = ["ab ", "aeiou thn  ", "日本語a é😀 ", "\n\t  x=(){}<s></s>", "▁ a", "0123456789", "  ", "import os\n    def f(self):\n        return ", "aaaa", "=-*#"]
    return ["".join(r.choice(k) for _ in range(r.randrange(120))) for k in kinds for _ in range(60)] + ["", " ", "thequickbrownfox" * 500, " " * 1000, "é" * 500, "don't can't (it's)."]


def test_pieces_same_as_library(spark, small, model):
    library, own = sentencepiece.SentencePieceProcessor(model_proto=model), pieces.Pieces(model)
    texts = hard_texts() + [r.text for r in spark.read.parquet(f"{small}/documents.parquet").collect()]
    for text in texts:
        ids = own.encode(text)
        assert ids.tolist() == library.encode(text) and own.decode(ids) == library.decode(library.encode(text))


def test_pieces_with_tiny_tables_and_windows(model):
    library, own = sentencepiece.SentencePieceProcessor(model_proto=model), pieces.Pieces(model)
    own.kept.limit = own.kept_runs.limit = own.openings.limit = 3
    for text in hard_texts():
        assert own.encode(text).tolist() == library.encode(text)
        assert list(own.viterbi("▁" + text.replace(" ", "▁"))) == own.merged("▁" + text.replace(" ", "▁")) or len(text) > 600


def test_pieces_with_little_kept_of_reading_and_boundaries(model, monkeypatch):
    library = sentencepiece.SentencePieceProcessor(model_proto=model)
    for name in ("KEPT_ENDS", "KEPT_FITS"):
        monkeypatch.setattr(pieces, name, 5)
    own = pieces.Pieces(model, 3)
    assert all(own.encode(text).tolist() == library.encode(text) for text in hard_texts())


def test_boundaries_are_told_without_merging_anew(model, monkeypatch):
    own, r = pieces.Pieces(model), random.Random(8)
    some = r.sample(sorted(own.ids), 300) + list("aeé漢😀▁.0") + ["qzx"]
    pairs = [(a, b) for a in some for b in r.sample(some, 20)] + [(a[:i], a[i:]) for a in some for i in range(1, len(a))]
    held = [own.parted(a, b) for a, b in pairs]
    assert held == [own.merged(a + b) == [a, b] for a, b in pairs] and 0 < sum(held) < len(held)
    # A piece whose merge scores better than one that it needs.
    own.scores = {"ab": -5.0, "abc": -1.0, "cd": -2.0, "bc": -5.0, "cc": -5.0}
    own.known_edges.clear()
    strings = ["".join(r.choices("abcd", k=r.randrange(1, 4))) for _ in range(200)]
    assert all(own.parted(a, b) == (own.merged(a + b) == [a, b]) for a in strings for b in strings[:50])
    # Words that nobody has seen are encoded without merging every pair of neighbours.
    fresh, calls = pieces.Pieces(model), []
    monkeypatch.setattr(fresh, "merged", lambda text: calls.append(text) or own.merged(text))
    own = pieces.Pieces(model)
    for _ in range(500):
        fresh.encode("".join(r.choices("aeinorstlu", k=12)))
    assert len(calls) == len(set(calls)) and all(text in own.ids for text in calls)


def test_pieces_edges(spark):
    docs = [(1, None), (2, ""), (3, "a b"), (3, "a b"), (None, "x"), (4, "▁"), (5, "long " * 100_000)]
    df = spark.createDataFrame([(i, t, "x") for i, t in docs], "doc_id long, text string, ids string")
    got = pieces.round_trip(df).collect()
    assert len(got) == 7 and all(r.n_ids == len(r.ids) for r in got)
    assert {r.doc_id: r.same for r in got} == {1: True, 2: True, 3: True, None: True, 4: False, 5: True}
    encoded = pieces.encode(df)
    assert sorted(map(repr, ((r.id, r.text) for r in pieces.decode(encoded).collect()))) == sorted(map(repr, ((i, (t or "").replace("▁", " ")) for i, t in docs)))
    assert pieces.round_trip(df.limit(0)).collect() == []


def test_op4_round_trips(spark, small):
    got = QUERIES["op4_sentencepiece"](spark, small).toPandas()
    truth = pd.read_parquet(f"{small}/documents.parquet").set_index("doc_id").text
    assert got.same.all() and all(hashlib.sha256(truth[i].encode()).hexdigest() == h for i, h in zip(got.doc_id, got.decoded_sha256))


def test_chat_same_as_sql(spark, small):
    same_as_sql(spark, small, "op6_chat_format", "conversations")


def digest(turns):
    return hashlib.sha256("".join(turns).encode()).hexdigest()


@pytest.mark.parametrize("part_bytes", [1, 50, 8 << 20])
def test_chat_edges(spark, part_bytes):
    texts = [PROBE, None, "", "\\", "\\b", "\\ls>", "<s", "a</s>b<s>c", "[INST][/INST]", "é😀\n", "x" * 70_000]
    turns = [(c, t, role, text) for c in (1, 2, None) for t, (role, text) in enumerate((r, x) for x in texts for r in ("user", "assistant", "tool\n[INST]", None))]
    turns += [(3, None, "assistant", "tie"), (3, None, "assistant", "tie"), (4, 0, "system", "alone")]
    df = spark.createDataFrame([(*t, "x") for t in turns], "conv_id long, turn long, role string, text string, part string")
    formatted = chat.format_conversations(df, part_bytes=part_bytes)
    whole = {}
    for r in sorted(formatted.collect(), key=lambda r: r.part):
        whole[r.conv_id] = whole.get(r.conv_id, "") + r.formatted
    want = []
    for c in (1, 2, None, 3, 4):
        own = sorted(((t if t is not None else -1, r or "", r is not None, x or "", x is not None) for k, t, r, x in turns if k == c), key=lambda o: (o[0], o[2], o[1], o[4], o[3]))
        loss = [x for _, r, _, x, _ in own if r == "assistant"]
        want.append((c, len(own), digest(f"{r}\n{x}\n" for _, r, _, x, _ in own), sum(map(len, loss)), digest(loss), len(whole[c])))
    got = [tuple(r) for r in chat.read_back(formatted).collect()]
    assert sorted(map(repr, got)) == sorted(map(repr, want))
    assert chat.read_back(chat.format_conversations(df.limit(0))).collect() == []


def test_broken_text_is_not_read(spark):
    bad = spark.createDataFrame([(1, 0, "<s>x</s>y", [3, 4])], "conv_id long, part long, formatted string, loss_spans array<int>")
    with pytest.raises(Exception, match="open turn"):
        chat.read_back(bad).collect()


def test_warc_same_as_sql(spark, small):
    same_as_sql(spark, small, "op10_warc", "pages")


def test_warc_edges(spark):
    pages = [(5, "u", "same"), (3, "http://é/\r\nx", "same"), (9, None, "same"), (1, "u", None), (2, "u", ""), (3, "u", "same"), (None, "u", "same"), (7, "u", "WARC/1.1\r\n\r\nWARC-Type: response\r\n" * 3), (8, "u", "é" * 100_000)]
    df = spark.createDataFrame([(*p, "x") for p in pages], "page_id long, url string, html string, digest string")
    for file_bytes in (1, 1000, 1 << 26):
        made = warc.archive(df, file_bytes=file_bytes)
        got = warc.read_archives(made).collect()
        assert sum(r.n_records for r in made.collect()) == len(pages) == len(got)
        rows = {(r.page_id, r.url): r for r in got}
        assert {k: (r.record_type, r.refers_to) for k, r in rows.items()} == {
            (5, "u"): ("revisit", 3), (3, "http://é/\r\nx"): ("response", None), (9, None): ("revisit", 3), (1, "u"): ("response", None), (2, "u"): ("revisit", 1),
            (3, "u"): ("response", None), (None, "u"): ("revisit", 3), (7, "u"): ("response", None), (8, "u"): ("response", None),
        }
        for page_id, url, html in pages:
            data, r = (html or "").encode(), rows[page_id, url]
            assert (r.payload_bytes, r.payload_digest) == (len(data), warc.digest_base32(data)) and (r.payload is None or bytes(r.payload) == data)
    assert {r.record_type for r in warc.read_archives(warc.archive(df, least_bytes=1 << 30)).collect()} == {"response"}
    assert warc.read_archives(warc.archive(df.limit(0))).collect() == []


def test_members_are_single_records(spark, tmp_path):
    import gzip

    df = spark.createDataFrame([(i, "u", f"page {i}") for i in range(20)], "page_id long, url string, html string")
    made = warc.archive(df.coalesce(1), folder=f"file://{tmp_path}").collect()
    for r in made:
        data = open(r.path.removeprefix("file://"), "rb").read()
        for line in open(r.index_path.removeprefix("file://")):
            offset, length, kind, urn = line.rstrip("\n").split("\t")
            record = gzip.decompress(data[int(offset) : int(offset) + int(length)])
            assert record.startswith(b"WARC/1.1") and urn.encode() in record and record.count(b"WARC/1.1") == 1 and kind == "response"
