"""The stages of the corpus pipeline, each on its own input."""

import random

import corpus_pipeline
from tallyweek.llm import simhash


def test_names():
    assert [name for name, _ in corpus_pipeline.STAGES] == ["language_id", "simhash_near_dedup", "suffix_array_dedup", "benchmark_decontamination", "sentencepiece"]


def test_stages_follow_their_operators(spark, small):
    from test_dedup import brute, grams, groups, shared, simple_fingerprint

    docs = spark.read.parquet(f"{small}/documents.parquet")
    columns, stages = docs.columns, dict(corpus_pipeline.STAGES)
    before = {r.doc_id: r.text for r in docs.collect()}

    docs = stages["language_id"](spark, docs, small)
    after = {r.doc_id: r.text for r in docs.collect()}
    assert after == {i: t for i, t in before.items() if any(c.isalpha() for c in t)} and docs.columns == columns

    docs = stages["simhash_near_dedup"](spark, docs, small)
    ids = sorted(after)
    root = groups([simple_fingerprint(after[i]) for i in ids], lambda a, b: (a ^ b).bit_count() <= 2)
    after = {i: after[i] for i, r in zip(ids, root) if ids[r] == i}
    assert {r.doc_id: r.text for r in docs.collect()} == after and docs.columns == columns

    docs = stages["suffix_array_dedup"](spark, docs, small)
    got = {r.doc_id: r for r in docs.collect()}
    for i, (n, cut, _, _) in zip(sorted(after), brute([after[i].encode() for i in sorted(after)], corpus_pipeline.CUT_BYTES)):
        assert n - cut - 6 <= len(got[i].text.encode()) <= n - cut and got[i].n_chars == len(got[i].text)
    assert set(got) == set(after) and docs.columns == columns

    docs = stages["benchmark_decontamination"](spark, docs, small)
    items = [r.text for r in spark.read.parquet(f"{small}/benchmark.parquet").collect() if grams(r.text)]
    clean = {i for i, r in got.items() if not any(shared(t, r.text) >= 0.8 * len(grams(t)) for t in items)}
    assert {r.doc_id for r in docs.collect()} == clean and len(clean) < len(got) and docs.columns == columns

    last = stages["sentencepiece"](spark, docs, small).collect()
    assert {r.doc_id for r in last} == clean and all(r.same for r in last)
    assert {r.doc_id: r.n_ids for r in corpus_pipeline.run(spark, small).collect()} == {r.doc_id: r.n_ids for r in last}


def test_edges(spark, small):
    rows = [(1, None, None, None, 0, 0), (2, "", "en", "s", 0, 0), (3, "123", "en", "s", 3, 0), (None, "some words here", None, "s", 15, 0), (4, "Some words here", "en", "s", 15, 0), (4, "Some words here", "en", "s", 15, 0), (5, "more " * 200_000, "en", "s", 1, 0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, _row_key int")
    docs = docs.withColumnRenamed("_row_key", "fp")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = simhash.written(stage(spark, docs, small), "edge")
        assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars", "fp"]
        stage(spark, docs.limit(0), small).collect()
    assert {r.doc_id for r in docs.collect()} == {4, 5}


def test_benchmark_passages_without_ids_of_their_own(spark, tmp_path):
    passages = {i: " ".join(f"{c}{k}" for k in range(20)) for i, c in enumerate("abcd")}
    bench = [(None, passages[0]), (None, passages[1]), (7, passages[2]), (7, passages[3]), (8, None)]
    spark.createDataFrame(bench, "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    docs = [(i, f"before it {t} after it") for i, t in passages.items()] + [(10, " ".join(f"e{k}" for k in range(20))), (11, None)]
    got = corpus_pipeline.drop_benchmark_leaks(spark, spark.createDataFrame(docs, "doc_id long, text string"), str(tmp_path))
    assert sorted(r.doc_id for r in got.collect()) == [10, 11]


def test_planted_passages_go_and_clean_documents_stay(spark):
    r = random.Random(4)
    word = lambda: "".join(r.choices("aeinorstlu", k=r.choice((2, 3, 4, 5, 6, 7, 8))))
    passages = [" ".join(word() for _ in range(51 + i)) for i in range(6)]
    texts = [" ".join(word() for _ in range(60)) for _ in range(60)]
    planted = [f"{t} {passages[i % 6]} {word()}" for i, t in enumerate(texts[:24])]
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(planted + texts[24:])], "doc_id long, text string")
    got = {row.doc_id: row.text for row in corpus_pipeline.cut_repeats(spark, docs, "").collect()}
    assert not any(p[len(p) // 2 :][:40] in got[i] for i in range(24) for p in passages)
    # What stands beside a passage goes with it where it happens to be alike.
    assert all(got[i].startswith(texts[i][:-9]) for i in range(24)) and all(got[i] == texts[i] for i in range(24, 60))


def test_columns_named_like_helpers_stay(spark, small):
    rows = [(i, f"words of text number {i} and {i * 7} stand here for {i * i}", "en", 7, 8, 9) for i in range(6)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, _row_key int, _Doc_Key int, _starts int")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = simhash.written(stage(spark, docs, small), "named")
        assert docs.columns == ["doc_id", "text", "lang", "_row_key", "_Doc_Key", "_starts"]
    assert all(tuple(r)[3:] == (7, 8, 9) for r in docs.collect()) and docs.count() == 6
