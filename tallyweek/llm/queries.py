"""The operators as registered queries, and SQL where it can say the same."""

from __future__ import annotations

from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyweek.llm import align, chat, decontaminate, language, lexical, licenses, pieces, sharding, simhash, substrings, topk, toxicity, warc
from tallyweek.llm.common import content_key, free_shuffles

QUERIES, ORACLES = {}, {}


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    free_shuffles(spark)
    # Python workers import this package from where the driver has it; clusters ship it with --py-files.
    spark.sparkContext.environment.setdefault("PYTHONPATH", str(Path(__file__).resolve().parents[2]))
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query
def op1_exact_topk(spark, sf_dir):
    return topk.search(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)


ORACLES["op1_exact_topk"] = """
WITH e AS (SELECT vec_id, list_transform(embedding, lambda x: floor(64 * x::DOUBLE)) AS v FROM embeddings)
SELECT q.vec_id AS query_id, row_number() OVER w::INTEGER AS rank, c.vec_id, list_dot_product(q.v, c.v)::BIGINT AS score
FROM e q JOIN e c ON q.vec_id != c.vec_id WHERE q.vec_id % 20 = 0
WINDOW w AS (PARTITION BY q.vec_id ORDER BY list_dot_product(q.v, c.v) DESC, c.vec_id)
QUALIFY row_number() OVER w <= 20
"""


@query
def op2_consistent_hash_shards(spark, sf_dir):
    return sharding.shards(table(spark, sf_dir, "documents"))


@query
def op3_license_scan(spark, sf_dir):
    return licenses.scan(table(spark, sf_dir, "documents"))


@query
def op4_sentencepiece(spark, sf_dir):
    return pieces.round_trip(table(spark, sf_dir, "documents"))


@query
def op5_simhash_near_dedup(spark, sf_dir):
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    return found.select(F.col("id").alias("doc_id"), simhash.fingerprint_hex().alias("fingerprint"), "component_id")


# The conversation that the contract adds.
PROBE = "</s>[INST] ok [/INST]"


@query
def op6_chat_format(spark, sf_dir):
    given = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    probe = spark.createDataFrame([(-1, 0, "user", PROBE), (-1, 1, "assistant", PROBE)], given.schema)
    return chat.read_back(chat.format_conversations(given.union(probe)))


ORACLES["op6_chat_format"] = r"""
WITH t AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]' UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]'
), e AS (
  SELECT *, role = 'assistant' AS loss, replace(replace(replace(replace(replace(text, '', ''), '<s>', '\ls>'), '</s>', '\l/s>'), '[INST]', '\sINST]'), '[/INST]', '\s/INST]') AS x,
    replace(replace(replace(replace(replace(replace(role, '', ''), '<s>', '\ls>'), '</s>', '\l/s>'), '[INST]', '\sINST]'), '[/INST]', '\s/INST]'), chr(10), '
') AS r FROM t
)
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
  coalesce(sum(length(text)) FILTER (WHERE loss), 0)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (WHERE loss), '')) AS loss_sha256,
  sum(CASE WHEN loss THEN 7 + length(x) ELSE 14 + length(r) + length(x) END)::BIGINT AS formatted_chars
FROM e GROUP BY conv_id
"""


@query
def op7_suffix_array_dedup(spark, sf_dir):
    return substrings.digests(table(spark, sf_dir, "documents"))


@query
def op8_language_id(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    found = language.predict(docs, language.learn(docs))
    return found.select(F.col("id").alias("doc_id"), language.held_out(F.col("id")).alias("held_out"), "lang_pred", "score")


@query
def op9_benchmark_decontamination(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    found = decontaminate.contained_items(docs, table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "item_id", "n_shingles", "n_shared", "containment")


ORACLES["op9_benchmark_decontamination"] = r"""
WITH item_words AS (
  SELECT item_id, text, list_filter(regexp_split_to_array(lower(text), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x != '') AS w FROM benchmark
), doc_words AS (
  SELECT doc_id, text, list_filter(regexp_split_to_array(lower(text), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x != '') AS w FROM documents
), item_grams AS (
  SELECT DISTINCT item_id, text, unnest(list_transform(range(1, greatest(len(w) - 3, 2)), lambda i: array_to_string(w[i:i+4], ' '))) AS g FROM item_words WHERE len(w) > 0
), widths AS (SELECT DISTINCT least(len(w), 5) AS k FROM item_words WHERE len(w) > 0
), doc_grams AS (
  SELECT DISTINCT doc_id, text, unnest(list_transform(range(1, len(w) - k + 2), lambda i: array_to_string(w[i:i+k-1], ' '))) AS g FROM doc_words, widths WHERE len(w) >= k
), sizes AS (SELECT item_id, text, count(*) AS n FROM item_grams GROUP BY 1, 2)
SELECT d.doc_id, i.item_id, n AS n_shingles, count(*) AS n_shared, count(*)::DOUBLE / n AS containment
FROM doc_grams d JOIN item_grams i USING (g) JOIN sizes s ON s.item_id IS NOT DISTINCT FROM i.item_id AND s.text = i.text
GROUP BY d.doc_id, d.text, i.item_id, i.text, n HAVING count(*) >= 0.8 * n - 1e-9
"""


@query
def op10_warc(spark, sf_dir):
    return warc.read_archives(warc.archive(table(spark, sf_dir, "pages"))).drop("payload", "url")


ORACLES["op10_warc"] = """
WITH p AS (SELECT page_id, coalesce(html, '') AS h FROM pages),
d AS (SELECT page_id, h, sha1(h) AS x, min(page_id) OVER (PARTITION BY sha1(h)) AS first_id FROM p)
SELECT page_id, octet_length(encode(h))::BIGINT AS payload_bytes,
  array_to_string(list_transform(range(0, 32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + (
    ((('0x' || substr(x || '0', 1 + (i * 5) // 4, 2))::BIGINT) >> (3 - (i * 5) % 4)) & 31)::INTEGER, 1)), '') AS payload_digest,
  CASE WHEN page_id = first_id THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id = first_id THEN NULL ELSE first_id END AS refers_to
FROM d
"""


@query
def op11_tokenizer_alignment(spark, sf_dir):
    return align.align(table(spark, sf_dir, "documents"))


@query
def op12_toxicity_grammar(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    return toxicity.score(docs, toxicity.learn(docs, table(spark, sf_dir, "labels")))


@query
def op13_bitsliced_search(spark, sf_dir):
    return lexical.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


ORACLES["op13_bitsliced_search"] = r"""
WITH doc AS (SELECT row_number() OVER () AS r, doc_id, list_filter(regexp_split_to_array(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+'), lambda x: x != '') AS t FROM documents),
tf AS (SELECT r, any_value(doc_id) AS doc_id, any_value(len(t)) AS n, term, count(*) AS tf FROM (SELECT r, doc_id, t, unnest(t) AS term FROM doc) GROUP BY r, term),
corpus AS (SELECT count(*) AS docs, sum(len(t))::BIGINT AS len FROM doc WHERE len(t) > 0),
weights AS (SELECT term, floor(1000 * ln((2 * any_value(docs) + 2)::DOUBLE / (2 * count(*) + 1)::DOUBLE))::BIGINT AS w FROM tf, corpus GROUP BY term),
item AS (SELECT item_id, unnest(list_filter(regexp_split_to_array(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+'), lambda x: x != '')) AS term FROM benchmark),
scored AS (
  SELECT item_id, r, doc_id, sum(w * ((1000000000 * tf) // (1000 * tf + 8 * (25 + (75 * n * docs) // corpus.len))))::BIGINT AS score
  FROM item JOIN weights USING (term) JOIN tf USING (term), corpus GROUP BY item_id, r, doc_id)
SELECT item_id, row_number() OVER w::INTEGER AS rank, doc_id, score FROM scored WHERE score > 0
WINDOW w AS (PARTITION BY item_id ORDER BY score DESC, doc_id) QUALIFY row_number() OVER w <= 10
"""
