"""A training corpus from raw documents, in stages that each call one operator.

A stage takes (spark, docs, sf_dir) and returns a table: all but the last return the
columns of documents, the last one token ids. Each result is written as Parquet
and read again as the next one's input.

1. language ID: texts without a letter, or null, go, and those predicted in another language than
   LANGUAGES; a null lang becomes the predicted one.
2. SimHash near-dedup: of each group of near copies the one with the smallest doc_id stays.
3. suffix-array dedup: strings of CUT_BYTES bytes that occur more than once are cut out of the
   texts, and n_chars follows. A passage of over 50 words is longer than that, even where its words are short.
4. benchmark decontamination: documents that contain a benchmark passage go, whatever its item_id.
5. SentencePiece: ids of each text, and whether they decode to it.

Cases: every stage takes null ids and texts, repeated rows, empty tables and
further columns, which it hands on; see the operators.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyweek.llm import decontaminate, language, pieces, simhash, substrings
from tallyweek.llm.common import written
from tallyweek.llm.queries import table

# Languages of the corpus.
LANGUAGES = ["de", "en", "es", "fr"]
# The executors still hold the heap of the shuffling stages; smaller tables leave the piece workers room beside it.
KEPT_STRETCHES = 30_000
# Repeated strings of this many bytes go: 50 words of 4.8 bytes, spaces counted.
CUT_BYTES = 240


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return language.keep_known(docs, languages=LANGUAGES)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash.keep_one(docs, width=3, max_bits=2)


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    cut = substrings.without_repeats(docs, length=CUT_BYTES)
    return cut.withColumn("n_chars", F.length("text").cast("long")) if "n_chars" in docs.columns else cut


def drop_benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.clean(docs, decontaminate.by_passage(table(spark, sf_dir, "benchmark")))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return pieces.round_trip(docs, kept=KEPT_STRETCHES)


STAGES = [
    ("language_id", identify_language),
    ("simhash_near_dedup", drop_near_copies),
    ("suffix_array_dedup", cut_repeats),
    ("benchmark_decontamination", drop_benchmark_leaks),
    ("sentencepiece", encode),
]

# SQL has no SimHash, cross-parsing or piece model; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), name)
    return docs
