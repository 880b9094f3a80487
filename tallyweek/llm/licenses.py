"""License scans by diagonal voting.

All runs of k words of all texts are hashed and joined to the runs of the license
templates; words are compared as well, so a hash never decides. A hit votes for
its diagonal, document position minus template position: all hits of one
alignment lie on one diagonal, and votes are counted by document, template and
diagonal. Diagonals at most DRIFT apart are merged, since inserted or dropped words shift the
rest of a text to a neighbouring diagonal. A span is verified if, on one diagonal or
the merged ones, at least COVER of the template's words are matched within a
span of at most STRETCH times the template's length.

A base phrase is found where all its runs vote on one diagonal.

Matched words are bits, CHUNK to a number, so templates may have any length. The template
table is a constant of the code and so of bounded size. Everything is one scan: each
row sends one marker through the join, so rows without hits stay.

Cases: null is an empty text; texts under k words have no runs; rows alike in id and text vote
as one and each get their row; phrases that overlap or repeat count each time; an empty table gives an
empty result; other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tallyweek.llm.common import ascii_lower, content_key, word_grams, words

K, DRIFT, COVER, STRETCH = 3, 3, 0.8, 1.5
# Words that one number holds as bits, and copies of a row that are listed at once.
CHUNK, COPIES = 60, 10_000
# Phrases that count as places, with their labels.
BASE = [("under the mit license", "mit"), ("apache license version 2", "apache-2"), ("cc by nc", "cc-by-nc")]
# Further notices and whole licenses that the voting looks for.
TEMPLATES = [
    ("permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files", "mit"),
    ("licensed under the apache license version 2 0", "apache-2"),
    ("you may not use this file except in compliance with the license you may obtain a copy of the license at", "apache-2"),
    ("creative commons attribution noncommercial 4 0 international license", "cc-by-nc"),
    ("creative commons attribution 4 0 international license", "cc-by"),
    ("creative commons attribution sharealike 4 0 international license", "cc-by-sa"),
    ("this work is licensed under the gnu general public license version 3", "gpl-3"),
    ("under the terms of the gnu general public license as published by the free software foundation", "gpl"),
    ("under the terms of the gnu lesser general public license as published by the free software foundation", "lgpl"),
    ("redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met", "bsd"),
    ("this source code form is subject to the terms of the mozilla public license v 2 0", "mpl-2"),
    ("this is free and unencumbered software released into the public domain", "unlicense"),
    ("permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted", "isc"),
    (
        "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software "
        "to deal in the software without restriction including without limitation the rights to use copy modify merge publish distribute sublicense and or sell "
        "copies of the software and to permit persons to whom the software is furnished to do so subject to the following conditions "
        "the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software "
        "the software is provided as is without warranty of any kind express or implied including but not limited to the warranties of merchantability "
        "fitness for a particular purpose and noninfringement in no event shall the authors or copyright holders be liable for any claim damages or other liability "
        "whether in an action of contract tort or otherwise arising from out of or in connection with the software or the use or other dealings in the software",
        "mit",
    ),
    (
        "licensed under the apache license version 2 0 the license you may not use this file except in compliance with the license "
        "you may obtain a copy of the license at http www apache org licenses license 2 0 "
        "unless required by applicable law or agreed to in writing software distributed under the license is distributed on an as is basis "
        "without warranties or conditions of any kind either express or implied "
        "see the license for the specific language governing permissions and limitations under the license",
        "apache-2",
    ),
    (
        "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met "
        "1 redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimer "
        "2 redistributions in binary form must reproduce the above copyright notice this list of conditions and the following disclaimer "
        "in the documentation and or other materials provided with the distribution "
        "3 neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software "
        "without specific prior written permission "
        "this software is provided by the copyright holders and contributors as is and any express or implied warranties including but not limited to "
        "the implied warranties of merchantability and fitness for a particular purpose are disclaimed "
        "in no event shall the copyright holder or contributors be liable for any direct indirect incidental special exemplary or consequential damages "
        "including but not limited to procurement of substitute goods or services loss of use data or profits or business interruption "
        "however caused and on any theory of liability whether in contract strict liability or tort including negligence or otherwise "
        "arising in any way out of the use of this software even if advised of the possibility of such damage",
        "bsd-3",
    ),
    (
        "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted "
        "provided that the above copyright notice and this permission notice appear in all copies "
        "the software is provided as is and the author disclaims all warranties with regard to this software including all implied warranties of merchantability and fitness "
        "in no event shall the author be liable for any special direct indirect or consequential damages or any damages whatsoever resulting from loss of use data or profits "
        "whether in an action of contract negligence or other tortious action arising out of or in connection with the use or performance of this software",
        "isc",
    ),
]
# What tells the lines of a row apart, and those of a template in it.
ROW = ["key", "key2", "doc_id", "n_words"]
LINE = [*ROW, "template", "label", "is_base", "size"]


def bits_of(first: int, n: int) -> list[tuple[int, int]]:
    """(chunk, bits) of the words first, first + 1, ... of a template."""
    bits: dict[int, int] = {}
    for word in range(first, first + n):
        bits[word // CHUNK] = bits.get(word // CHUNK, 0) | 1 << word % CHUNK
    return list(bits.items())


def template_runs(spark: SparkSession, base: list[tuple[str, str]], templates: list[tuple[str, str]], k: int) -> DataFrame:
    """(template, label, is_base, size, t_pos, covers, t0.., h) of every run of every template, and one row that matches the marker."""
    rows = [(-1, "", False, 1, 0, [(0, 0)], *[None] * k)]
    for number, (text, label) in enumerate(base + templates):
        tokens = text.split()
        if len(tokens) < k:
            raise ValueError(f"a template must have {k} words: {text}")
        rows += [(number, label, number < len(base), len(tokens), i, bits_of(i, k), *tokens[i : i + k]) for i in range(len(tokens) - k + 1)]
    fields = "template int, label string, is_base boolean, size int, t_pos int, covers array<struct<chunk: int, bits: long>>, " + ", ".join(f"t{i} string" for i in range(k))
    return spark.createDataFrame(rows, fields).withColumn("h", F.xxhash64(*[f"t{i}" for i in range(k)]))


def votes(docs: DataFrame, id_col: str, text_col: str, base: list[tuple[str, str]], templates: list[tuple[str, str]], k: int = K) -> DataFrame:
    """(LINE..., diagonal, chunk, seen, n): seen has a bit for each word that a run matches, n counts the votes.

    Every row of `docs` votes once for template -1 besides. key and key2 are hashes of id and text.
    """
    keys = content_key(id_col, text_col).alias("key"), content_key(F.lit("second"), text_col, id_col).alias("key2")
    tokens = docs.select(*keys, F.col(id_col).cast("long").alias("doc_id"), words(ascii_lower(F.col(text_col))).alias("w"))
    marker = F.array(F.struct(*[F.lit(None).cast("string").alias(f"w{i}") for i in range(k)]))
    runs = tokens.select("key", "key2", "doc_id", F.size("w").cast("long").alias("n_words"), F.posexplode(F.concat(marker, word_grams(F.col("w"), k))).alias("pos", "run"))
    runs = runs.withColumn("h", F.xxhash64(*[f"run.w{i}" for i in range(k)]))
    known = F.broadcast(template_runs(docs.sparkSession, base, templates, k))
    hits = runs.join(known, "h").where(" AND ".join(f"run.w{i} <=> t{i}" for i in range(k)))
    diagonal = F.when(F.col("template") >= 0, F.col("pos").cast("long") - 1 - F.col("t_pos")).alias("diagonal")
    covered = hits.select(*LINE, diagonal, F.inline("covers"))
    return covered.groupBy(*LINE, "diagonal", "chunk").agg(F.bit_or("bits").alias("seen"), F.count("*").alias("n"))


def spans(voted: DataFrame, drift: int = DRIFT, cover: float = COVER, stretch: float = STRETCH) -> DataFrame:
    """The lines of `votes`, with run (number of the merged diagonals), alone (words matched on the diagonal), coverage of the
    better of the diagonal and the merged ones, is_first (of the diagonal's lines) and is_verified."""
    start = F.col("diagonal") + F.col("chunk") * CHUNK
    first, last = start + F.expr("bit_count((seen & -seen) - 1)"), start + F.length(F.bin("seen")) - 1
    of = ["key", "key2", "doc_id", "template"]
    ordered = Window.partitionBy(*of).orderBy("diagonal", "chunk")
    near = F.coalesce(F.col("diagonal") - F.lag("diagonal").over(ordered) <= drift, F.lit(False))
    placed = voted.withColumn("first", first).withColumn("last", last).withColumn("starts", F.when(near, 0).otherwise(1))
    placed = placed.withColumn("run", F.sum("starts").over(ordered.rowsBetween(Window.unboundedPreceding, 0)))
    # Words that several diagonals of a run match count once.
    chunk = Window.partitionBy(*of, "run", "chunk")
    placed = placed.withColumn("all_seen", F.bit_or("seen").over(chunk)).withColumn("place", F.row_number().over(chunk.orderBy("diagonal")))
    merged, own = Window.partitionBy(*of, "run"), Window.partitionBy(*of, "run", "diagonal")
    placed = placed.withColumn("together", F.sum(F.when(F.col("place") == 1, F.bit_count("all_seen"))).over(merged))
    placed = placed.withColumn("length", F.max("last").over(merged) - F.min("first").over(merged) + 1)
    placed = placed.withColumn("alone", F.sum(F.bit_count("seen")).over(own)).withColumn("is_first", F.row_number().over(own.orderBy("chunk")) == 1)
    fits = F.col("length") <= F.col("size") * F.lit(stretch)
    placed = placed.withColumn("coverage", F.when(fits, F.greatest("alone", "together")).otherwise(F.col("alone")) / F.col("size"))
    return placed.withColumn("is_verified", F.coalesce((F.col("template") >= 0) & (F.col("coverage") >= cover - 1e-9), F.lit(False))).drop("starts", "all_seen", "place", "length")


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", base: list[tuple[str, str]] | None = None, templates: list[tuple[str, str]] | None = None, k: int = K) -> DataFrame:
    """(doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score) of every row.

    score: the best coverage of a verified span, 0 without one.
    """
    voted = votes(docs, id_col, text_col, BASE if base is None else base, TEMPLATES if templates is None else templates, k)
    found = spans(voted)
    whole = F.col("is_base") & F.col("is_first") & (F.col("alone") == F.col("size"))
    listed = lambda condition: F.array_join(F.array_sort(F.collect_set(F.when(condition, F.col("label")))), ",")
    out = found.groupBy(*ROW).agg(
        F.max(F.when(F.col("template") < 0, F.col("n"))).alias("copies"),
        F.count(F.when(whole, 1)).alias("n_base"),
        F.min(F.when(whole, F.col("diagonal"))).alias("first_word"),
        F.max(F.when(whole, F.col("diagonal"))).alias("last_word"),
        listed(whole).alias("base_labels"),
        listed(whole | F.col("is_verified")).alias("labels"),
        F.coalesce(F.max(F.when(whole, 1.0).when(F.col("is_verified"), F.least(F.col("coverage"), F.lit(1.0)))), F.lit(0.0)).alias("score"),
    )
    # Rows alike come back as they were, in parts, so that no list of them grows with the table.
    parts = out.withColumn("part", F.explode(F.sequence(F.lit(0).cast("long"), F.col("copies") - 1, F.lit(COPIES).cast("long"))))
    each = parts.withColumn("copy", F.explode(F.sequence("part", F.least(F.col("part") + COPIES, F.col("copies")) - 1)))
    return each.drop("key", "key2", "copies", "part", "copy")
