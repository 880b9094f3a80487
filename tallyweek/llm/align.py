"""Alignment of two tokenizers' tokens over the same bytes, by products of incidence matrices.

A text's tokens are rows of a token-byte incidence matrix: a token holds a one for each
byte it covers. With A and B for two tokenizers, the entries of A·Bᵀ count the
bytes that two tokens share: the overlap links. Taking only each token's last byte gives the
tokens that end together, and token-group incidence, where groups are cut
at bytes where tokens of both end, gives the links inside groups. Matrices are CSR
(row starts and columns), and one Gustavson product serves all three: each row of the
product is the sum of the rows of Bᵀ that the row of A names.

Text is cut where white space opens after another character; no token of either
tokenizer crosses such a place, and tokens on one side do not depend on the other. Each
distinct stretch of a batch is encoded and aligned once, all of a batch in
one block-diagonal product, and a text's result is put together from its stretches.

The counts of id pairs cover the whole corpus. They are grouped from each text's distinct pairs
and joined back; a broadcast is left to tables of at most BROADCAST_ROWS pairs.

Model files are read by the driver and broadcast (2 MB).

Cases: null and empty texts, and texts whose tokens do not give the bytes back
(U+2581 comes back as a space), have no tokens; control strings in texts are
ordinary text; repeated rows count each and get a row each; null ids stay null; an
empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import hashlib
import json
import os
import re
from collections.abc import Iterator
from dataclasses import dataclass
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyweek.llm.common import held, slices, small, written

BYTE_MODEL = "/opt/tokenizers/byte_bpe_50k.json"
PIECE_MODEL = "/opt/tokenizers/piece_bpe_32k.model"
LINKS = ("ends", "overlap", "group")
# Text bytes that are aligned together, and stretches that are encoded as one text.
BATCH_BYTES, CALL = 8 << 20, 4096
# An id pair as one number: the first id times this, plus the second.
PAIR = 1 << 20
# White space before a space keeps the stretch going, as tokenizers look at the whole run.
ODD = re.compile("[\\s▁] |(?:^| )$|^ ")


@dataclass(frozen=True)
class Csr:
    """Rows of column numbers; every stored entry is a one."""

    starts: np.ndarray
    columns: np.ndarray

    @property
    def rows(self) -> np.ndarray:
        """The row of every entry."""
        return np.repeat(np.arange(len(self.starts) - 1), np.diff(self.starts))


def incidence(first: np.ndarray, last: np.ndarray) -> Csr:
    """Each row holds the columns first..last of its token."""
    counts = last - first + 1
    starts = np.concatenate([[0], np.cumsum(counts)])
    return Csr(starts, np.arange(starts[-1]) - np.repeat(starts[:-1] - first, counts))


def transposed(m: Csr, n_columns: int) -> Csr:
    order = np.argsort(m.columns, kind="stable")
    return Csr(np.concatenate([[0], np.cumsum(np.bincount(m.columns, minlength=n_columns))]), m.rows[order])


def gustavson(a: Csr, b: Csr, n_columns: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The product a·b as (row, column, value): for each row of `a` the sum of the rows of `b` that its entries name."""
    lengths = np.diff(b.starts)[a.columns]
    ends = np.cumsum(lengths)
    at = np.arange(ends[-1] if len(ends) else 0) - np.repeat(ends - lengths - b.starts[a.columns], lengths)
    entries, values = np.unique(np.repeat(a.rows, lengths) * n_columns + b.columns[at], return_counts=True)
    return entries // n_columns, entries % n_columns, values


def links(kind: str, a_ends: np.ndarray, b_ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(A token, B token, weight) of all linked tokens, which are given by the bytes where they end.

    `overlap` links tokens that share a byte, weighted by how many they share, `ends` those whose last
    byte is the same, `group` those between the same two bytes where both tokenizers cut.
    """
    if kind == "ends":
        sides = [incidence(e - 1, e - 1) for e in (a_ends, b_ends)]
    elif kind == "overlap":
        sides = [incidence(np.concatenate([[0], e[:-1]]), e - 1) for e in (a_ends, b_ends)]
    elif kind == "group":
        sides = [incidence(g, g) for g in groups(a_ends, b_ends)]
    else:
        raise ValueError(f"links must be one of {LINKS}")
    n = int(max((s.columns.max() for s in sides if len(s.columns)), default=-1)) + 1
    return gustavson(sides[0], transposed(sides[1], n), max(1, len(b_ends)))


def groups(a_ends: np.ndarray, b_ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The group of every token; a group ends where tokens of both end."""
    shared = np.intersect1d(a_ends, b_ends, assume_unique=True)
    return np.searchsorted(shared, a_ends), np.searchsorted(shared, b_ends)


def byte_alphabet() -> dict[str, int]:
    """The characters that stand for bytes in byte-level pieces: printable ones for themselves, the rest from U+0100 on."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in shown]
    return {chr(b): b for b in shown} | {chr(0x100 + i): b for i, b in enumerate(hidden)}


class Aligner:
    """Both tokenizers, and the bytes of their tokens."""

    def __init__(self, byte_model: bytes, piece_model: bytes):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # tasks already use all cores
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_str(byte_model.decode())
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_proto=piece_model)
        alphabet = byte_alphabet()
        spec = json.loads(byte_model)
        vocab = {i: bytes(alphabet[c] for c in piece) for piece, i in spec["model"]["vocab"].items()}
        vocab |= {t["id"]: t["content"].encode() for t in spec["added_tokens"]}
        self.a_bytes = [vocab.get(i, b"") for i in range(max(vocab) + 1)]
        pieces = [self.b.id_to_piece(i) for i in range(self.b.vocab_size())]
        self.b_bytes = [bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace("▁", " ").encode() for i, p in enumerate(pieces)]
        self.a_sizes, self.b_sizes = (np.array([len(x) for x in table]) for table in (self.a_bytes, self.b_bytes))

    def encode(self, stretches: list[str]) -> Iterator[tuple[np.ndarray, ...]]:
        """(whether the bytes come back, A ids, A tokens of each, B ids, B tokens of each) of stretches in a row, which are given without the space in front.

        They are encoded as one text; where that does not come back, its halves are.
        """
        text = " " + " ".join(stretches)
        whole, ends = text.encode("utf-8", "surrogatepass"), np.cumsum([len(s.encode("utf-8", "surrogatepass")) + 1 for s in stretches])
        ids = np.array(self.a.encode_batch_fast([text], add_special_tokens=False)[0].ids, np.int64), np.array(self.b.encode(text[1:]), np.int64)
        tables = (self.a_bytes, self.a_sizes), (self.b_bytes, self.b_sizes)
        cut = [np.cumsum(sizes[x]) for x, (_, sizes) in zip(ids, tables)]
        if all(b"".join(map(table.__getitem__, x.tolist())) == whole and np.isin(ends, c).all() for x, (table, _), c in zip(ids, tables, cut)):
            a, b = (np.diff(np.searchsorted(c, ends, "right"), prepend=0) for c in cut)
            yield np.ones(len(stretches), bool), ids[0], a, ids[1], b
        elif len(stretches) == 1:
            none = np.empty(0, np.int64)
            yield np.zeros(1, bool), none, np.zeros(1, np.int64), none, np.zeros(1, np.int64)
        else:
            half = len(stretches) // 2
            yield from self.encode(stretches[:half])
            yield from self.encode(stretches[half:])

    def aligned(self, stretches: list[str], n_plain: int, kind: str) -> dict[str, object]:
        """Of each stretch: whether its bytes come back, its tokens, groups, linked id pairs and groups as text.

        Another stretch may stand behind the first n_plain ones; the others stand at the ends of texts.
        """
        rows_of = [stretches[i : min(n_plain, i + CALL)] for i in range(0, n_plain, CALL)] + [[s] for s in stretches[n_plain:]]
        encoded = [part for row in rows_of for part in self.encode(row)]
        good, a_ids, n_a, b_ids, n_b = (np.concatenate([p[c] for p in encoded] or [np.empty(0, np.int64)]) for c in range(5))
        a_ends, b_ends = np.cumsum(self.a_sizes[a_ids]), np.cumsum(self.b_sizes[b_ids])
        of_a = np.repeat(np.arange(len(stretches)), n_a)
        ga, gb = groups(a_ends, b_ends)
        n_groups = np.bincount(of_a[np.flatnonzero(np.diff(ga, append=-1))], minlength=len(stretches))
        rows, columns, _ = links(kind, a_ends, b_ends)
        return {
            "good": good.astype(bool), "n_a": n_a, "n_b": n_b, "n_groups": n_groups, "texts": _written_groups(a_ids, b_ids, ga, gb, n_groups),
            "pairs": a_ids[rows] * PAIR + b_ids[columns], "n_links": np.bincount(of_a[rows], minlength=len(stretches)),
        }


def _written_groups(a_ids: np.ndarray, b_ids: np.ndarray, ga: np.ndarray, gb: np.ndarray, n_groups: np.ndarray) -> pa.Array:
    """Each stretch's groups as `a1,a2|b1;a3|b2`."""

    def joined(ids: np.ndarray, group: np.ndarray, n: int) -> pa.Array:
        offsets = np.searchsorted(group, np.arange(n + 1))
        return pc.binary_join(pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(ids).cast(pa.string())), ",")

    n = int(n_groups.sum())
    both = pc.binary_join_element_wise(joined(a_ids, ga, n), joined(b_ids, gb, n), "|")
    offsets = np.concatenate([[0], np.cumsum(n_groups)])
    return pc.binary_join(pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), both), ";")


def stretches_of(text: str) -> list[str]:
    """The stretches of a text with a space in front, each without its own first space."""
    if not ODD.search(text):
        return text.split(" ")
    body = text.rstrip(" ")
    out: list[str] = []
    for part in body.split(" ") if body else [""]:
        if out and (not out[-1] or out[-1][-1].isspace() or out[-1][-1] == "▁"):
            out[-1] += " " + part
        else:
            out.append(part)
    out[-1] += text[len(body) :]
    return out


def _per_text(values: np.ndarray, codes: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Sums of a stretch's values over the stretches of each text."""
    sums = np.concatenate([[0], np.cumsum(values[codes])])
    return sums[offsets[1:]] - sums[offsets[:-1]]


def _align_texts(of: Aligner, texts: list[str | None], kind: str) -> list[pa.Array]:
    parts = [stretches_of(t) if t else [] for t in texts]
    offsets = np.concatenate([[0], np.cumsum([len(p) for p in parts])])
    flat = pa.array([s for p in parts for s in p], pa.string()).dictionary_encode()
    del parts
    stretches = flat.dictionary.to_pylist()
    at_end = np.array([not s or s[-1].isspace() or s[-1] == "▁" for s in stretches], bool)
    order = np.argsort(at_end, kind="stable")
    codes = np.argsort(order)[flat.indices.to_numpy()]
    found = of.aligned([stretches[i] for i in order], int(len(order) - at_end.sum()), kind)
    bad = _per_text((~found["good"]).astype(np.int64), codes, offsets) > 0
    # A text that does not come back as a whole has no stretches.
    codes = codes[~np.repeat(bad, np.diff(offsets))]
    offsets = np.concatenate([[0], np.cumsum(np.where(bad, 0, np.diff(offsets)))])
    counts = [_per_text(found[c], codes, offsets) for c in ("n_a", "n_b", "n_groups", "n_links")]
    shown, named = found["texts"].to_pylist(), codes.tolist()
    digests = [
        hashlib.sha256(";".join(map(shown.__getitem__, named[i:j])).encode()).hexdigest() if n else ""
        for i, j, n in zip(offsets.tolist(), offsets[1:].tolist(), counts[0].tolist())
    ]
    # The linked pairs of every text, each distinct one with how often it occurs there.
    lengths = found["n_links"][codes]
    ends = np.cumsum(lengths)
    firsts = (np.cumsum(found["n_links"]) - found["n_links"])[codes]
    at = np.arange(ends[-1] if len(ends) else 0) - np.repeat(ends - lengths - firsts, lengths)
    local, pair = np.unique(found["pairs"], return_inverse=True)
    of_text = np.repeat(np.arange(len(texts)), counts[3])
    entries, times = np.unique(of_text * max(1, len(local)) + pair[at], return_counts=True)
    rows = np.searchsorted(entries, np.arange(len(texts) + 1) * max(1, len(local))).astype(np.int32)
    pairs = local[entries % max(1, len(local))] if len(entries) else np.empty(0, np.int64)
    lists = [pa.ListArray.from_arrays(pa.array(rows), pa.array(x, pa.int64())) for x in (pairs, times)]
    return [*(pa.array(c, pa.int64()) for c in counts), pa.array(digests, pa.string()), *lists]


FIELDS = ("n_a", "n_b", "n_groups", "n_links", "groups_sha256", "pairs", "times")


def aligned(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", links: str = "ends", byte_model: str = BYTE_MODEL, piece_model: str = PIECE_MODEL) -> DataFrame:
    """(doc_id, n_a, n_b, n_groups, n_links, groups_sha256, pairs, times) of every row; times says how often the text holds a linked id pair."""
    if links not in LINKS:
        raise ValueError(f"links must be one of {LINKS}")
    shared = docs.sparkSession.sparkContext.broadcast((Path(byte_model).read_bytes(), Path(piece_model).read_bytes()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of = held(("align", byte_model, piece_model), lambda: Aligner(*shared.value))
        for b in batches:
            for part in slices(b, 1, BATCH_BYTES):
                yield pa.RecordBatch.from_arrays([part.column(0), *_align_texts(of, part.column(1).to_pylist(), links)], ["doc_id", *FIELDS])

    read = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return read.mapInArrow(run, "doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, pairs array<long>, times array<long>")


def pair_counts(rows: DataFrame) -> DataFrame:
    """(pair, a_id, b_id, count, is_best) of every linked id pair; the best ones of a B id have its highest count."""
    counts = rows.select(F.inline(F.arrays_zip("pairs", "times"))).groupBy(F.col("pairs").alias("pair")).agg(F.sum("times").alias("count"))
    counts = written(counts.withColumns({"a_id": F.floor(F.col("pair") / PAIR), "b_id": F.col("pair") % PAIR}), "pair_counts")
    most = counts.groupBy("b_id").agg(F.max("count").alias("most"))
    return counts.join(most, "b_id").select("pair", "a_id", "b_id", "count", (F.col("count") == F.col("most")).alias("is_best"))


def align(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", links: str = "ends", **models: str) -> DataFrame:
    """(doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256) of every row.

    n_best counts the links whose pair is a best one of its B id, count_sum adds the corpus-wide counts of all links.
    """
    rows = written(aligned(docs, id_col, text_col, links, **models).withColumn("row", F.monotonically_increasing_id()), "aligned")
    counts = written(pair_counts(rows).select("pair", "count", "is_best"), "pairs")
    each = rows.select("row", F.inline(F.arrays_zip("pairs", "times"))).withColumnRenamed("pairs", "pair")
    best = F.sum(F.when(F.col("is_best"), F.col("times")).otherwise(0)).alias("n_best")
    scores = each.join(small(counts), "pair").groupBy("row").agg(best, F.sum(F.col("times") * F.col("count")).alias("count_sum"))
    joined = rows.drop("pairs", "times").join(scores, "row", "left")
    filled = {c: F.coalesce(c, F.lit(0).cast("long")) for c in ("n_best", "count_sum")}
    return joined.withColumns(filled).select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")
