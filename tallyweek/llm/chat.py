"""Chat formatting by columnar byte assembly, and reading formatted text back.

A turn becomes `<s>text</s>` if its role is `assistant`, else `[INST]role\\ntext[/INST]`.
In texts and roles the first character of each control string is written as an
escape, and so is the escape character, which makes it reversible; the
assistant's text between `<s>` and `</s>` is under the loss mask.

A batch of turns is assembled as columns: lengths of headers, texts and footers
give offsets by a cumulative sum, scatter indices put all their bytes in one
preallocated buffer, which is the Arrow column of the output.

Turns are dealt by conversation and sorted by turn; a conversation is written in
parts of one line per batch, so a conversation that holds a third of all rows
passes through memory bit by bit. Only its digest, one hash over all its turns in order, is
sequential, as the contract defines it.

Cases: null roles and texts are empty; turns are ordered by turn (null first), then role and
text, so repeated rows and ties have one order; rows with null conv_id are one conversation of id null;
any role is allowed; an empty table gives no conversations; other columns are not read.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Fixed values of the template: control strings, and how they are told from text.
OPEN, CLOSE, TURN, END = "<s>", "</s>", "[INST]", "[/INST]"
ESCAPES = [("\\", "\\b"), (OPEN, "\\ls>"), (CLOSE, "\\l/s>"), (TURN, "\\sINST]"), (END, "\\s/INST]")]
ROLE_BREAK = ("\n", "\\n")
_BACK = {"\\b": "\\", "\\l": "<", "\\s": "[", "\\n": "\n"}
_TURNS = re.compile(r"<s>(.*?)</s>|\[INST\](.*?)\n(.*?)\[/INST\]", re.S)
ASSISTANT = "assistant"
PART_BYTES = 8 << 20


def escape(texts: pa.Array, more: tuple = ()) -> pa.Array:
    for plain, written in [*ESCAPES, *more]:
        texts = pc.replace_substring(texts, pattern=plain, replacement=written)
    return texts


def unescape(text: str) -> str:
    return re.sub(r"\\[blsn]", lambda m: _BACK[m[0]], text) if "\\" in text else text


def _bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a text column, and the lengths of its rows."""
    texts = texts.cast(pa.large_binary())
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = np.frombuffer(texts.buffers()[2], np.uint8)[offsets[0] : offsets[-1]] if texts.buffers()[2] else np.empty(0, np.uint8)
    return data, np.diff(offsets)


def assemble(segments: list[pa.Array], starts: np.ndarray) -> tuple[pa.Array, np.ndarray]:
    """One text per part from the rows of the segments, side by side; `starts` are the first rows of the parts.

    Also gives each row's segment offsets within its part, one column per segment and one for the end.
    """
    parts = [_bytes(s) for s in segments]
    lengths = np.stack([n for _, n in parts], axis=1)
    ends = np.cumsum(lengths.ravel()).reshape(lengths.shape)
    places = ends - lengths
    out = np.empty(int(ends[-1, -1]) if len(ends) else 0, np.uint8)
    for i, (data, n) in enumerate(parts):
        within = np.arange(len(data)) - np.repeat(np.cumsum(n) - n, n)
        out[np.repeat(places[:, i], n) + within] = data
    cuts = np.append(places[starts, 0], len(out)).astype(np.int32)
    column = pa.Array.from_buffers(pa.string(), len(starts), [None, pa.py_buffer(cuts), pa.py_buffer(out)])
    base = np.repeat(cuts[:-1], np.diff(np.append(starts, len(lengths))))
    return column, np.concatenate([places, ends[:, -1:]], axis=1) - base[:, None]


def format_batch(batch: pa.RecordBatch, first_part: int = 0) -> pa.RecordBatch:
    """Turns in order (conv_id, role, text) to (conv_id, part, formatted, loss_spans): a part for each conversation.

    loss_spans: byte offsets within the part, begin, end, begin, end, ...
    """
    roles, texts = (pc.fill_null(batch.column(c).cast(pa.large_string()), "") for c in ("role", "text"))
    is_assistant = pc.equal(roles, ASSISTANT)
    choose = lambda yes, no: pc.if_else(is_assistant, pa.scalar(yes, pa.large_string()), no)
    named = pc.binary_join_element_wise(pa.scalar(TURN, pa.large_string()), escape(roles, (ROLE_BREAK,)), pa.scalar("\n", pa.large_string()), pa.scalar("", pa.large_string()))
    segments = [choose(OPEN, named), escape(texts), choose(CLOSE, pa.scalar(END, pa.large_string()))]
    conv = batch.column("conv_id")
    known = np.asarray(pc.fill_null(conv, 0), np.int64)
    missing = np.asarray(pc.is_null(conv))
    starts = np.flatnonzero(np.append(True, (known[1:] != known[:-1]) | (missing[1:] != missing[:-1])))
    formatted, offsets = assemble(segments, starts)
    mask = np.asarray(is_assistant)
    counts = np.add.reduceat(mask.astype(np.int64), starts)
    spans = pa.ListArray.from_arrays(pa.array(np.append(0, 2 * np.cumsum(counts)).astype(np.int32)), pa.array(offsets[mask][:, 1:3].ravel().astype(np.int32)))
    parts = np.zeros(len(starts), np.int64)
    parts[0] = first_part
    return pa.RecordBatch.from_arrays([conv.take(pa.array(starts)), pa.array(parts), formatted, spans], ["conv_id", "part", "formatted", "loss_spans"])


def format_conversations(turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text", part_bytes: int = PART_BYTES) -> DataFrame:
    """(conv_id, part, formatted, loss_spans): the parts of a conversation in order make up its formatted text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, part = object(), 0
        for b in batches:
            for piece in pieces(b):
                out = format_batch(piece, part + 1 if piece.column("conv_id")[0].as_py() == last else 0)
                last, part = out.column("conv_id")[-1].as_py(), out.column("part")[-1].as_py()
                yield out

    def pieces(b: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        """A batch in runs of rows whose texts stay below part_bytes."""
        sizes = np.cumsum(np.asarray(pc.fill_null(pc.binary_length(b.column("text")), 0), np.int64))
        start = 0
        while start < b.num_rows:
            before = sizes[start - 1] if start else 0
            stop = max(start + 1, int(np.searchsorted(sizes, before + part_bytes, side="right")))
            yield b.slice(start, stop - start)
            start = stop

    rows = turns.select(F.col(conv_col).cast("long").alias("conv_id"), F.col(turn_col).alias("turn"), F.col(role_col).alias("role"), F.col(text_col).alias("text"))
    dealt = rows.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text").select("conv_id", "role", "text")
    return dealt.mapInArrow(run, "conv_id long, part long, formatted string, loss_spans array<int>")


class _Reader:
    """What the parts of one conversation say, part after part."""

    def __init__(self, conv_id: int | None):
        self.conv_id, self.n_turns, self.loss_chars, self.chars = conv_id, 0, 0, 0
        self.turns, self.loss = hashlib.sha256(), hashlib.sha256()

    def add(self, formatted: str, spans: list[int]) -> None:
        at = 0
        for m in _TURNS.finditer(formatted):
            if m.start() != at:
                raise ValueError(f"conversation {self.conv_id}: text between turns")
            at = m.end()
            role, text = (ASSISTANT, m[1]) if m[1] is not None else (unescape(m[2]), m[3])
            self.turns.update(f"{role}\n{unescape(text)}\n".encode())
            self.n_turns += 1
        if at != len(formatted):
            raise ValueError(f"conversation {self.conv_id}: an open turn")
        data = formatted.encode()
        for begin, end in zip(spans[::2], spans[1::2]):
            text = unescape(data[begin:end].decode())
            self.loss.update(text.encode())
            self.loss_chars += len(text)
        self.chars += len(formatted)

    def row(self) -> tuple:
        return self.conv_id, self.n_turns, self.turns.hexdigest(), self.loss_chars, self.loss.hexdigest(), self.chars


def read_back(formatted: DataFrame) -> DataFrame:
    """(conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars) of every formatted conversation."""
    names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
    kinds = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, done = None, []
        for b in batches:
            for conv_id, text, spans in zip(*(b.column(c) for c in ("conv_id", "formatted", "loss_spans"))):
                if now is None or conv_id.as_py() != now.conv_id:
                    done += [now.row()] if now else []
                    now = _Reader(conv_id.as_py())
                now.add(text.as_py(), spans.as_py())
            yield batch(done)
            done = []
        yield batch([now.row()] if now else [])

    def batch(rows: list[tuple]) -> pa.RecordBatch:
        columns = list(zip(*rows)) or [[] for _ in names]
        return pa.RecordBatch.from_arrays([pa.array(c, kind) for c, kind in zip(columns, kinds)], names)

    dealt = formatted.repartition("conv_id").sortWithinPartitions("conv_id", "part").select("conv_id", "formatted", "loss_spans")
    return dealt.mapInArrow(run, "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long")
