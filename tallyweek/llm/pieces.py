"""SentencePiece encoding and decoding with a given piece model of the BPE kind.

Encoding is a Viterbi pass over end positions. A path is a row of pieces, and it
counts if merging by score would give it; that holds if and only if it holds for
every two neighbours, so one table of neighbours decides, and each end position has
exactly one surviving last piece. The pass keeps back pointers for a window only:
as no piece is longer than the longest one, only the ends in that reach are alive.
Whenever the paths of all of them run through one boundary, the ids before it are
committed and forgotten. The ids equal those of the sentencepiece library.

White space opens a piece and never stands inside or at the end of one after other
characters, so paths always meet before it. Between runs of letters and of other
characters they mostly meet, and the table of neighbours tells. Text is cut there first (stretches of
up to WHOLE_CHARS characters before white space only), and the ids of short stretches and runs
are kept in tables of bounded size per Python worker.

The pass reads each character once and knows the pieces that end there. Whether two pieces stay
neighbours is told by the merges along the boundary, without merging them anew.

The model file is read by the driver and broadcast (0.5 MB).

Cases: null and empty texts have no ids and decode to empty; characters without a
piece become byte pieces; control strings in texts are ordinary text; U+2581
decodes to a space, as in the library; repeated rows and empty tables need no care;
other columns are not read.
"""

from __future__ import annotations

import hashlib
import math
import re
from array import array
from collections.abc import Iterable, Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyweek.llm.common import held

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
SPACE = "▁"
# Longest stretch whose ids are kept, and how many a worker keeps (twice over).
KEPT_CHARS, KEPT_STRETCHES = 64, 120_000
# Longest stretch that is not parted into runs.
WHOLE_CHARS = 16
# How many steps of reading and how many tested boundaries a worker keeps.
KEPT_ENDS, KEPT_FITS = 300_000, 240_000
# Paths to the first positions of a run are kept by its opening characters.
OPENING = 6


class Kept(dict):
    """A table of what `make` gives for a text, with a bound: rarely used entries leave after a while."""

    def __init__(self, make, limit: int):
        self.make, self.limit, self.old = make, limit, {}

    def __missing__(self, text: str):
        found = self.old.get(text)
        if found is None:
            found = self.make(text)
        if len(text) <= KEPT_CHARS:
            if len(self) >= self.limit:
                self.old = dict(self)
                self.clear()
            self[text] = found
        return found


class Ends(dict):
    """A state of reading: the longest opening of a piece that the text read so far ends with, and the pieces it ends with,
    each with its length, the table of the pieces that it may follow, and its ids.

    It leads from a character to the next state, which is made when first asked for.
    """

    __slots__ = ("of", "opening", "pieces")

    def __init__(self, of: Pieces, opening: str, pieces: list[tuple[str, int, dict[str, bool], bytes]]):
        self.of, self.opening, self.pieces = of, opening, pieces

    def __missing__(self, c: str) -> Ends:
        return self.of.read_on(self, c)


class Pieces:
    """The model, and how to encode and decode with it."""

    def __init__(self, model: bytes, kept: int = KEPT_STRETCHES):
        library = sentencepiece.SentencePieceProcessor(model_proto=model)
        self.ids: dict[str, int] = {}
        self.scores: dict[str, float] = {}
        self.bytes_of: list[bytes] = []
        self.byte_ids: dict[int, int] = {}
        for i in range(library.vocab_size()):
            piece = library.id_to_piece(i)
            if library.is_byte(i):
                self.byte_ids[int(piece[3:5], 16)] = i
                self.bytes_of.append(bytes([int(piece[3:5], 16)]))
            elif library.is_control(i) or library.is_unknown(i):
                self.bytes_of.append(b" \xe2\x81\x87 " if library.is_unknown(i) else b"")
            else:
                self.ids[piece], self.scores[piece] = i, library.get_score(i)
                self.bytes_of.append(piece.replace(SPACE, " ").encode())
        self.unknown = library.unk_id()
        self.longest = max(map(len, self.ids))
        # Paths meet before white space if no piece has it after another character.
        self.space_opens = not any(SPACE in p.lstrip(SPACE) for p in self.ids)
        self.stretches = re.compile(f"{SPACE}+[^{SPACE}]*|[^{SPACE}]+" if self.space_opens else "(?s).+").findall
        self.runs = re.compile(rf"{SPACE}*(?:[^\W\d_]+|(?:[^\w{SPACE}]|[\d_])+)|{SPACE}+").findall
        # By piece, the pieces on its left and whether the boundary holds.
        self.fits: dict[str, dict[str, bool]] = {}
        self.n_fits = 0
        self.codes = Kept(self.code, 2 * len(self.ids))
        self.known_edges = Kept(self.edges, 2 * len(self.ids))
        self.kept, self.kept_runs = Kept(self.ids_of, kept), Kept(self._run, kept)
        self.openings = Kept(self._opening, kept // 2)
        # All that a piece begins with.
        self.heads = {p[:i] for p in self.ids for i in range(1, len(p) + 1)}
        self._forget()

    def _forget(self) -> None:
        self.start, self.ends, self.n_ends = Ends(self, "", []), {}, 0

    def read_on(self, state: Ends, c: str) -> Ends:
        """The state after one more character, which `state` keeps if a piece has it."""
        opening = state.opening + c
        while opening and opening not in self.heads:
            opening = opening[1:]
        if not opening:  # a character that opens no piece is one of its own
            return Ends(self, "", [(c, 1, {}, self.codes[c])])
        self.n_ends += 1
        if self.n_ends > KEPT_ENDS:
            self._forget()
        if opening not in self.ends:
            tails = [opening[i:] for i in range(len(opening))]
            self.ends[opening] = Ends(self, opening, [(p, len(p), self.lefts(p), self.codes[p]) for p in tails if p in self.ids or len(p) == 1])
        state[c] = found = self.ends[opening]
        return found

    def merged(self, text: str) -> list[str]:
        """A short text's pieces: the best-scored neighbours are merged first, the left ones on ties."""
        parts, scores = list(text), self.scores
        while len(parts) > 1:
            best, at = None, -1
            for i in range(len(parts) - 1):
                score = scores.get(parts[i] + parts[i + 1])
                if score is not None and (best is None or score > best):
                    best, at = score, i
            if at < 0:
                break
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return parts

    def edges(self, piece: str) -> tuple[list, list] | None:
        """The merges along a piece's left and right edge, from the piece down to one character, as pairs of text and score.

        Both are empty if merging does not give the piece; None if a merge has a better score than one it needs.
        """
        parts = [(c, math.inf, None, None) for c in piece]
        while len(parts) > 1:
            score, i = max(((self.scores[x[0] + y[0]], -i) for i, (x, y) in enumerate(zip(parts, parts[1:])) if x[0] + y[0] in self.scores), default=(None, 0))
            if score is None:
                return [], []
            x, y = parts[-i : 2 - i]
            if score >= min(x[1], y[1]):
                return None
            parts[-i : 2 - i] = [(x[0] + y[0], score, x, y)]
        found = []
        for side in (2, 3):
            part, edge = parts[0], []
            while part:
                edge.append(part[:2])
                part = part[side]
            found.append(edge)
        return found[0], found[1]

    def parted(self, left: str, right: str) -> bool:
        """Whether merging leaves the boundary between two pieces.

        Goes back through the merges on both sides of it, the last ones first. Two neighbours across the
        boundary that make a piece would have been merged before the merge gone back through, if their
        score is better; if it is equal, the one on the left comes first.
        """
        before, after = self.known_edges[left], self.known_edges[right]
        if before is None or after is None:
            return self.merged(left + right) == [left, right]
        if not before[1] or not after[0] or left + right in self.scores:
            return False
        ups, downs, i, j = before[1], after[0], 0, 0
        while True:
            (x, s), (y, t) = ups[i], downs[j]
            if s < t:
                i += 1
                if (score := self.scores.get(ups[i][0] + y)) is not None and score > s:
                    return False
            elif t < math.inf:
                j += 1
                if (score := self.scores.get(x + downs[j][0])) is not None and score >= t:
                    return False
            else:
                return True

    def lefts(self, piece: str) -> dict[str, bool]:
        """The table of the pieces on the left of a piece; characters without a piece have none that is kept."""
        return self.fits.setdefault(piece, {}) if piece in self.ids else {}

    def follows(self, left: str, right: str, known: dict[str, bool]) -> bool:
        """Whether the merges leave the boundary between two pieces; with nothing on the left, whether `right` is merged at all."""
        if left not in known:
            self.n_fits += 1
            if self.n_fits > KEPT_FITS:
                for other in self.fits.values():
                    other.clear()
                self.n_fits = 0
            known[left] = self.parted(left, right) if left else self.merged(right) == [right]
        return known[left]

    def extend(self, text: str, base: int, back: list[str], state: Ends, end: int, paths: list[bytes] | None = None) -> Ends:
        """Append to `back` the last piece of the path to each position up to `end`, and to `paths` its ids; back[0] is that of `base`. `state` is that of reading."""
        at = len(back)
        for c in text[base + at - 1 : end]:
            state = state[c]
            for piece, size, known, ids in state.pieces:
                left = back[at - size]
                holds = known.get(left)
                if self.follows(left, piece, known) if holds is None else holds:
                    back.append(piece)
                    if paths is not None:
                        paths.append(paths[at - size] + ids)
                    break
            at += 1
        return state

    def viterbi(self, text: str) -> Iterator[str]:
        """The pieces of a text, committed as soon as all live paths agree on them."""
        reach, base = self.longest, 0
        back, _, state = self.openings[text[:OPENING]]
        back = list(back)
        while True:
            end = min(len(text), base + len(back) - 1 + 4 * reach)
            self.extend(text, base, back, state, end)
            meet = {end} if end == len(text) else set(range(max(base, end - reach + 1), end + 1))
            while len(meet) > 1:
                last = max(meet)
                meet = (meet - {last}) | {max(base, last - len(back[last - base]))}
            boundary = at = meet.pop()
            path = []
            while at > base:
                path.append(back[at - base])
                at -= len(path[-1])
            yield from reversed(path)
            back, base = back[boundary - base :], boundary
            if end == len(text):
                return
            # Pieces begin behind the boundary from here on, so it is read from there.
            state = self.start
            for c in text[base:end]:
                state = state[c]

    def _opening(self, text: str) -> tuple[list[str], list[bytes], Ends]:
        back, paths = [""], [b""]
        return back, paths, self.extend(text, 0, back, self.start, len(text), paths)

    def _paths(self, text: str) -> tuple[list[str], list[bytes]]:
        """The last piece of the path to each position of a short text, and the path's ids."""
        back, paths, state = self.openings[text[:OPENING]]
        if len(text) > OPENING:
            back, paths = back.copy(), paths.copy()
            self.extend(text, 0, back, state, len(text), paths)
        return back, paths

    def _run(self, run: str) -> tuple[str, str, bytes]:
        """A run's first and last piece, and its ids."""
        if len(run) > KEPT_CHARS:
            found = list(self.viterbi(run))
            return found[0], found[-1], self.packed(found)
        back, paths = self._paths(run)
        at = len(run)
        while at:
            first, at = back[at], at - len(back[at])
        return first, back[-1], paths[-1]

    def code(self, piece: str) -> bytes:
        """The ids of a piece; a character that is none has those of its bytes."""
        if piece in self.ids:
            found = [self.ids[piece]]
        elif self.byte_ids:
            found = [self.byte_ids[b] for b in piece.encode("utf-8", "surrogatepass")]
        else:
            found = [self.unknown]
        return array("i", found).tobytes()

    def packed(self, found: Iterable[str]) -> bytes:
        return b"".join(map(self.codes.__getitem__, found))

    def ids_of(self, stretch: str) -> bytes:
        """A stretch's ids. A longer one is put together from its runs of letters and of other characters if the boundaries between them hold."""
        if len(stretch) <= WHOLE_CHARS:
            return self._paths(stretch)[1][-1]
        if len(stretch) <= KEPT_CHARS:
            parts = [self.kept_runs[run] for run in self.runs(stretch)]
            if len(parts) == 1 or all(self.follows(a[1], b[0], self.lefts(b[0])) for a, b in zip(parts, parts[1:])):
                return b"".join([part[2] for part in parts])
        return self.packed(self.viterbi(stretch))

    def encode(self, text: str | None) -> np.ndarray:
        """The ids of a text, which gets a space in front."""
        if not text:
            return np.empty(0, np.int32)
        return np.frombuffer(b"".join(map(self.kept.__getitem__, self.stretches(SPACE + text.replace(" ", SPACE)))), np.int32)

    def decode(self, ids: np.ndarray) -> str:
        """The text of ids, without the space in front; broken characters become U+FFFD."""
        return b"".join(map(self.bytes_of.__getitem__, ids.tolist())).removeprefix(b" ").decode("utf-8", "replace")


def load(model: bytes, kept: int = KEPT_STRETCHES) -> Pieces:
    """One copy per Python worker, with tables of `kept` entries."""
    return held(("pieces", hash(model), kept), lambda: Pieces(model, kept))


def _lists(found: list[np.ndarray]) -> pa.Array:
    offsets = np.concatenate([[0], np.cumsum([len(x) for x in found])]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate([*found, np.empty(0, np.int32)]).astype(np.int32)))


def encode(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", model: str = MODEL) -> DataFrame:
    """(id, ids) of every row."""
    shared = docs.sparkSession.sparkContext.broadcast(Path(model).read_bytes())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of = load(shared.value)
        for b in batches:
            for part in _parts(b):
                yield pa.RecordBatch.from_arrays([part.column(0), _lists([of.encode(t.as_py()) for t in part.column(1)])], ["id", "ids"])

    return docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text")).mapInArrow(run, "id long, ids array<int>")


def decode(rows: DataFrame, id_col: str = "id", ids_col: str = "ids", model: str = MODEL) -> DataFrame:
    """(id, text) of every row of ids; null ids give null."""
    shared = rows.sparkSession.sparkContext.broadcast(Path(model).read_bytes())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of = load(shared.value)
        for b in batches:
            found = [None if x is None else of.decode(np.array(x, np.int32)) for x in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(found, pa.string())], ["id", "text"])

    return rows.select(F.col(id_col).cast("long").alias("id"), F.col(ids_col).alias("ids")).mapInArrow(run, "id long, text string")


def round_trip(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", model: str = MODEL, kept: int = KEPT_STRETCHES) -> DataFrame:
    """(doc_id, n_ids, ids, decoded_sha256, same): encoded, decoded from the ids, and compared with the text.

    A smaller `kept` takes more time and less memory; results are the same.
    """
    shared = docs.sparkSession.sparkContext.broadcast(Path(model).read_bytes())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of = load(shared.value, kept)
        for b in batches:
            for part in _parts(b):
                texts = part.column(1).to_pylist()
                found = [of.encode(t) for t in texts]
                decoded = [of.decode(ids) for ids in found]
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column(0), pa.array([len(x) for x in found], pa.int64()), _lists(found),
                        pa.array([hashlib.sha256(d.encode()).hexdigest() for d in decoded], pa.string()),
                        pa.array([d == (t or "") for d, t in zip(decoded, texts)], pa.bool_()),
                    ],
                    ["doc_id", "n_ids", "ids", "decoded_sha256", "same"],
                )

    read = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return read.mapInArrow(run, "doc_id long, n_ids long, ids array<int>, decoded_sha256 string, same boolean")


def _parts(batch: pa.RecordBatch, rows: int = 500) -> Iterator[pa.RecordBatch]:
    """A batch in smaller ones, as ids take more room than text."""
    for start in range(0, batch.num_rows, rows):
        yield batch.slice(start, rows)
