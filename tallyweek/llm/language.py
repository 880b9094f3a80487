"""Language identification by cross-parsing against suffix automata.

For each language a suffix automaton holds labelled text. A text is parsed against
it into the longest pieces that occur there, across the ends of words; the fewer pieces,
the nearer the language. The number of pieces is weighted with the logarithm of the
automaton's text length, which is the usual estimate of cross entropy; the language
with the smallest product wins, on ties the smaller name. Texts are read as their words
(runs of letters) in lower case with a space between. Many texts are parsed at once, as one
text of lines, with arrays; memory is bounded by blocks of BLOCK characters.

Only the fit reads a sample: the texts of all labelled rows are cut into passages of
PASSAGE_CHARS characters, of which a hash of id, text and place draws about PASSAGES of each
language, wherever in a text they stand. They go through the driver, at most
LANGUAGES * PASSAGES * PASSAGE_CHARS characters or so; more languages are refused. Prediction
reads whole texts of all rows.

Cases: null or letterless texts (no character of the Unicode categories L) are `und` with
score 0, and so is every text when nothing was learned; keep_known rejects by letters and,
where languages are asked for, by what was learned; rows without label are not learned
from; repeated rows are drawn as one; empty tables need no care; other columns are not read.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator, Sequence
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyweek.llm.common import content_key, free_name, held, slices, small, written

PASSAGES, PASSAGE_CHARS, LANGUAGES = 60, 800, 64
UNKNOWN = "und"
BEYOND = re.compile("[\U00010000-\U0010ffff]+")
# No word has it, so it parts texts that are parsed together.
LINE_END = "\n"
# Characters parsed at once, and of a stretch of them; cells of a language's table up to which it has those that lead back, too (16 MB).
BLOCK, STRETCH, DENSE_CELLS = 1 << 20, 256, 1 << 22


@cache
def _not_letters() -> re.Pattern:
    """Runs of what is no letter, up to U+FFFF; a class without `\\w` and the like is looked up at once."""
    return re.compile(f"[{re.escape(''.join(c for c in map(chr, range(1 << 16)) if not c.isalpha()))}]+")


def held_out(id_col: Column) -> Column:
    """Rows that nothing is learned from: crc32 of the id as text leaves 2 by 4."""
    return F.coalesce(F.crc32(id_col.cast("string")), F.lit(0)) % 4 == 2


def letters(text: str | None) -> str:
    """The words of a text, runs of letters in lower case, with one space between; empty without a letter."""
    beyond = lambda m: "".join(c if c.isalpha() else " " for c in m[0])
    return _not_letters().sub(" ", BEYOND.sub(beyond, text.lower())).strip() if text else ""


class Automaton:
    """A suffix automaton: from the root, states (letter to next state) lead along the strings that occur in the text.

    Cross-parsing follows it as a table: a state is a row, a character a column, and where no string goes
    on, the cell leads to the state of a phrase that begins with the character. State 0 is the root, into which
    LINE_END leads; states below `width` are those of a phrase's first character, by its column, and column 1 stands for
    all characters that the text lacks. States are given as the places where their rows begin.
    """

    def __init__(self, text: str):
        self.size = len(text)
        link, length, last = [-1], [0], 0
        steps: list[dict] = [{}]
        for c in text:
            here = len(steps)
            steps.append({})
            link.append(0)
            length.append(length[last] + 1)
            p = last
            while p >= 0 and c not in steps[p]:
                steps[p][c] = here
                p = link[p]
            if p >= 0:
                q = steps[p][c]
                if length[p] + 1 == length[q]:
                    link[here] = q
                else:
                    clone = len(steps)
                    steps.append(dict(steps[q]))
                    link.append(link[q])
                    length.append(length[p] + 1)
                    while p >= 0 and steps[p].get(c) == q:
                        steps[p][c] = clone
                        p = link[p]
                    link[q] = link[here] = clone
            last = here
        self._tabulate(steps)

    def _tabulate(self, steps: list[dict]) -> None:
        column = {c: i for i, c in enumerate(sorted(steps[0]), 2)}
        self.width = width = len(column) + 2
        self.columns = np.ones(max(map(ord, [LINE_END, *column])) + 2, np.int32)
        self.columns[ord(LINE_END)] = 0
        for c, i in column.items():
            self.columns[ord(c)] = i
        # The states of first characters are copies, so that phrases are counted by the states they begin with.
        rows = [{}, {}, *(steps[steps[0][c]] for c in column), *steps[1:]]
        cells = np.array([i * width + column[c] for i, row in enumerate(rows) for c in row], np.int64)
        to = np.array([(q - 1 + width) * width for row in rows for q in row.values()], np.int64)
        self.firsts = np.arange(width) * width
        if len(rows) * width <= DENSE_CELLS:
            table = np.tile(self.firsts.astype(np.int32), len(rows))
            table[cells] = to
            self.table, self.look = table, memoryview(table).__getitem__
        else:  # many letters: only the cells that go on, in order
            order = np.argsort(cells)
            self.table, self.cells, self.to = None, cells[order], to[order]
            self.look = lambda cell: int(self._sparse(np.array([cell]))[0])

    def _sparse(self, cells: np.ndarray) -> np.ndarray:
        at = np.minimum(np.searchsorted(self.cells, cells), len(self.cells) - 1)
        return np.where(self.cells[at] == cells, self.to[at], self.firsts[cells % self.width])

    def _next(self, cells: np.ndarray) -> np.ndarray:
        return self._sparse(cells) if self.table is None else self.table[cells]

    def follow(self, codes: np.ndarray, state: int) -> tuple[np.ndarray, int]:
        """Where phrases begin in a text of code points that is entered at a state, and the state it ends in.

        The text is cut into stretches that are followed side by side, each as if it began at the root. Two
        parses that meet in a state stay together, so only the beginnings of stretches are followed again, from
        the state that the stretch before ends in; where parses don't meet, as in some repetitive texts, one stretch after the other.
        """
        n, lanes = len(codes), -(-len(codes) // STRETCH)
        columns = np.zeros(lanes * STRETCH, np.int64)
        columns[:n] = self.columns[np.minimum(codes, len(self.columns) - 1)]
        columns = np.ascontiguousarray(columns.reshape(lanes, STRETCH).T)
        states = np.empty((STRETCH, lanes), np.int64 if self.table is None else np.int32)
        entered = np.zeros(lanes, states.dtype)
        entered[0] = state
        now = entered
        for k in range(STRETCH):
            now = states[k] = self._next(now + columns[k])
        for _ in range(2):
            now = np.append(states.dtype.type(state), states[-1, :-1])
            wrong = np.flatnonzero(now != entered)
            entered, now = now, now[wrong]
            for k in range(STRETCH):
                if not len(wrong):
                    break
                now = self._next(now + columns[k, wrong])
                apart = now != states[k, wrong]
                wrong, now = wrong[apart], now[apart]
                states[k, wrong] = now
        for lane in range(1, lanes):
            now = int(states[-1, lane - 1])
            if now != entered[lane]:
                found = states[:, lane].tolist()
                for k, column in enumerate(columns[:, lane].tolist()):
                    now = self.look(now + column)
                    if now == found[k]:
                        break
                    found[k] = now
                states[:, lane] = found
        begins = (states > 0) & (states < self.width * self.width)
        return begins.T.ravel()[:n], int(states[(n - 1) % STRETCH, (n - 1) // STRETCH])

    def phrases(self, text: str) -> int:
        """Number of longest matches, one after the other, that make up the text."""
        return int(self.follow(_codes(text), 0)[0].sum()) if text else 0


def _codes(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)


class Parser:
    """Automata of all languages."""

    def __init__(self, texts: dict[str, str]):
        self.names = sorted(texts)
        self.automata = [Automaton(texts[name]) for name in self.names]
        self.weights = [math.log2(a.size + 2) for a in self.automata]

    def phrases(self, texts: list[str]) -> np.ndarray:
        """Number of phrases of each text (not empty) by each language. The texts run on as one, in blocks."""
        line = LINE_END.join([*texts, ""])
        starts = np.cumsum([0, *(len(t) + 1 for t in texts)])
        counts, states = np.zeros((len(texts), len(self.names)), np.int64), [0] * len(self.names)
        for at in range(0, len(line), BLOCK):
            codes = _codes(line[at : at + BLOCK])
            first, end = np.searchsorted(starts, at, "right") - 1, np.searchsorted(starts[:-1], at + len(codes))
            cuts = np.maximum(starts[first:end] - at, 0)
            for i, automaton in enumerate(self.automata):
                begins, states[i] = automaton.follow(codes, states[i])
                counts[first:end, i] += np.add.reduceat(begins, cuts, dtype=np.int64)
        return counts

    def predict(self, texts: list[str]) -> list[tuple[str, float]]:
        """Language and score of each text as `letters` gives it."""
        found = [(UNKNOWN, 0.0)] * len(texts)
        read = [i for i, words in enumerate(texts) if words and self.names]
        if read:
            costs = self.phrases([f" {texts[i]} " for i in read]) * np.array(self.weights)
            order = np.argsort(costs, axis=1, kind="stable")  # names are in order
            ranked = np.take_along_axis(costs, order, axis=1)
            scores = 1 - ranked[:, 0] / ranked[:, 1] if len(self.names) > 1 else np.ones(len(read))
            for i, best, score in zip(read, order[:, 0].tolist(), scores.tolist()):
                found[i] = self.names[best], score
        return found


def learn(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", passages: int = PASSAGES, chars: int = PASSAGE_CHARS, languages: int = LANGUAGES) -> dict[str, str]:
    """Language to its drawn passages, read as running text."""
    labelled = docs.where(F.col(lang_col).isNotNull() & (F.length(text_col) > 0) & ~held_out(F.col(id_col)))
    n_parts = F.ceil(F.length(text_col) / F.lit(chars)).cast("long").alias("n_parts")
    read = labelled.select(F.col(lang_col).alias("lang"), content_key(F.lit("sample"), id_col, text_col).alias("key"), n_parts, F.col(text_col).alias("text"))
    sizes = written(read.select("lang", "key", "n_parts").distinct().groupBy("lang").agg(F.sum("n_parts").alias("n")), "language_sizes")
    if (n := sizes.count()) > languages:
        raise ValueError(f"{n} languages, more than {languages}")

    def drawn(part: Column) -> Column:
        return F.pmod(F.xxhash64("key", part), F.lit(1 << 32)) / float(1 << 32) * F.col("n") < passages

    picked = read.join(small(sizes), "lang").withColumn("parts", F.filter(F.sequence(F.lit(0).cast("long"), F.col("n_parts") - 1), drawn)).where(F.size("parts") > 0)
    passage = F.transform("parts", lambda i: F.substr("text", (i * chars + 1).cast("int"), F.lit(chars)))
    chosen = picked.dropDuplicates(["lang", "key"]).select("lang", "key", F.posexplode(passage).alias("part", "passage"))
    texts: dict[str, list[str]] = {}
    for lang, passage in sorted((r.lang, r.passage) for r in chosen.toLocalIterator()):
        texts.setdefault(lang, []).append(passage)
    running = {lang: letters(" ".join(of)) for lang, of in texts.items()}
    return {lang: f" {words} " for lang, words in running.items() if words}


def predict(docs: DataFrame, texts: dict[str, str], id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, row_key, lang_pred, score, has_letters) of every row."""
    shared = docs.sparkSession.sparkContext.broadcast(texts)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        texts = shared.value
        of = held(("language", tuple(sorted(texts.items()))), lambda: Parser(texts))
        for b in batches:
            for part in slices(b, 2, BLOCK):
                words = [letters(t) for t in part.column(2).to_pylist()]
                found = of.predict(words)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(1), pa.array([f[0] for f in found], pa.string()), pa.array([f[1] for f in found], pa.float64()), pa.array([w != "" for w in words], pa.bool_())],
                    ["id", "row_key", "lang_pred", "score", "has_letters"],
                )

    read = docs.select(F.col(id_col).cast("long").alias("id"), content_key(id_col, text_col).alias("row_key"), F.col(text_col).alias("text"))
    return read.mapInArrow(run, "id long, row_key long, lang_pred string, score double, has_letters boolean")


def keep_known(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", languages: Sequence[str] | None = None) -> DataFrame:
    """The rows of `docs` in a known language; a null label becomes the predicted language.

    Texts without a letter go, and those predicted in another language than `languages`, if
    given. Where nothing was learned, texts with letters stay as they are.
    """
    key, guess = free_name(docs, "_row_key"), free_name(docs, "_lang_pred")
    found = predict(docs, learn(docs, id_col, text_col, lang_col), id_col, text_col)
    found = written(found.select(F.col("row_key").alias(key), F.nullif("lang_pred", F.lit(UNKNOWN)).alias(guess), "has_letters"), "languages")
    foreign = F.lit(False) if languages is None else F.coalesce(~F.col(guess).isin(*languages), F.lit(False))
    rejected = small(written(found.where(~F.col("has_letters") | foreign).select(key).distinct(), "rejected"))
    kept = docs.withColumn(key, content_key(id_col, text_col)).join(rejected, key, "left_anti")
    named, unnamed = kept.where(F.col(lang_col).isNotNull()), kept.where(F.col(lang_col).isNull())
    filled = unnamed.join(found.select(key, guess).distinct(), key, "left").withColumn(lang_col, F.col(guess))
    return named.select(docs.columns).union(filled.select(docs.columns))
