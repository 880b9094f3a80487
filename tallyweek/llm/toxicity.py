"""Toxicity by a weighted finite-state pattern grammar over clauses.

Words become classes by a lexicon: insults, threats, targets (who is spoken of or to), negators,
reporting verbs, quotation marks, and breaks; all other words are passed over. Small transducers rewrite
the row of classes, each for one phenomenon:

- target: an insult or threat whose clause names a target becomes a targeted one;
- negation: from a negator to the next break, insults and threats become negated;
- reported speech: from a reporting verb to the end of the sentence, and between
  quotation marks, they become reported;
- scores: an acceptor that pays each match its weight, closes at every break and
  starts anew.

They are composed once on the driver into a single transducer over classes, in the max-plus
semiring: its best path through a clause is the clause's score, so a clause with a
targeted insult counts more than the same word in a quotation. Composition keeps the words
out of the states; the weight of an insult itself enters as one of LEVELS classes.

Learned from labelled rows: which words, or stems of words, are insults, and how much each counts, from the
documents of both labels that hold it and from how many different words stand before it (a
word of a copied passage has one neighbour only); and the probability of the label given
a document's evidence, in all and by 100 words, a logistic curve fitted to counts. The given
seed words hold where labels say nothing. What is learned has at most as many entries as stand in
MIN_SHARE of the toxic rows, whatever the corpus.

Cases: null, empty and wordless texts have no evidence and get the probability that goes
with it; labels null or other than 0 and 1 are not learned from; a document with several labels
counts with each; ids that are null are never learned from; without usable labels
the seeds and a prior curve hold; repeated rows get a row each; empty tables give an empty
result; other columns are not read.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterable, Iterator, Mapping
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyweek.llm.common import held, slices, small, written

# Seed words of the classes.
INSULTS = "idiot moron stupid dumb loser scum trash clown worthless pathetic disgusting fool jerk imbecile vermin filth pig coward liar freak".split()
THREATS = "kill hurt destroy crush beat smash burn hang shoot stab strangle punish".split()
TARGETS = "you your yours yourself he she they them him her his their these those this such".split()
NEGATORS = "not no never nobody none neither nor without hardly isn't aren't wasn't weren't don't doesn't didn't won't can't cannot".split()
REPORTERS = "said says say wrote writes claimed claims reported reports quoted quotes called calls told tells alleged stated".split()

# Classes of the lexicon. An insult's class says how strong it is.
LEVELS = 4
INSULT = [f"insult{i}" for i in range(LEVELS)]
THREAT, TARGET, NEGATOR, REPORTER, QUOTE, BREAK, STOP = "threat", "target", "negator", "reporter", "quote", "break", "stop"
CLASSES = [*INSULT, THREAT, TARGET, NEGATOR, REPORTER, QUOTE, BREAK, STOP]
MATCHES = [*INSULT, THREAT]
# What a match is worth beside its own weight.
TARGETED, NEGATED, REPORTED = 1.5, 0.2, 0.3

# A learned insult: in at least this share of the toxic rows and so many of them, behind so many different
# words a row or so many in all, with a log odds whose lower bound (at two standard errors) is this high.
MIN_SHARE, MIN_ROWS, MIN_BEFORE, ENOUGH_BEFORE, MIN_ODDS = 0.005, 5, 0.3, 20, 2.0
# A table of at most this many labels (12 bytes each) is broadcast to the texts; beyond, both are shuffled.
LABEL_ROWS = 2_000_000
# Lengths of stems, which are written with a star.
STEMS = range(3, 9)
# Logarithms of evidence are counted in steps of 1 / STEPS.
STEPS = 8
THRESHOLD = 0.7
BATCH_BYTES = 8 << 20
NOT_WORD = r"[\x00-\x26\x28-\x60\x7B-\x7F]+"
TOKEN = re.compile(r"[^\x00-\x26\x28-\x60\x7B-\x7F]+|[.!?\n]|[,;:|()]|\"|“|”|«|»")
MARKS = {c: STOP for c in ".!?\n"} | {c: BREAK for c in ",;:|()"} | {c: QUOTE for c in '"“”«»'}


@dataclass(frozen=True)
class Fst:
    """A weighted transducer: from a state and a class to (state, class, weight); every state is final."""

    arcs: Mapping[tuple[object, str], tuple[tuple[object, str, float], ...]]
    start: object

    def compose(self, other: Fst) -> Fst:
        """What `other` makes of the output of this one: pairs of states, weights added."""
        arcs, todo, seen = {}, [(self.start, other.start)], {(self.start, other.start)}
        symbols = {c for _, c in self.arcs}
        while todo:
            at = todo.pop()
            for c in symbols:
                out = [
                    ((p, q), y, v + w)
                    for p, x, v in self.arcs.get((at[0], c), ())
                    for q, y, w in other.arcs.get((at[1], x), ())
                ]
                if out:
                    arcs[at, c] = tuple(out)
                for state, _, _ in out:
                    if state not in seen:
                        seen.add(state)
                        todo.append(state)
        return Fst(arcs, (self.start, other.start))


def _fst(start: object, rules: Iterable[tuple[object, str, object, str, float]]) -> Fst:
    arcs: dict = {}
    for state, symbol, to, out, weight in rules:
        arcs.setdefault((state, symbol), []).append((to, out, weight))
    return Fst({k: tuple(v) for k, v in arcs.items()}, start)


def _marked(match: str, mark: str) -> str:
    return f"{match}+{mark}"


def target_fst() -> Fst:
    """Marks matches of clauses that name a target: at once behind it, else by a guess that a target before the break makes good."""
    rules = []
    for c in CLASSES:
        closes = c in (BREAK, STOP)
        if c in MATCHES:
            rules += [("none", c, "none", c, 0.0), ("none", c, "guessed", _marked(c, "target"), 0.0)]
            rules += [("named", c, "named", _marked(c, "target"), 0.0), ("guessed", c, "guessed", _marked(c, "target"), 0.0)]
        elif c == TARGET:
            rules += [(s, c, "named", c, 0.0) for s in ("none", "named", "guessed")]
        elif closes:  # a guess that was not made good has no way on
            rules += [(s, c, "none", c, 0.0) for s in ("none", "named")]
        else:
            rules += [(s, c, s, c, 0.0) for s in ("none", "named", "guessed")]
    return _fst("none", rules)


def _kinds() -> list[str]:
    return [*MATCHES, *(_marked(c, "target") for c in MATCHES)]


def negation_fst() -> Fst:
    """Marks matches between a negator and the next break."""
    rules = []
    for c in [*CLASSES, *(_marked(m, "target") for m in MATCHES)]:
        for state in ("plain", "negated"):
            if c in _kinds():
                rules.append((state, c, state, _marked(c, "not") if state == "negated" else c, 0.0))
            else:
                rules.append((state, c, "negated" if c == NEGATOR else "plain" if c in (BREAK, STOP) else state, c, 0.0))
    return _fst("plain", rules)


def reported_fst() -> Fst:
    """Marks matches between a reporting verb and the end of its sentence, and those in quotation marks."""
    kinds = [k for c in _kinds() for k in (c, _marked(c, "not"))]
    rules = []
    for c in [*kinds, *(c for c in CLASSES if c not in MATCHES)]:
        for told in (False, True):
            for quoted in (False, True):
                state = (told, quoted)
                if c in kinds:
                    rules.append((state, c, state, _marked(c, "said") if told or quoted else c, 0.0))
                elif c == STOP:  # a mark left open does not reach beyond its sentence
                    rules.append((state, c, (False, False), c, 0.0))
                else:
                    rules.append((state, c, (told or c == REPORTER, quoted != (c == QUOTE)), c, 0.0))
    return _fst((False, False), rules)


def score_fst(strengths: list[float], threat: float) -> Fst:
    """Pays every match its weight; breaks and all else pass."""
    rules = []
    for match, worth in zip(MATCHES, [*strengths, threat]):
        for target in (False, True):
            for negated in (False, True):
                for said in (False, True):
                    marks = [m for m, on in (("target", target), ("not", negated), ("said", said)) if on]
                    # A threat is one only against somebody.
                    weight = (0.0 if match == THREAT and not target else worth) * (TARGETED if target else 1) * (NEGATED if negated else 1) * (REPORTED if said else 1)
                    rules.append(("on", "+".join([match, *marks]), "on", "match", weight))
    return _fst("on", rules + [("on", c, "on", c, 0.0) for c in CLASSES if c not in MATCHES])


def grammar(strengths: list[float], threat: float = 3.0) -> Fst:
    """The composed transducer."""
    return target_fst().compose(negation_fst()).compose(reported_fst()).compose(score_fst(strengths, threat))


class Matcher:
    """Runs the grammar over rows of classes; steps from sets of states are kept, and there are few."""

    def __init__(self, fst: Fst):
        self.fst, self.steps = fst, {}
        self.first = ((fst.start, 0.0),)

    def step(self, at: tuple, symbol: str) -> tuple[tuple, float]:
        """The next set of states with their leads over the worst, and what all of them have earned."""
        known = self.steps.get((at, symbol))
        if known is None:
            best: dict = {}
            for state, lead in at:
                for to, _, weight in self.fst.arcs.get((state, symbol), ()):
                    best[to] = max(best.get(to, -math.inf), lead + weight)
            least = min(best.values())
            known = tuple(sorted(((s, round(w - least, 9)) for s, w in best.items()), key=repr)), least
            self.steps[at, symbol] = known
        return known

    def clauses(self, symbols: Iterable[str]) -> Iterator[float]:
        """The score of each clause with a match: the best path that may end with it."""
        at, earned, matched = self.first, 0.0, False
        for symbol in [*symbols, STOP]:
            at, more = self.step(at, symbol)
            earned += more
            matched |= symbol in MATCHES
            if symbol in (BREAK, STOP):
                if matched:
                    yield earned + max(lead for _, lead in at)
                # What follows starts from the states reached, without their leads.
                at, earned, matched = tuple((s, 0.0) for s, _ in at), 0.0, False


@dataclass(frozen=True)
class Model:
    """The lexicon's insults (stems have a star) with their weights, and the curve from evidence to probability."""

    insults: dict[str, float]
    curve: tuple[float, float, float]

    def lexicon(self) -> tuple[dict[str, str], list[float]]:
        """Word or stem to class, and the mean weight of each class of insults over that of the strongest."""
        top = max(self.insults.values(), default=1.0)
        level = {w: min(LEVELS - 1, int(LEVELS * v / top)) for w, v in self.insults.items()}
        own = [[v / top for w, v in self.insults.items() if level[w] == i] for i in range(LEVELS)]
        table = {w: c for words, c in ((TARGETS, TARGET), (NEGATORS, NEGATOR), (REPORTERS, REPORTER), (THREATS, THREAT)) for w in words}
        return table | {w: INSULT[i] for w, i in level.items()}, [sum(v) / len(v) if v else 0.0 for v in own]


PRIOR = Model({w: 3.0 for w in INSULTS}, (-3.0, 2.0, 0.5))


def held_out(doc_id: Column) -> Column:
    return F.crc32(doc_id.cast("string")) % 3 == 1


def training_rows(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_id: str = "doc_id", label_col: str = "toxic") -> DataFrame:
    """(text, toxic) of labelled rows that are not held out."""
    marks = labels.select(F.col(label_id).cast("long").alias("id"), F.col(label_col).cast("int").alias("toxic")).where("toxic IN (0, 1)")
    texts = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    kept = written(marks.where(~held_out(F.col("id"))), "toxic_labels")
    return texts.where(~held_out(F.col("id"))).join(small(kept, LABEL_ROWS), "id").select("text", "toxic")


def _words(text: Column) -> Column:
    return F.array_remove(F.split(F.lower(F.coalesce(text, F.lit(""))), NOT_WORD), "")


def _patterns(word: Column) -> Column:
    """A word and its stems."""
    stems = [F.when(F.length(word) > n, F.concat(F.substring(word, 1, n), F.lit("*"))) for n in STEMS]
    return F.array_compact(F.array(word, *stems))


def learn_insults(train: DataFrame) -> dict[str, float]:
    """The words and stems that mark toxic rows, with their log odds; a stem stands for the longer ones that are no better."""
    n = {r["toxic"]: r["n"] for r in train.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    if not n.get(0) or not n.get(1):
        return {}
    tokens = _words(F.col("text"))
    distinct_patterns = F.array_distinct(F.flatten(F.transform(F.array_distinct(tokens), _patterns)))
    # A pattern counts once for each text: copies of a text are one witness.
    toxic = written(train.where("toxic = 1").groupBy(F.xxhash64("text")).agg(F.first("text").alias("text")).select("text"), "toxic_texts")
    least = max(MIN_ROWS, MIN_SHARE * n[1])
    seen = toxic.select(F.explode(distinct_patterns).alias("pattern")).groupBy("pattern").agg(F.count("*").alias("a"))
    common = written(seen.where(F.col("a") >= least), "toxic_patterns")
    clean = train.where("toxic = 0").select(F.explode(distinct_patterns).alias("pattern")).join(small(common.select("pattern")), "pattern")
    rows = common.join(clean.groupBy("pattern").agg(F.count("*").alias("c")), "pattern", "left").withColumn("c", F.coalesce("c", F.lit(0)))
    odds = F.log((F.col("a") + 0.5) / (n[1] + 1)) - F.log((F.col("c") + 0.5) / (n[0] + 1))
    bound = odds - 2 * F.sqrt(1 / (F.col("a") + 0.5) + 1 / (F.col("c") + 0.5))
    marks = written(rows.select("pattern", "a", odds.alias("odds"), bound.alias("bound")).where(F.col("bound") >= MIN_ODDS), "toxic_marks")
    pairs = F.arrays_zip(F.col("w").alias("word"), F.concat(F.array(F.lit("")), F.slice("w", 1, F.greatest(F.size("w") - 1, F.lit(0)))).alias("before"))
    each = toxic.select(tokens.alias("w")).where("size(w) > 0").select(F.explode(F.array_distinct(pairs)).alias("p"))
    each = each.select("p.before", F.explode(_patterns(F.col("p.word"))).alias("pattern")).join(small(marks.select("pattern")), "pattern")
    varied = each.distinct().groupBy("pattern").agg(F.count("*").alias("n_before"))
    found = marks.join(varied, "pattern").where(F.col("n_before") >= F.least(MIN_BEFORE * F.col("a"), F.lit(float(ENOUGH_BEFORE))))
    learned = {r["pattern"]: r["odds"] for r in found.collect()}  # no more than rows are long, over MIN_SHARE
    return {w: v for w, v in learned.items() if not any(learned.get(w[:k] + "*", -1) >= v for k in STEMS if k < len(w.rstrip("*")))}


def evidence(rows: DataFrame, model: Model, *keep: str) -> DataFrame:
    """(keep..., evidence, n_words) of every row's text: the sum of its clauses' scores, in units of the strongest insult's weight."""
    shared = rows.sparkSession.sparkContext.broadcast(model)

    def classes(vocabulary: pa.Array, lexicon: Mapping[str, str], strengths: list[float]) -> dict[str, str]:
        """The insults and threats among the words, by the strongest entry that fits."""
        worth = dict(zip(INSULT, strengths)) | {THREAT: 1.0}
        found: dict[str, str] = {}
        for entries, key in ((vocabulary, vocabulary), *((pc.binary_join_element_wise(pc.utf8_slice_codeunits(vocabulary, 0, k), "*", ""), vocabulary) for k in STEMS)):
            hit = pc.is_in(entries, pa.array([w for w, c in lexicon.items() if c in MATCHES], pa.string()))
            for entry, word in zip(entries.filter(hit).to_pylist(), key.filter(hit).to_pylist()):
                if entry == word or len(word) >= len(entry):
                    c = lexicon[entry]
                    if word not in found or worth[c] > worth[found[word]]:
                        found[word] = c
        return found

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held("toxicity", dict)
        lexicon, strengths = shared.value.lexicon()
        matcher = Matcher(grammar(strengths, 1.0))
        plain = MARKS | {w: c for w, c in lexicon.items() if c not in MATCHES}
        for b in batches:
            for part in slices(b, len(keep), BATCH_BYTES):
                texts = pc.utf8_lower(pc.fill_null(part.column(len(keep)), ""))
                words = pc.split_pattern_regex(texts, NOT_WORD)
                coded = words.flatten().dictionary_encode()
                hot = classes(coded.dictionary, lexicon, strengths)
                is_hot = pc.is_in(coded.dictionary, pa.array(list(hot), pa.string())).to_numpy(zero_copy_only=False).astype(np.int64)
                filled = pc.not_equal(coded.dictionary, "").to_numpy(zero_copy_only=False).astype(np.int64)
                codes, offsets = coded.indices.to_numpy(), words.offsets.to_numpy() - words.offsets[0].as_py()
                n_hot, n_words = (np.diff(np.concatenate([[0], np.cumsum(v[codes])])[offsets]) for v in (is_hot, filled))
                out, known = np.zeros(part.num_rows), plain | hot
                for i in np.flatnonzero(n_hot).tolist():
                    out[i] = sum(matcher.clauses(known[t] for t in TOKEN.findall(texts[i].as_py()) if t in known))
                yield pa.RecordBatch.from_arrays([*part.columns[: len(keep)], pa.array(out, pa.float64()), pa.array(n_words, pa.int64())], [*keep, "evidence", "n_words"])

    schema = ", ".join(f"{c} {rows.schema[c].dataType.simpleString()}" for c in keep)
    return rows.select(*keep, "text").mapInArrow(run, f"{schema}, evidence double, n_words long")


def _features() -> tuple[Column, Column]:
    """Logarithms of the evidence, in all and by 100 words."""
    return F.log1p("evidence"), F.log1p(100 * F.col("evidence") / F.greatest("n_words", F.lit(1)))


def fit_curve(counts: Iterable[tuple[float, float, int, int]], steps: int = 100) -> tuple[float, float, float]:
    """The logistic curve through (evidence, evidence by words, toxic or not, how many), with a weak prior on its slopes."""
    x1, x2, y, n = (np.array(v, float) for v in zip(*counts))
    beta = np.array([math.log((n @ y + 0.5) / (n @ (1 - y) + 0.5)), 0.0, 0.0])
    design, weak = np.stack([np.ones_like(y), x1, x2], 1), np.array([0.0, 0.1, 0.1])

    def loss(b: np.ndarray) -> float:
        z = design @ b
        return float(n @ (np.logaddexp(0, z) - y * z)) + float(weak @ b**2) / 2

    for _ in range(steps):  # Newton, with the step halved until the loss falls
        p = 1 / (1 + np.exp(-design @ beta))
        slope = design.T @ (n * (p - y)) + weak * beta
        bend = (design * (n * p * (1 - p))[:, None]).T @ design + np.diag(weak + 1e-6)
        move, size = np.linalg.solve(bend, slope), 1.0
        while loss(beta - size * move) > loss(beta) + 1e-12 and size > 1e-6:
            size /= 2
        beta = beta - size * move
        if np.abs(size * move).max() < 1e-8:
            break
    return tuple(map(float, beta))


def learn(docs: DataFrame, labels: DataFrame, **columns: str) -> Model:
    """The lexicon and the curve, from all labelled rows that are not held out."""
    train = written(training_rows(docs, labels, **columns), "toxic_train")
    model = Model(PRIOR.insults | learn_insults(train), PRIOR.curve)
    at = [F.round(x * STEPS) / STEPS for x in _features()]
    counts = evidence(train, model, "toxic").groupBy(at[0].alias("x1"), at[1].alias("x2"), "toxic").agg(F.count("*").alias("n")).collect()
    if len({r["toxic"] for r in counts}) < 2:
        return model
    return Model(model.insults, fit_curve([tuple(r) for r in counts]))


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, held_out, score, predicted, evidence, n_words) of every row; held_out is null for null ids."""
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    a, b, c = map(F.lit, model.curve)
    x1, x2 = _features()
    scored = evidence(rows, model, "doc_id").withColumns({"held_out": held_out(F.col("doc_id")), "score": 1 / (1 + F.exp(-(a + b * x1 + c * x2)))})
    return scored.select("doc_id", "held_out", "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"), "evidence", "n_words")
