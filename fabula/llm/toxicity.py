"""Toxicity by a weighted finite-state pattern grammar.

A word is read by a transducer over letters, LEXICON: a trie whose arcs carry weights, so that the
sum along a path is the log odds of the longest stem passed. Its output is a symbol: a word of the closed classes
THREAT (stems with the endings of their language), TARGET, NEGATION or REPORT (also an opening
quotation mark), else INSULT where the weight is above zero; other words have none.

The symbols of a clause are read by the composition of transducers that mark insults and threats:
NEGATION, REPORT and TARGET from left to right, then REPORT and TARGET from right to left, since a target or
a reporting verb may follow ("kill you", "idiot, he said"). Each has two states and one arc for every symbol;
``compose`` builds the product machine, arc by arc, adding weights. What comes out is a
match: an insult or threat, with the marks that its clause gives it. So clauses are scored, not
isolated words: "you are a ..." is one kind of match, "nobody said ..." another. The weights by
kind and marks are fitted; a text's score is a logistic function of its matches' weights and of their
share among its words.

What is fitted, on at most SAMPLE_ROWS labelled documents outside the held-out fold: the stems
(beginnings of words that toxic documents have far more often, beyond what the number of
candidates explains by chance; near copies of a document count once) with their log odds, and
the weights by kind, pulled towards PRIOR. All else is the same at every size. MOST_STEMS bounds what the
driver holds; on the test tables some hundred stems pass the test that leads there.

Nulls and empty texts score like a text without matches. Score and prediction are by row: repeated rows repeat
their result, null ids stay null, an empty table has no rows, other columns are not read.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fabula.llm import training
from fabula.llm.hashing import mix
from fabula.llm.memory import releasing, small_batches
from fabula.llm.scratch import written

#: Shortest and longest beginning of a word that can be a stem; most stems kept; least precision of a stem; share of its gain for which a stem gives way to longer ones; score from which a text is toxic.
SHORTEST, LONGEST, MOST_STEMS, PRECISION, KEEPS, TOXIC = 3, 10, 1 << 18, 0.3, 0.9, 0.7

# Closed word lists of the grammar. THREAT: stems and endings by language.
THREAT = [
    ("kill murder hurt destroy beat stab shoot hang strangle", "- s ed ing er ers en"),
    ("stabb", "ed ing"),
    ("töt umbring bring schlag verletz erwürg vernicht", "en e st t et te ten test end"),
    ("mat golpe", "ar o as a amos an é ó aron aré aras ará ando ado arte arlo"),
    ("her destru", "ir irte iré irá iendo ido"),
    ("tu frapp bless étrangl", "er e es ons ez ent ai as a erai eras era é ée és ées ant"),
    ("détrui", "re s t rai ras ra sant"),
]
TARGET = "you your yours u ya du dich dir ihr euch dein deine tú usted ustedes te vosotros tu vous toi votre".split()
NEGATION = "not never no nobody isn't aren't don't won't nicht nie kein keine niemand nunca jamás nadie ne pas jamais personne".split()
REPORT = "said says say told claimed wrote called quoted sagte sagt schrieb behauptete dijo dice escribió llamó dit disait écrit appelé".split()
SEEDS = "idiot moron stupid imbecile dumm idiota imbécil estúpido idiote stupide".split()

WORD = re.compile(r"[^\W_]+(?:['’][^\W_]+)*|[\"“„«]")
CLAUSE = re.compile(r"[.!?;\n]+")
QUOTES = set("\"“„«")
KINDS = ["insult", "threat"]
FLAGS = 8  # target 1, negation 2, report 4
#: Symbols: three closed classes, then insults and threats by their marks.
SYMBOLS = ["target", "negation", "report", *((kind, marks) for kind in KINDS for marks in range(FLAGS))]
MATCH = 3
#: Pulls of the fit: intercept, the weight of an insult's or threat's log odds by marks, and of the share of both. A negated or reported match counts for less until labels say otherwise.
PRIOR = np.array([-3.0] + [(1.0 if kind == "insult" else 0.8) + 0.3 * (f & 1) - 0.3 * (f >> 1 & 1) - 0.3 * (f >> 2 & 1) for kind in KINDS for f in range(FLAGS)] + [0.5, 0.4])


@dataclass
class Transducer:
    """arcs: (state, symbol) -> (next state, output symbol, weight). Where there is none, a symbol passes as it is. State 0 is the first."""

    arcs: dict[tuple[int, int], tuple[int, int, float]] = field(default_factory=dict)

    def step(self, state: int, symbol: int) -> tuple[int, int, float]:
        return self.arcs.get((state, symbol), (state, symbol, 0.0))

    def run(self, symbols: list[int]) -> tuple[list[int], float]:
        state, out, total = 0, [], 0.0
        for s in symbols:
            state, o, w = self.step(state, s)
            out.append(o)
            total += w
        return out, total


def marking(trigger: str, mark: int) -> Transducer:
    """Marks all insults and threats that come after a trigger."""
    t = SYMBOLS.index(trigger)
    out = Transducer({(state, t): (1, t, 0.0) for state in (0, 1)})
    for k, s in enumerate(SYMBOLS[MATCH:], MATCH):
        out.arcs[1, k] = (1, MATCH + KINDS.index(s[0]) * FLAGS + (s[1] | mark), 0.0)
    return out


def compose(a: Transducer, b: Transducer) -> Transducer:
    """What b makes of a's output, as one machine over pairs of states."""
    out, number, todo = Transducer(), {(0, 0): 0}, [(0, 0)]
    while todo:
        pair = todo.pop()
        for s in range(len(SYMBOLS)):
            x, middle, v = a.step(pair[0], s)
            y, o, w = b.step(pair[1], middle)
            if (x, y) not in number:
                number[x, y] = len(number)
                todo.append((x, y))
            out.arcs[number[pair], s] = (number[x, y], o, v + w)
    return out


#: Composed once: from left to right, and what is then read from right to left.
FORWARD = compose(marking("negation", 2), compose(marking("report", 4), marking("target", 1)))
BACKWARD = compose(marking("report", 4), marking("target", 1))


def marked(symbols: list[int]) -> list[int]:
    """The symbols of a clause with their marks."""
    return BACKWARD.run(FORWARD.run(symbols)[0][::-1])[0][::-1]


class Lexicon:
    """A transducer over the letters of a word and "$" for its end. arcs: by state, letter -> (next state, weight)."""

    def __init__(self, stems: dict[str, float]) -> None:
        self.arcs: list[dict[str, tuple[int, float]]] = [{}]
        for stem in sorted(stems):  # shorter ones first: what is longer adds the difference
            state, total = 0, 0.0
            for k, c in enumerate(stem):
                nxt, w = self.arcs[state].get(c, (0, 0.0))
                if not nxt:
                    nxt, w = len(self.arcs), 0.0
                    self.arcs.append({})
                if k == len(stem) - 1:
                    w = stems[stem] - total
                self.arcs[state][c] = (nxt, w)
                state, total = nxt, total + w

    def weigh(self, word: str) -> float:
        state, total = 0, 0.0
        for c in word + "$":
            arc = self.arcs[state].get(c)
            if arc is None:
                break
            state, total = arc[0], total + arc[1]
        return total


def closed_classes() -> dict[str, tuple[int, float]]:
    """Words with a symbol of their own."""
    out = {stem + ending.strip("-"): (SYMBOLS.index(("threat", 0)), 2.0) for stems, endings in THREAT for stem in stems.split() for ending in endings.split()}
    for name, words in (("target", TARGET), ("negation", NEGATION), ("report", [*REPORT, *QUOTES])):
        out |= {w: (SYMBOLS.index(name), 0.0) for w in words}
    return out


class Symbols(dict):
    """Word -> symbol and weight, worked out at first sight; at most CACHE words are kept. Closed classes come before stems."""

    CACHE = 100_000

    def __init__(self, lexicon: Lexicon, closed: dict[str, tuple[int, float]]) -> None:
        self.lexicon, self.closed = lexicon, closed

    def __missing__(self, word: str):
        if len(self) > self.CACHE:
            self.clear()
        out = self.closed.get(word)
        if out is None and (w := self.lexicon.weigh(word)) > 0:
            out = (SYMBOLS.index(("insult", 0)), w)
        self[word] = out
        return out


class Grammar:
    """The whole machine. stems: stem -> weight."""

    def __init__(self, stems: dict[str, float]) -> None:
        self.symbols = Symbols(Lexicon(stems), closed_classes())

    def matches(self, text: str) -> np.ndarray:
        """Sums of match weights by kind and marks, and the number of words."""
        out = np.zeros(len(KINDS) * FLAGS + 1)
        low, symbols = text.lower(), self.symbols
        words = WORD.findall(low)
        out[-1] = len(words)
        if not any(s is not None and s[0] >= MATCH for s in map(symbols.__getitem__, set(words))):
            return out
        for clause in CLAUSE.split(low):
            seen = [s for s in map(symbols.__getitem__, WORD.findall(clause)) if s is not None]
            if any(s >= MATCH for s, _ in seen):
                for s, (_, weight) in zip(marked([s for s, _ in seen]), seen, strict=True):
                    if s >= MATCH:
                        out[s - MATCH] += weight
        return out


def features(m: np.ndarray) -> np.ndarray:
    """1, then by kind and marks the logarithm of one plus the matched weight (the tenth insult adds less than the first), then the same of each kind's weight in a hundred words."""
    m = np.atleast_2d(m)
    share = 100 * m[:, :-1].reshape(len(m), len(KINDS), FLAGS).sum(2) / np.maximum(m[:, -1:], 1)
    return np.hstack((np.ones((len(m), 1)), np.log1p(m[:, :-1]), np.log1p(share)))


def fit_weights(x: np.ndarray, y: np.ndarray, pull: float = 0.2) -> np.ndarray:
    """Logistic regression by Newton's method, pulled towards PRIOR."""
    w = PRIOR.copy()
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        g = x.T @ (p - y) + pull * (w - PRIOR)
        h = (x * (p * (1 - p))[:, None]).T @ x + pull * np.eye(len(w))
        step = np.linalg.solve(h, g)
        w = w - np.clip(step, -2, 2)
        if np.abs(step).max() < 1e-8:
            break
    return w


def _words(text: str) -> set[str]:
    return set(WORD.findall(text.lower())) - QUOTES


def _stems(words: set[str]) -> set[str]:
    """All beginnings of the words, and the words themselves with a mark at their end."""
    return {w[:k] for w in words for k in range(SHORTEST, min(LONGEST, len(w)) + 1)} | {w + "$" for w in words if 1 < len(w) <= 30}


def _leading(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """A min-hash of three-word runs: near copies mostly share it."""
    for b in batches:
        out = []
        for t in b["text"]:
            w = np.array([hash_word(x) for x in t.split()], np.uint64)
            runs = mix(w[:-2] * np.uint64(3) + w[1:-1] * np.uint64(5) + w[2:] * np.uint64(7)) if len(w) > 2 else mix(w)
            out.append(int(runs.min() >> np.uint64(1)) if len(runs) else -1)
        yield pd.DataFrame({"doc_id": b["doc_id"], "sketch": out})


def hash_word(word: str) -> int:
    import zlib

    return zlib.crc32(word.encode())


def _count(keep: frozenset[int]):
    """Documents by stem and label, summed up in the task as far as memory goes."""

    def rows(toxic: Counter, clean: Counter) -> Iterator[pa.RecordBatch]:
        stems = list(toxic | clean)
        for k in range(0, len(stems), 50_000):
            part = stems[k : k + 50_000]
            yield pa.record_batch({"stem": pa.array(part, pa.string()), "toxic": pa.array([toxic[s] for s in part], pa.int64()), "clean": pa.array([clean[s] for s in part], pa.int64())})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        toxic, clean = Counter(), Counter()
        for b in batches:
            for i, t, y in zip(*(b.column(c).to_pylist() for c in ("doc_id", "text", "y")), strict=True):
                if i in keep:
                    (toxic if y else clean).update(_stems(_words(t)))
                if len(clean) + len(toxic) > 250_000:
                    yield from rows(toxic, clean)
                    toxic, clean = Counter(), Counter()
        yield from rows(toxic, clean)

    return run


def choose(counts: DataFrame, toxic: int, clean: int) -> dict[str, float]:
    """Stems that toxic documents have beyond chance, and their log odds."""
    share = min(max(toxic / max(1, toxic + clean), 0.01), 0.99)
    total = counts.groupBy("stem").agg(F.sum("toxic").alias("p"), F.sum("clean").alias("n")).where("p > 0")
    total = total.withColumn("gain", F.col("p") * F.log(F.col("p") / (F.col("p") + F.col("n")) / share) + F.when(F.col("n") > 0, F.col("n") * F.log(F.col("n") / (F.col("p") + F.col("n")) / (1 - share))).otherwise(0.0))
    total = total.where((F.col("p") + 0.5) / (F.col("p") + F.col("n") + 1) >= PRECISION)
    candidates = counts.select(F.approx_count_distinct("stem")).first()[0]
    bar = math.log(max(candidates, 2))  # by chance, one candidate in all gets so far
    strong = total.where(F.col("gain") > bar).orderBy(F.desc("gain"), "stem").limit(MOST_STEMS)
    found = {r.stem: r for r in strong.collect()}
    longer: dict[str, list[str]] = {}
    for x in found:
        longer.setdefault(x[:-1], []).append(x)

    def best(x: str) -> tuple[float, list[str]]:
        """The stem itself or the best choice of longer ones, whichever explains more; the longer on a tie."""
        parts = [best(y) for y in sorted(longer.get(x, ()))]
        gain = sum(g for g, _ in parts)
        own = found[x].gain - bar
        return (gain, [y for _, ys in parts for y in ys]) if parts and gain >= KEEPS * own else (own, [x])

    roots = [x for x in found if x[:-1] not in found]
    chosen = {x for r in sorted(roots) for x in best(r)[1]}
    # what a chosen stem was lengthened from stays for words that are new, at the weight of all its words
    chosen |= {x[:k] for x in chosen for k in range(SHORTEST, len(x)) if x[:k] in found and found[x[:k]].p > 1.5 * found[x].p}
    odds = {x: math.log((found[x].p + 0.5) / (found[x].n + 0.5)) - math.log(share / (1 - share)) for x in chosen}
    return {x: w for x, w in odds.items() if w > 0}


@dataclass
class Model:
    stems: dict[str, float]
    weights: np.ndarray


def fit(docs: DataFrame, labels: DataFrame, rows: int = training.SAMPLE_ROWS) -> Model:
    seen = training.sample(docs, labels, "toxic", rows)
    seeds = {s + "$": 2.0 for s in SEEDS}
    sketch = seen.select("doc_id", "text").mapInPandas(releasing(_leading), "doc_id long, sketch long")
    keep = frozenset(r[0] for r in sketch.groupBy("sketch").agg(F.min("doc_id")).select("min(doc_id)").collect())  # at most the sample's rows
    ys = [r.y for r in seen.select("doc_id", "y").collect() if r.doc_id in keep]
    if not any(ys):
        return Model(seeds, PRIOR)
    counts = written(seen.mapInArrow(releasing(_count(keep)), "stem string, toxic long, clean long"), "stems")
    stems = seeds | choose(counts, sum(map(bool, ys)), sum(not y for y in ys))
    found = seen.mapInPandas(releasing(_matched(stems)), "y int, m array<double>").collect()
    return Model(stems, fit_weights(features(np.array([r.m for r in found])), np.array([float(r.y) for r in found])))


def _matched(stems: dict[str, float]):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        grammar = Grammar(stems)
        for b in batches:
            yield pd.DataFrame({"y": b["y"], "m": [grammar.matches(t).tolist() for t in b["text"]]})

    return run


def _scored(model: Model, at: str = "text"):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        grammar = Grammar(model.stems)
        for b in batches:
            m = np.array([grammar.matches(t or "") for t in b.pop(at)]).reshape(-1, len(KINDS) * FLAGS + 1)
            z = features(m) @ model.weights if len(m) else np.zeros(0)
            yield b.assign(score=1 / (1 + np.exp(-np.clip(z, -30, 30))))

    return run


def score(docs: DataFrame, model: Model) -> DataFrame:
    """docs: doc_id, text. Returns doc_id, score, predicted."""
    out = small_batches(docs).select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInPandas(releasing(_scored(model)), "doc_id long, score double")
    return out.withColumn("predicted", (F.col("score") >= TOXIC).cast("int"))


def clean(docs: DataFrame, model: Model) -> DataFrame:
    """The documents that are not toxic, with all their columns, filtered where they are read; nothing is joined."""
    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        grammar = Grammar(model.stems)
        for b in batches:
            m = np.array([grammar.matches(t or "") for t in b.column("text").to_pylist()]).reshape(-1, len(KINDS) * FLAGS + 1)
            z = features(m) @ model.weights if len(m) else np.zeros(0)
            yield b.filter(pa.array(1 / (1 + np.exp(-np.clip(z, -30, 30))) < TOXIC))

    return small_batches(docs).mapInArrow(releasing(keep), docs.schema)


def op4_toxicity(spark, sf_dir: str) -> DataFrame:
    docs, labels = (spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("documents", "labels"))
    out = score(docs, fit(docs, labels))
    return out.select("doc_id", training.held_out(F.col("doc_id")).alias("held_out"), "score", "predicted")
