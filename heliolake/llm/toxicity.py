"""Toxicity by a weighted finite-state pattern grammar with terminals learned from labels.

Terminals are words or word beginnings with a weight (log odds). They come from a bounded sample of
labelled rows, counted by Spark; a short fixed list of common insults stands in where labels say
nothing. A terminal hit opens the clause around it. The clause is tokenised and passed through
five transducers, each of which rewrites the annotations of the one before:

``insult`` marks terminals, ``threat`` a verb of harm aimed at a target, ``target`` raises the
weight of a mark beside a person word, ``negation`` lowers one that a negator governs, and ``reported``
lowers all of a clause that quotes or reports.

The document's evidence (sum and maximum of the clause weights, marked clauses) goes through a logistic
function fitted on the third of the sample that the terminals did not come from. Texts are scored whole, in Python
tasks that need no shuffle; the model is a small bounded object.

Defined results: null or empty text scores as a text without evidence; repeated rows score alike;
labels for missing documents are ignored; without usable labels the fixed list and fixed
coefficients serve; extra columns are not read.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from heliolake.llm.common import short_batches, stored, table, text_or_empty

THRESHOLD = 0.7
#: Labelled rows that the model is fitted on, at most (the lowest hashes of their ids).
SAMPLE_ROWS = 20_000
#: Terminals kept, at most.
MOST_TERMINALS = 4_000
LEAST_DOCS = 5
LEAST_PRECISION = 0.6
PREFIXES = (3, 4, 5, 6, 7, 8)
LONGEST_WORD = 32

# fixed values: the grammar's closed classes
INSULTS = ("asshole", "bastard", "bitch", "clown", "crap", "damn", "disgusting", "dumb", "fool", "freak", "garbage", "idiot",
           "idiotic", "imbecile", "jerk", "loser", "moron", "pathetic", "pig", "scum", "shit", "stupid", "trash", "ugly",
           "vermin", "worthless")
HARM = frozenset(("kill", "hurt", "destroy", "burn", "beat", "stab", "shoot", "smash", "murder", "strangle"))
TARGETS = frozenset(("you", "your", "yours", "u", "he", "him", "she", "her", "they", "them", "their", "these", "those", "people",
                     "everyone", "everybody", "someone"))
NEGATORS = frozenset(("not", "no", "never", "isn't", "aren't", "wasn't", "weren't", "don't", "doesn't", "didn't", "nobody", "without", "hardly"))
REPORTS = frozenset(("said", "says", "wrote", "writes", "claimed", "claims", "called", "quoted", "reported", "alleged", "according"))
MODALS = frozenset(("will", "gonna", "should", "must", "would", "i'll", "we'll", "going"))

PRIOR_WEIGHT = 3.0
HARM_WEIGHT = 3.0
AIMED, NEGATED, REPORTED = 1.25, 0.5, 0.6
REACH = 4

WORD = re.compile(r"[^\W\d_]+(?:['’][^\W\d_]+)?")
CLAUSE_ENDS = ".!?;:\n"
CLAUSE_END = re.compile(f"[{CLAUSE_ENDS}]")


@dataclass
class Grammar:
    """Terminals (``word`` exact, ``word*`` word beginning) with weights, and the logistic coefficients."""

    terminals: dict[str, float]
    coefficients: tuple[float, ...] = (-3.0, 0.8, 0.4, 0.3)
    _machine: object = field(default=None, repr=False, compare=False)

    def __getstate__(self):
        return {"terminals": self.terminals, "coefficients": self.coefficients, "_machine": None}

    def machine(self):
        if self._machine is None:
            m = ahocorasick.Automaton()
            for t in self.terminals:
                m.add_word(t.rstrip("*"), (len(t.rstrip("*")), t.endswith("*")))
            for t in HARM:
                if t not in m:
                    m.add_word(t, (len(t), False))
            # a word that is both exact and a beginning keeps the beginning, which covers both
            for t in self.terminals:
                if t.endswith("*"):
                    m.add_word(t[:-1], (len(t) - 1, True))
            m.make_automaton()
            self._machine = m
        return self._machine

    def weight(self, word: str) -> float:
        best = self.terminals.get(word, 0.0)
        for n in PREFIXES:
            if len(word) > n:
                best = max(best, self.terminals.get(word[:n] + "*", 0.0))
        return best


# the transducers: lists of (word, class, weight), one list per clause

Marks = list[tuple[str, str, float]]


def insult(words: list[str], grammar: Grammar) -> Marks:
    return [(w, "insult", x) if (x := grammar.weight(w)) > 0 else (w, "", 0.0) for w in words]


def threat(marks: Marks) -> Marks:
    out = list(marks)
    for i, (w, _, _) in enumerate(marks):
        if w in HARM:
            near = {x for x, *_ in marks[max(0, i - REACH):i + REACH + 1]}
            if near & TARGETS and near & MODALS:
                out[i] = (w, "threat", HARM_WEIGHT)
    return out


def target(marks: Marks) -> Marks:
    return [(w, c, x * AIMED if c and any(v in TARGETS for v, *_ in marks[max(0, i - REACH):i + REACH + 1]) else x)
            for i, (w, c, x) in enumerate(marks)]


def negation(marks: Marks) -> Marks:
    return [(w, c, x * NEGATED if c and any(v in NEGATORS for v, *_ in marks[max(0, i - REACH + 1):i]) else x)
            for i, (w, c, x) in enumerate(marks)]


def reported(marks: Marks, quoted: bool) -> Marks:
    says = quoted or any(w in REPORTS for w, *_ in marks)
    return [(w, c, x * REPORTED if c and says else x) for w, c, x in marks]


def clause_weight(clause: str, grammar: Grammar) -> float:
    words = [m[0].replace("’", "'") for m in WORD.finditer(clause)]
    marks = reported(negation(target(threat(insult(words, grammar)))), clause.count('"') >= 2)
    return sum(x for _, _, x in marks)


def hit_clauses(low: str, grammar: Grammar) -> list[tuple[int, int]]:
    """The whole clauses (start, end) of a lower-cased text that hold a terminal at a word's start; no character is looked at
    twice, however long a clause is."""
    out, end = [], -1
    for last, (n, beginning) in grammar.machine().iter(low):
        a = last - n + 1
        if a < end or (a and low[a - 1].isalpha()) or (not beginning and last + 1 < len(low) and low[last + 1].isalpha()):
            continue
        left = max(end, 0)
        left = max(left, *(low.rfind(c, left, a) + 1 for c in CLAUSE_ENDS))
        m = CLAUSE_END.search(low, last + 1)
        end = m.start() if m else len(low)
        out.append((left, end))
    return out


def evidence(text: str, grammar: Grammar) -> tuple[float, float, float]:
    """Sum of the clause weights (logarithmic beyond 1), their maximum, and marked clauses for each 100 words."""
    low = text.lower()
    weights = [w for a, b in hit_clauses(low, grammar) if (w := clause_weight(low[a:b], grammar)) > 0]
    if not weights:
        return 0.0, 0.0, 0.0
    n_words = max(1, low.count(" ") + low.count("\n") + 1)
    return math.log1p(sum(weights)), min(max(weights), 12.0), min(100.0 * len(weights) / n_words, 5.0)


def score(text: str, grammar: Grammar) -> float:
    b, *c = grammar.coefficients
    z = b + sum(x * y for x, y in zip(c, evidence(text, grammar)))
    return 1.0 / (1.0 + math.exp(-max(-30.0, min(30.0, z))))


# learning

def remainder(id_col: str = "doc_id") -> Column:
    """crc32 of the id as text, modulo 3 (null id: as an empty text)."""
    return F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary")) % 3


def training_sample(docs: DataFrame, labels: DataFrame, rows: int = SAMPLE_ROWS) -> DataFrame:
    """``text, toxic, part`` (0 to 2) of at most ``rows`` labelled documents that are not held out, one per different text."""
    picked = (labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("int").alias("toxic"))
              .where(F.col("toxic").isin(0, 1) & F.col("doc_id").isNotNull() & (remainder() != 1))
              .groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
              .orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows))
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("text"))
    # at most `rows` pairs of numbers, a bound that the limit above proves
    sample = stored(texts.join(F.broadcast(picked), "doc_id").withColumn("h", F.md5("text")), "toxicity-sample")
    # equal texts count once: the smallest id of each stays, found without moving a text
    one = sample.groupBy("h").agg(F.min("doc_id").alias("doc_id"), F.max("toxic").alias("toxic"))
    return (sample.drop("toxic").join(F.broadcast(one), ["h", "doc_id"])
            .select("text", "toxic", (F.crc32(F.col("h").cast("binary")) % 3).cast("int").alias("part")))


def features(text: str) -> set[str]:
    """The words of a text and their beginnings."""
    words = {w for w in WORD.findall(text.lower()) if len(w) <= LONGEST_WORD}
    return words | {w[:n] + "*" for w in words for n in PREFIXES if len(w) > n}


def _document_counts(among: frozenset[str] | None):
    """(feature, documents that have it), summed over a task's rows; the feature ``""`` counts all documents."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter[str] = Counter()
        for batch in batches:
            for text in batch.column("text").to_pylist():
                found = features(text)
                counts.update(found if among is None else found & among)
                counts[""] += 1
        items = list(counts.items())
        for i in range(0, len(items), 50_000):
            part = items[i:i + 50_000]
            yield pa.RecordBatch.from_arrays([pa.array([k for k, _ in part], pa.string()), pa.array([v for _, v in part], pa.int64())], names=["feature", "n"])
    return run


def _evidence_of(grammar: Grammar):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [evidence(t, grammar) for t in batch.column("text").to_pylist()]
            cols = list(zip(*rows)) if rows else [[]] * 3
            yield pa.RecordBatch.from_arrays([*[pa.array(list(c), pa.float64()) for c in cols], batch.column("toxic")], names=["s", "m", "d", "toxic"])
    return run


def fit_logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1e-2, steps: int = 30) -> tuple[float, ...]:
    """Newton's method with a small ridge penalty; more evidence never lowers a score, so a feature
    whose coefficient comes out negative is left out and the others are fitted again."""
    use = list(range(x.shape[1]))
    while True:
        z = np.column_stack([np.ones(len(x)), x[:, use]])
        b = np.zeros(z.shape[1])
        for _ in range(steps):
            p = 1 / (1 + np.exp(-np.clip(z @ b, -30, 30)))
            step = np.linalg.solve((z.T * (p * (1 - p))) @ z + ridge * np.eye(len(b)), z.T @ (y - p) - ridge * b)
            b += step
            if abs(step).max() < 1e-6:
                break
        if not use or b[1:].min() >= 0:
            full = np.zeros(x.shape[1])
            full[use] = b[1:]
            return (float(b[0]), *map(float, full))
        use.pop(int(b[1:].argmin()))


def learned_terminals(sample: DataFrame) -> dict[str, float]:
    """Features of label 1 with their log odds. Only those that enough documents of label 1 hold are
    counted over label 0; the sample's bound is theirs, too."""
    def counts(label: int, among: frozenset[str] | None, least: int) -> dict[str, int]:
        rows = sample.where(F.col("toxic") == label).select("text").mapInArrow(_document_counts(among), "feature string, n long")
        return {r["feature"]: r["n"] for r in rows.groupBy("feature").agg(F.sum("n").alias("n")).where((F.col("n") >= least) | (F.col("feature") == "")).collect()}

    pos = counts(1, None, LEAST_DOCS)
    neg = counts(0, frozenset(pos), 1)
    n1, n0 = pos.pop("", 0), neg.pop("", 0)
    if not n1 or not n0:
        return {}
    found = {}
    for f, p in pos.items():
        q = neg.get(f, 0)
        odds = math.log((p + 0.5) / (n1 + 1)) - math.log((q + 0.5) / (n0 + 1))
        if odds > 0 and p >= LEAST_PRECISION * (p + q):
            found[f] = (min(odds, 8.0), p)
    best = sorted(found, key=lambda f: (-found[f][0] * math.log(found[f][1]), f))[:MOST_TERMINALS]
    return pruned({f: found[f] for f in best})


def pruned(found: dict[str, tuple[float, int]]) -> dict[str, float]:
    """One terminal for each family: a beginning only where it covers clearly more documents than the
    words it stands for, and a longer form only where it weighs clearly more than a kept beginning."""
    def beginnings(t: str) -> list[str]:
        stem = t.rstrip("*")
        return [stem[:n] + "*" for n in PREFIXES if n < len(stem)] + ([stem + "*"] if not t.endswith("*") else [])

    longer: dict[str, int] = {}
    for t, (_, n) in found.items():
        for p in beginnings(t):
            longer[p] = max(longer.get(p, 0), n)
    wide = {t: w for t, (w, n) in found.items() if not t.endswith("*") or longer.get(t, 0) < 0.85 * n}
    return {t: w for t, w in wide.items() if not any(wide.get(p, 0.0) >= 0.9 * w for p in beginnings(t))}


def learn(docs: DataFrame, labels: DataFrame, rows: int = SAMPLE_ROWS) -> Grammar:
    short_batches(docs.sparkSession)
    prior = {w: PRIOR_WEIGHT for w in INSULTS}
    sample = training_sample(docs, labels, rows)
    grammar = Grammar(prior | learned_terminals(sample.where("part > 0")))
    held = sample.where("part = 0").select("text", "toxic").mapInArrow(_evidence_of(grammar), "s double, m double, d double, toxic int").collect()
    y = np.array([r["toxic"] for r in held], float)
    if 0 < y.sum() < len(y):
        grammar.coefficients = fit_logistic(np.array([[r["s"], r["m"], r["d"]] for r in held]), y)
    return grammar


def _score_rows(grammar: Grammar):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            scores = pa.array([score(t.as_py(), grammar) for t in batch.column("text")], pa.float64())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("held_out"), scores], names=["doc_id", "held_out", "score"])
    return run


def toxicity(docs: DataFrame, grammar: Grammar, threshold: float = THRESHOLD) -> DataFrame:
    """``doc_id, held_out, score, predicted`` for every row."""
    short_batches(docs.sparkSession)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), (remainder() == 1).alias("held_out"), text_or_empty().alias("text"))
    scored = rows.mapInArrow(_score_rows(grammar), "doc_id long, held_out boolean, score double")
    return scored.withColumn("predicted", (F.col("score") >= threshold).cast("int"))


def without_toxic(docs: DataFrame, grammar: Grammar, threshold: float = THRESHOLD, text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that score below the threshold, with all their columns."""
    short_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = [score(t.as_py() or "", grammar) < threshold for t in batch.column(text_col)]
            yield batch.filter(pa.array(keep, pa.bool_()))
    return docs.mapInArrow(run, docs.schema)


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op10: the grammar learned from ``labels`` outside the held-out third scores all ``documents``."""
    docs = table(spark, sf_dir, "documents")
    return toxicity(docs, learn(docs, table(spark, sf_dir, "labels")))
