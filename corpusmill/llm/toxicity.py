"""Toxicity: a learned lexicon, met exactly or misspelled, weighed by its surroundings.

The lexicon (words and stems) is learned from a bounded sample of labelled
documents: terms that toxic documents contain and clean ones hardly ever, or
hardly ever twice, chosen greedily until the toxic documents are explained, so
that the filler of a text with many copies does not enter. Misspellings are
caught by an intersection of Levenshtein automata with the lexicon's trie. Each
hit is looked at in a window: between quotation marks, or close to other hits.
How surprising the hits would be in a clean text of the same length, and their
numbers by kind, go through a logistic regression to a probability.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusmill.llm.automaton import NOTHING, STEM, STEM_1, WORD, WORD_1, WORD_2, Automaton, build, judge
from corpusmill.llm.batches import small_batches
from corpusmill.llm.langid import held_out
from corpusmill.llm.letters import code_points
from corpusmill.llm.wordcodes import chunks

#: Quotation marks by kind, and what each is where its neighbours do not tell (1 opens, 2 closes, 0 by turns).
QUOTES = ({"\"": 0}, {"“": 1, "”": 2, "„": 1}, {"«": 1, "»": 2}, {"‹": 1, "›": 2}, {"‘": 1, "’": 2})
APOSTROPHES = "‘’"
FEATURES = 10


@dataclass(frozen=True)
class Toxicity:
    """``toxic_rows`` and ``clean_rows`` bound the labelled sample, ``terms`` the lexicon."""

    toxic_rows: int = 2000
    clean_rows: int = 6000
    terms: int = 200
    candidates: int = 3000
    support: int = 8
    precision: float = 0.97
    precision_twice: float = 0.9
    cover: int = 3
    stem_lengths: tuple[int, ...] = (3, 4, 5, 6, 7)
    quote_window: int = 40
    close_window: int = 80
    cut: float = 0.3
    ridge: float = 0.5
    seed: int = 5


@dataclass
class Model:
    """Per word of clean text, ``rates`` are the terms' occurrences and ``loose`` any misspelling's.

    ``weak`` are the terms that clean texts do contain, ``harmless`` the words
    of clean texts that are no misspellings although they look like some.
    """

    automaton: Automaton
    rates: np.ndarray
    loose: float
    weak: np.ndarray
    weights: np.ndarray
    words: list[str]
    stems: list[str]
    harmless: frozenset[str] = frozenset()


@lru_cache(maxsize=1)
def _folded() -> np.ndarray:
    """Lower case of letters and digits, 0 elsewhere."""
    out = np.zeros(0x110000, dtype=np.uint32)
    for i in range(0x110000):
        c = chr(i)
        if c.isalnum():
            low = c.lower()
            out[i] = ord(low) if len(low) == 1 else i
    return out


@lru_cache(maxsize=4)
def _alphabet(symbols: str) -> np.ndarray:
    out = np.zeros(0x110000, dtype=np.int16)
    out[[ord(c) for c in symbols]] = np.arange(1, len(symbols) + 1)
    return out


def hits(column: pa.Array, a: Automaton, harmless: frozenset[str] = frozenset()) -> tuple[np.ndarray, ...]:
    """Code points, text bounds; start, end, verdict, term and text of each word the automaton takes; words per text.

    A word that is ``harmless`` is taken only if it is met exactly.
    """
    points, at = code_points(column)
    low = _folded()[points]
    inside = low > 0
    before = np.concatenate([[False], inside])
    before[at] = False
    after = np.concatenate([inside, [False]])
    after[at] = False
    start = np.flatnonzero(inside & ~before[:-1])
    end = np.flatnonzero(inside & ~after[1:]) + 1
    words = np.diff(np.searchsorted(start, at))
    verdict, term = judge(a, _alphabet(a.symbols)[low], start, end)
    hit = np.flatnonzero(verdict != NOTHING)
    if harmless:
        near = hit[(verdict[hit] != WORD) & (verdict[hit] != STEM)]
        verdict[near[[form in harmless for form in _forms(low, start[near], end[near])]]] = NOTHING
        hit = np.flatnonzero(verdict != NOTHING)
    start, end = start[hit], end[hit]
    return points, at, start, end, verdict[hit], term[hit], np.searchsorted(at, start, side="right") - 1, words


def _forms(low: np.ndarray, start: np.ndarray, end: np.ndarray) -> list[str]:
    """The folded words from ``start`` to ``end``."""
    return ["".join(map(chr, low[s:e])) for s, e in zip(start.tolist(), end.tolist(), strict=True)]


@lru_cache(maxsize=1)
def _marks() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of each code point: its kind of quotation mark (from 1), what it is by itself, whether a word does not end before it."""
    kind, alone, loose = (np.zeros(0x110000, dtype=np.int8) for _ in range(3))
    for i, marks in enumerate(QUOTES, 1):
        for c, what in marks.items():
            kind[ord(c)], alone[ord(c)], loose[ord(c)] = i, what, 1
    for i in range(0x110000):
        c = chr(i)
        if c.isspace() or c in "([{-–—":
            loose[i] = 2 if c.isspace() else 1
    return kind, alone, loose


def quotations(points: np.ndarray, at: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
    """Per kind of marks, where quotations open and close.

    A mark after a space (or bracket, dash, mark) opens, one before no letter
    closes; the rest go by their form, straight ones by turns. An opening mark
    and the next one of its kind, if that closes, are a pair. Curly single marks between letters are
    apostrophes, and a closing one never opens, so an apostrophe at a word's end closes only what is open.
    """
    kind, alone, loose = _marks()
    all_marks = np.flatnonzero(kind[points])
    of = kind[points[all_marks]]
    out = []
    for k in range(1, len(QUOTES) + 1):
        marks = all_marks[of == k]
        text = np.searchsorted(at, marks, side="right") - 1
        # Beyond a text there are spaces.
        left = np.where(marks > at[text], points[np.maximum(marks, 1) - 1], 32)
        right = np.where(marks + 1 < at[text + 1], points[np.minimum(marks + 1, len(points) - 1)], 32)
        before, after = _folded()[left] > 0, _folded()[right] > 0
        single = np.isin(points[marks], [ord(c) for c in APOSTROPHES])
        own = ~(single & before & after)
        marks, text, left, right, after, single = (x[own] for x in (marks, text, left, right, after, single))
        turn = 1 + (np.arange(len(marks)) - np.searchsorted(text, text)) % 2
        form = alone[points[marks]]
        what = np.where((loose[left] > 0) & (loose[right] != 2), 1, np.where((loose[left] == 0) & ~after, 2,
                                                                             np.where(form > 0, form, turn)))
        what = np.where(single & (form == 2), 2, what)
        pair = np.flatnonzero((what[:-1] == 1) & (what[1:] == 2) & (text[:-1] == text[1:]))
        out.append((marks[pair], marks[pair + 1]))
    return out


def features(column: pa.Array, m: Model, p: Toxicity) -> np.ndarray:
    """Per text: surprise and number of hits by kind, quoted ones apart, hits near others, and their rate."""
    points, at, start, end, verdict, term, text, words = hits(column, m.automaton, m.harmless)
    n = len(column)
    plain = np.ones(len(start), dtype=bool)
    for opens, closes in quotations(points, at) if len(start) else ():
        if len(opens):
            pair = np.searchsorted(opens, start) - 1
            plain &= ~((pair >= 0) & (opens[pair] >= start - p.quote_window) & (closes[pair] >= end)
                       & (closes[pair] < end + p.quote_window))
    near = np.zeros(len(start), dtype=bool)
    if len(start) > 1:
        close = (text[1:] == text[:-1]) & (start[1:] - end[:-1] <= p.close_window)
        near[1:] |= close
        near[:-1] |= close
    exact = plain & ((verdict == WORD) | (verdict == STEM))
    loose = plain & ~exact
    weak = m.weak[term]
    # A misspelled term is a term of its own, as rare as misspellings are in clean texts.
    kind = np.where(exact, term, term + len(m.rates))
    rates = np.concatenate([m.rates, np.full(len(m.rates), m.loose)])

    def per_text(which: np.ndarray) -> np.ndarray:
        return np.bincount(text[which], minlength=n).astype(float)

    return np.stack([
        np.minimum(12, _surprise(text[plain], kind[plain], words, rates)),
        np.log1p(per_text(exact & ~weak) + 0.5 * per_text(loose)), np.log1p(per_text(exact & weak)), np.minimum(1, per_text(exact & weak)),
        np.log1p(per_text(plain & (verdict == WORD_1))), np.log1p(per_text(plain & (verdict == WORD_2))),
        np.log1p(per_text(plain & (verdict == STEM_1))), np.log1p(per_text(~plain)),
        np.log1p(per_text(plain & near & ~weak)), np.minimum(1.0, 20 * per_text(plain) / np.maximum(words, 20)),
    ], axis=1)


def _surprise(text: np.ndarray, term: np.ndarray, words: np.ndarray, rates: np.ndarray) -> np.ndarray:
    """Per text, minus log10 of the chance of at least so many hits of each term in clean text of its length."""
    out = np.zeros(len(words))
    pair, count = np.unique(text * max(1, len(rates)) + term, return_counts=True)
    text, term = pair // max(1, len(rates)), pair % max(1, len(rates))
    expected = rates[term] * words[text]
    factorial = np.cumsum(np.log(np.maximum(1, np.arange(count.max() + 1)))) if len(count) else np.zeros(1)
    log = count * np.log(expected) - expected - factorial[count]
    log -= np.log(np.maximum(1e-3, 1 - expected / (count + 1)))
    np.add.at(out, text, np.where(expected < count, np.maximum(0, -log / np.log(10)), 0))
    return out


def sample(docs: DataFrame, labels: DataFrame, p: Toxicity) -> DataFrame:
    """``id, text, toxic, share``: labelled documents by hash, up to the bound of each label."""
    known = labels.where("toxic IN (0, 1)").groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    counts = {r["toxic"]: r["n"] for r in known.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    place = F.xxhash64("doc_id", F.lit(p.seed))
    parts = [known.where(F.col("toxic") == t).orderBy(place, "doc_id").limit(most)
             .withColumn("share", F.lit(max(1.0, counts.get(t, 0) / most)))
             for t, most in ((0, p.clean_rows), (1, p.toxic_rows))]
    few = parts[0].union(parts[1])  # a row is 20 bytes, their number is bounded
    texts = docs.select("doc_id", F.col("text").alias("text")).join(F.broadcast(few), "doc_id")
    return texts.select(F.xxhash64("doc_id").alias("id"), "text", F.col("toxic").cast("int").alias("toxic"), "share")


def _terms(rows: DataFrame, p: Toxicity) -> DataFrame:
    """``id, toxic, term, n``: words and stems (ending in ``*``) of each document and how often it has them."""
    words = rows.select("id", "toxic", F.explode(F.regexp_extract_all(
        F.lower("text"), F.lit(r"[\p{L}\p{N}]+"), F.lit(0))).alias("w")).groupBy("id", "toxic", "w").agg(
        F.count("*").alias("n"))
    stems = [F.when(F.length("w") >= k, F.concat(F.substring("w", 1, k), F.lit("*"))) for k in p.stem_lengths]
    terms = words.select("id", "toxic", F.explode(F.array("w", *stems)).alias("term"), "n").where("term IS NOT NULL")
    return terms.groupBy("id", "toxic", "term").agg(F.sum("n").alias("n"))


def learn_lexicon(rows: DataFrame, p: Toxicity) -> tuple[list[str], list[str], set[str]]:
    """Words and stems that tell the toxic documents of the sample from the clean ones, and those that do so if met twice."""
    sizes = rows.agg(F.sum("toxic").alias("t"), F.sum(1 - F.col("toxic")).alias("c")).first()
    if not sizes["t"] or not sizes["c"]:
        return [], [], set()
    least = min(p.support, max(2, sizes["t"] // 10))
    sums = {f"{s}{k}": F.sum(F.when((F.col("toxic") == v) & (F.col("n") >= k), 1).otherwise(0))
            for s, v in (("t", 1), ("c", 0)) for k in (1, 2)}
    counts = _terms(rows, p).groupBy("term").agg(*(f.alias(k) for k, f in sums.items()))

    def rate(k: int):
        t = F.col(f"t{k}") / sizes["t"]
        return t / (t + F.col(f"c{k}") / sizes["c"])

    # A stem of three letters has to be surer than that.
    sure = F.when(F.length("term") > 4, p.precision).when(F.col("term").endswith("*"), (4 + p.precision) / 5).otherwise(p.precision)
    kinds = counts.withColumn("twice", F.when((F.col("t1") >= least) & (rate(1) >= sure), False)
                              .when((F.col("t2") >= least) & (rate(2) >= p.precision_twice), True))
    good = kinds.where("twice IS NOT NULL").orderBy(F.desc(F.when(F.col("twice"), F.col("t2")).otherwise(F.col("t1"))),
                                                    "term").limit(p.candidates).select("term", "twice")
    pairs = _terms(rows.where("toxic = 1"), p).join(F.broadcast(good), "term").where("NOT twice OR n >= 2").select(
        "id", "term", "twice").toPandas()
    docs = {i: k for k, i in enumerate(pairs["id"].unique())}
    has = {t: np.array([docs[i] for i in g]) for t, g in pairs.groupby("term")["id"]}
    twice = set(pairs["term"][pairs["twice"]])
    need = np.full(len(docs), p.cover)
    chosen: list[str] = []
    while has and len(chosen) < p.terms:
        # Most documents that still lack an explanation; of about as many, the surer, the whole word, the longer stem.
        gains = {t: int((need[d] > 0).sum()) for t, d in has.items()}
        term = max(gains, key=lambda t: (int(20 * math.log(max(1, gains[t]))), t not in twice, t[-1] != "*", len(t), t))
        if gains[term] < least:
            break
        need[has.pop(term)] -= 1
        chosen.append(term)
        # What a chosen stem covers, and a shorter stem of the same, explains nothing more.
        stem = term.rstrip("*")
        has = {t: d for t, d in has.items()
               if not ((term.endswith("*") and t.startswith(stem)) or (t.endswith("*") and stem.startswith(t[:-1])))}
    words, stems = [sorted(t.rstrip("*") for t in chosen if t.endswith("*") == e) for e in (False, True)]
    return words, stems, {t.rstrip("*") for t in chosen if t in twice}


def train(docs: DataFrame, labels: DataFrame, p: Toxicity = Toxicity()) -> Model:
    """Fit on rows of ``docs`` that ``labels`` marks toxic 0 or 1; of double labels the toxic one counts."""
    small_batches(docs.sparkSession)
    rows = sample(docs, labels, p)
    words, stems, weak = learn_lexicon(rows, p)
    automaton = build(words, stems, weak)
    terms = len(words) + len(stems)

    def clean(batches) -> Iterator[pa.RecordBatch]:
        """Of clean texts: misspelled forms and in how many texts, exact terms and how often, all words under -1."""
        for batch in chunks(batches, "text"):
            points, _, start, end, verdict, term, text, per = hits(batch.column(0), automaton)
            exact = (verdict == WORD) | (verdict == STEM)
            forms = Counter(form for _, form in set(zip(
                text[~exact].tolist(), _forms(_folded()[points], start[~exact], end[~exact]), strict=True)))
            found, n = np.unique(term[exact], return_counts=True)
            yield pa.RecordBatch.from_arrays(
                [pa.array([*forms, *[None] * (len(found) + 1)], pa.string()),
                 pa.array([*[None] * len(forms), *map(int, found), -1], pa.int32()),
                 pa.array([*forms.values(), *map(int, n), int(per.sum())], pa.int64())], names=["form", "term", "n"])

    # The sample of clean documents bounds the forms.
    seen = rows.where("toxic = 0").select("text").mapInArrow(clean, "form string, term int, n long").groupBy(
        "form", "term").agg(F.sum("n").alias("n")).toPandas()
    n = dict(zip(seen["term"][seen["form"].isna()].astype(int), seen["n"][seen["form"].isna()], strict=True))
    rates = np.array([n.get(i, 0) + 0.5 for i in range(terms)] or [1.0]) / max(1, n.get(-1, 0))
    # Forms not seen before turn up about as often as forms seen once did.
    loose = ((seen["n"][seen["form"].notna()] == 1).sum() + 0.5) / max(1, n.get(-1, 0))
    # Misspellings that clean documents of the sample contain are words of their own.
    model = Model(automaton, rates, loose, np.array([t in weak for t in words + stems] or [False]), np.zeros(FEATURES + 1),
                  words, stems, frozenset(seen["form"].dropna()))

    def measure(batches) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches, "text"):
            x = features(batch.column(0), model, p)
            yield pa.RecordBatch.from_arrays([*map(pa.array, x.T), *batch.columns[1:]],
                                             names=[*(f"x{i}" for i in range(FEATURES)), "toxic", "share"])

    seen = rows.select("text", "toxic", "share").mapInArrow(
        measure, ", ".join(f"x{i} double" for i in range(FEATURES)) + ", toxic int, share double").toPandas()
    seen = seen.sort_values(list(seen.columns))
    model.weights = _logistic(seen.to_numpy(dtype=float), p.ridge)
    return model


def _logistic(rows: np.ndarray, ridge: float) -> np.ndarray:
    """Ridge regression of the last column but one on the others, weighted by the last; intercept first."""
    if not len(rows):
        return np.concatenate([[-4.0], np.zeros(FEATURES)])
    x = np.concatenate([np.ones((len(rows), 1)), rows[:, :FEATURES]], axis=1)
    y, w = rows[:, FEATURES], rows[:, FEATURES + 1]
    beta = np.zeros(x.shape[1])
    penalty = np.full(x.shape[1], ridge)
    penalty[0] = 1e-3
    for _ in range(50):
        mu = 1 / (1 + np.exp(-np.clip(x @ beta, -30, 30)))
        gradient = x.T @ (w * (y - mu)) - penalty * beta
        hessian = (x * (w * mu * (1 - mu))[:, None]).T @ x + np.diag(penalty)
        step = np.linalg.solve(hessian, gradient)
        step *= min(1.0, 4 / max(np.abs(step).max(), 1e-12))
        beta += step
        if np.abs(step).max() < 1e-8:
            break
    return beta


def score(docs: DataFrame, model: Model, p: Toxicity = Toxicity()) -> DataFrame:
    """``doc_id, held_out, score, predicted`` of every row of ``docs`` (doc_id, text, held_out).

    Null and empty texts have no hits and get the score of a text without any.
    """
    small_batches(docs.sparkSession)
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches) -> Iterator[pa.RecordBatch]:
        m = sent.value
        for batch in chunks(batches, "text"):
            x = features(batch.column(2), m, p)
            value = 1 / (1 + np.exp(-np.clip(m.weights[0] + x @ m.weights[1:], -30, 30)))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(value), pa.array((value >= p.cut).astype(np.int32))],
                names=["doc_id", "held_out", "score", "predicted"])

    slim = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "held_out", "text")
    return slim.mapInArrow(run, "doc_id long, held_out boolean, score double, predicted int")


def toxicity(docs: DataFrame, labels: DataFrame, p: Toxicity = Toxicity()) -> DataFrame:
    """Scores of all documents, learned from labelled ones that are not held out.

    Without labels of both kinds nothing is learned and every score is the
    same low number. Scores depend on the rows alone, not on how they are
    partitioned; repeated rows get the same score each, and a very long text
    is scored as a whole. Of repeated labels the toxic one counts.
    """
    known = labels.select("doc_id", "toxic").where(~held_out(F.col("doc_id")))
    model = train(docs, known, p)
    return score(docs.select("doc_id", "text", held_out(F.col("doc_id")).alias("held_out")), model, p)
