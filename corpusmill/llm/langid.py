"""Language identification: multinomial naive Bayes over hashed character n-grams.

Every letter gives three features: itself, the pair with the letter before and
the triple with both neighbours, where anything but a letter counts as a word
border. Features are hashed to a fixed number of buckets. The model is a matrix
(bucket, language) of log-probabilities, sent to the executors: whole for a few
languages, and for many as the entries of buckets that a language has been seen
with, over what an unseen bucket counts in it. Languages whose entries exceed a
bound of bytes are scored in several such parts, one after the other, each text
carrying its best language and the sum of its probabilities so far.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType, StructField, StructType

from corpusmill.llm.batches import small_batches
from corpusmill.llm.letters import lower_letters
from corpusmill.llm.wordcodes import chunks
from corpusmill.runtime import materialise

UNKNOWN = "und"
#: Letters that are scored together.
SLICE = 1 << 17
#: Languages whose shares are sent to every task, at most.
SENT = 1 << 20


@dataclass(frozen=True)
class LangId:
    """``per_language``: about how many labelled documents of a language train it, chosen by hash.

    Up to ``dense`` languages are a whole matrix; ``max_bytes`` bounds what is sent to a task at once.
    """

    bits: int = 16
    per_language: int = 4000
    smoothing: float = 0.5
    max_bytes: int = 256 << 20
    min_score: float = 0.35
    dense: int = 64


@dataclass(frozen=True)
class Model:
    """Languages in order, log-probabilities by (bucket, language), and of the languages themselves."""

    languages: list[str]
    logp: np.ndarray
    prior: np.ndarray


@dataclass(frozen=True)
class Part:
    """Some of many languages: per bucket the languages seen with it and what it adds to ``unseen``, its weight elsewhere."""

    languages: list[str]
    start: np.ndarray
    lang: np.ndarray
    weight: np.ndarray
    unseen: np.ndarray
    prior: np.ndarray


def held_out(doc_id: Column, folds: int = 4, fold: int = 2) -> Column:
    """Whether the fold of a document is kept from training. A null id is not held out."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % folds == fold, F.lit(False))


def features(column: pa.Array, bits: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Three buckets per letter and the bounds of each text's letters."""
    c, at = lower_letters(column)
    n = len(c)
    wide = np.zeros(n + 2, dtype=np.uint64)
    wide[1:-1] = c
    before, after = wide[:-2].copy(), wide[2:].copy()
    inner = at[:-1][np.diff(at) > 0]
    before[inner] = 0
    after[at[1:][np.diff(at) > 0] - 1] = 0
    where = np.flatnonzero(c)
    bounds = np.searchsorted(where, at)
    a, b, d = before[where], wide[1:-1][where], after[where]
    shift = np.uint64(64 - bits)
    one = (b * np.uint64(0xD6E8FEB86659FD93)) >> shift
    two = ((b + (a << np.uint64(21)) + np.uint64(1 << 60)) * np.uint64(0xD6E8FEB86659FD93)) >> shift
    three = ((b + (a << np.uint64(21)) + (d << np.uint64(42)) + np.uint64(1 << 63)) * np.uint64(0xA0761D6478BD642F)) >> shift
    return one.astype(np.int64), two.astype(np.int64), three.astype(np.int64), bounds


def _sample(labelled: DataFrame, counts: DataFrame, known: dict[str, int], p: LangId) -> DataFrame:
    """About ``per_language`` rows of each language; only the languages with more are looked up.

    These are at most a row per ``per_language`` rows of the table, and go to
    every task up to a number; then no text moves, however hot its language.
    """
    many = counts.where(F.col("n") > p.per_language).select(F.col("lang").alias("_lang"), (p.per_language / F.col("n")).alias("_share"))
    if sum(n > p.per_language for n in known.values()) <= SENT:
        many = F.broadcast(many)
    place = F.pmod(F.xxhash64("doc_id", F.lit(17)), F.lit(1 << 20))
    share = F.coalesce("_share", F.lit(1.0))
    return labelled.join(many, F.col("lang") == F.col("_lang"), "left").where(place < share * (1 << 20)).select("text", "lang")


def _counted(batches, bits: int) -> Iterator[pa.RecordBatch]:
    """Features of texts by (language, bucket), summed up over about a million entries."""
    size, held, n = 1 << bits, {}, 0

    def sent() -> Iterator[pa.RecordBatch]:
        for lang, parts in held.items():
            bucket, times = np.unique(np.concatenate(parts), return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(bucket), pa.string()), pa.array(bucket.astype(np.int32)),
                                              pa.array(times.astype(np.int64))], names=["lang", "b", "n"])
        held.clear()

    for batch in chunks(batches, "text"):
        one, two, three, bounds = features(batch.column(0), bits)
        for i, lang in enumerate(batch.column(1).to_pylist()):
            a, b = bounds[i], bounds[i + 1]
            if b > a:
                held.setdefault(lang, []).append(np.concatenate([one[a:b], two[a:b], three[a:b]]).astype(np.int32))
                n += 3 * (b - a)
        if n > size << 6:
            yield from sent()
            n = 0
    yield from sent()


def _learn(docs: DataFrame, p: LangId) -> tuple[DataFrame, list[str], np.ndarray]:
    """``(lang, b, n)`` of the sampled rows, the languages in order, and how many rows each has."""
    small_batches(docs.sparkSession)
    labelled = docs.where("lang IS NOT NULL").select("doc_id", "text", F.col("lang").alias("lang"))
    counts = labelled.groupBy("lang").agg(F.count("*").alias("n"))
    # One row per language; their names are part of the model.
    known = {r["lang"]: r["n"] for r in counts.collect()}
    names = sorted(known)
    seen = _sample(labelled, counts, known, p).mapInArrow(lambda b: _counted(b, p.bits), "lang string, b int, n long")
    return seen.groupBy("lang", "b").agg(F.sum("n").alias("n")), names, np.array([known[n] for n in names], dtype=float)


def _dense(seen: DataFrame, names: list[str], prior: np.ndarray, p: LangId) -> Model:
    size = 1 << p.bits
    total = np.zeros((size, len(names)))
    if names:
        rows = seen.toPandas()
        index = {name: i for i, name in enumerate(names)}
        total[rows.b.to_numpy(), rows.lang.map(index).to_numpy(dtype=np.int64)] = rows.n.to_numpy()
    total += p.smoothing
    return Model(names, np.log(total / total.sum(axis=0)).astype(np.float32), np.log(prior / prior.sum()))


def train(docs: DataFrame, p: LangId = LangId()) -> Model:
    """Fit on the rows of ``docs`` (doc_id, text, lang) with a lang; others are ignored. For a few languages."""
    return _dense(*_learn(docs, p), p)


def parts_of(docs: DataFrame, p: LangId = LangId()) -> Iterator[Part]:
    """The same model for any number of languages, in parts of at most ``max_bytes`` bytes or one language."""
    seen, names, prior = _learn(docs, p)
    yield from _parts(materialise(seen, "language-counts"), names, prior, p)


def _parts(seen: DataFrame, names: list[str], prior: np.ndarray, p: LangId) -> Iterator[Part]:
    size, prior = 1 << p.bits, np.log(prior / prior.sum())
    sums = {r["lang"]: (r["total"], r["entries"]) for r in
            seen.groupBy("lang").agg(F.sum("n").alias("total"), F.count("*").alias("entries")).collect()}
    i = 0
    while i < len(names):
        j, entries = i, 0
        while j < len(names) and (j == i or 12 * (entries + sums.get(names[j], (0, 0))[1]) <= p.max_bytes):
            entries += sums.get(names[j], (0, 0))[1]
            j += 1
        own = names[i:j]
        rows = seen.where(F.col("lang").between(own[0], own[-1])).toPandas() if len(names) > 1 else seen.toPandas()
        index = {name: k for k, name in enumerate(own)}
        rows = rows.assign(l=rows.lang.map(index).astype(np.int32)).sort_values(["b", "l"])
        total = np.array([sums.get(n, (0, 0))[0] for n in own], dtype=float) + p.smoothing * size
        yield Part(own, np.searchsorted(rows.b.to_numpy(), np.arange(size + 1)), rows.l.to_numpy(np.int32),
                   np.log(rows.n.to_numpy() / p.smoothing + 1.0), np.log(p.smoothing / total), prior[i:j])
        i = j


def _part_scores(column: pa.Array, part: Part) -> tuple[list[str], np.ndarray, np.ndarray, np.ndarray]:
    """Per text the best language of a part, its logarithm, the sum over the part relative to it, and the letters."""
    size = len(part.start) - 1
    one, two, three, bounds = features(column, size.bit_length() - 1)
    count, k = np.diff(bounds), len(part.languages)
    best, top, rest = [], np.empty(len(count)), np.empty(len(count))
    for i, n in enumerate(count):
        a, b = bounds[i], bounds[i + 1]
        logs = part.prior + 3 * n * part.unseen
        bucket, times = np.unique(np.concatenate([one[a:b], two[a:b], three[a:b]]), return_counts=True)
        lengths = part.start[bucket + 1] - part.start[bucket]
        ends = np.cumsum(lengths)
        x = 0
        while x < len(bucket):  # about SLICE entries at a time, or one bucket's
            y = max(x + 1, int(np.searchsorted(ends, (ends[x - 1] if x else 0) + SLICE, side="right")))
            own = lengths[x:y]
            at = np.repeat(part.start[bucket[x:y]] - (np.cumsum(own) - own), own) + np.arange(own.sum())
            logs += np.bincount(part.lang[at], weights=part.weight[at] * np.repeat(times[x:y], own), minlength=k)
            x = y
        w = int(logs.argmax())
        best.append(part.languages[w])
        top[i], rest[i] = logs[w], np.exp(logs - logs[w]).sum()
    return best, top, rest, count


def score_texts(column: pa.Array, model: Model) -> tuple[list[str], np.ndarray]:
    """The likeliest language of each text and its posterior probability."""
    bits = int(model.logp.shape[0]).bit_length() - 1
    one, two, three, bounds = features(column, bits)
    n, count = len(column), np.diff(bounds)
    if not model.languages:
        return [UNKNOWN] * n, np.zeros(n)
    logs = np.zeros((n, len(model.languages)))
    owner = np.repeat(np.arange(n), count)
    step = max(1, SLICE // len(model.languages))
    for i in range(0, len(one), step):
        rows = model.logp[one[i:i + step]] + model.logp[two[i:i + step]] + model.logp[three[i:i + step]]
        own = owner[i:i + step]
        first = np.flatnonzero(np.concatenate([[True], own[1:] != own[:-1]]))
        logs[own[first]] += np.add.reduceat(rows, first, axis=0, dtype=np.float64)
    logs += model.prior
    best = logs.argmax(axis=1)
    score = 1 / np.exp(logs - logs.max(axis=1, keepdims=True)).sum(axis=1)
    score[count == 0] = 0.0
    return [model.languages[b] if c else UNKNOWN for b, c in zip(best, count, strict=True)], score


def _added(docs: DataFrame, run, *columns: StructField) -> DataFrame:
    return docs.mapInArrow(run, StructType([*docs.schema.fields, *columns]))


def _predict_parts(docs: DataFrame, parts: Iterator[Part], text: str, out: tuple[str, str]) -> DataFrame:
    """Part after part: the better language stays, and the sums of both are added up. The first counts on a tie."""
    pred, score = out
    state = [f"{pred}_top", f"{pred}_rest"]
    rows, first = docs, True
    for k, part in enumerate(parts):
        if k and k % 4 == 0:
            rows = materialise(rows, "language-parts")  # a task holds four parts at most
        sent = docs.sparkSession.sparkContext.broadcast(part)

        def run(batches, sent=sent, first=first) -> Iterator[pa.RecordBatch]:
            for batch in chunks(batches, text):
                names = batch.schema.names
                best, top, rest, count = _part_scores(batch.column(names.index(text)), sent.value)
                best = [b if c else UNKNOWN for b, c in zip(best, count, strict=True)]
                kept = [c for n, c in zip(names, batch.columns, strict=True) if n not in (pred, *state)]
                kept_names = [n for n in names if n not in (pred, *state)]
                if not first:
                    old = [batch.column(names.index(n)) for n in (pred, *state)]
                    before, weight = np.asarray(old[1]), np.asarray(old[2])
                    high = np.maximum(before, top)
                    rest = weight * np.exp(before - high) + rest * np.exp(top - high)
                    best = [o if b >= t else n for o, b, t, n in zip(old[0].to_pylist(), before, top, best, strict=True)]
                    top = high
                yield pa.RecordBatch.from_arrays([*kept, pa.array(best, pa.string()), pa.array(top), pa.array(rest)],
                                                 names=[*kept_names, pred, *state])

        schema = StructType([*docs.schema.fields, StructField(pred, StringType()), *[StructField(c, DoubleType()) for c in state]])
        rows, first = rows.mapInArrow(run, schema), False
    return rows.withColumn(score, F.when(F.col(pred) == UNKNOWN, 0.0).otherwise(1 / F.col(state[1]))).drop(*state)


def predicted(docs: DataFrame, learn: DataFrame, p: LangId = LangId(), *, text: str = "text",
              out: tuple[str, str] = ("_lang_pred", "_lang_score")) -> DataFrame:
    """``docs`` with the likeliest language and its posterior probability behind its columns, learned from ``learn``.

    A text that is null, empty or without a letter is ``und`` with score 0, and
    so is every text if no document had a language to learn from. On a tie the
    first language by name counts. Texts of any length are scored whole;
    repeated rows count each.
    """
    seen, names, prior = _learn(learn, p)
    small_batches(docs.sparkSession)
    if len(names) > p.dense:
        return _predict_parts(docs, _parts(materialise(seen, "language-counts"), names, prior, p), text, out)
    sent = docs.sparkSession.sparkContext.broadcast(_dense(seen, names, prior, p))

    def run(batches) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches, text):
            pred, score = score_texts(batch.column(batch.schema.get_field_index(text)), sent.value)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(pred, pa.string()), pa.array(score)],
                                             names=[*batch.schema.names, *out])

    return _added(docs, run, StructField(out[0], StringType()), StructField(out[1], DoubleType()))


def identify(docs: DataFrame, p: LangId = LangId()) -> DataFrame:
    """``doc_id, held_out, lang_pred, score`` of every row; learned from rows that are not held out."""
    slim = docs.select("doc_id", "text", "lang", held_out(F.col("doc_id")).alias("held_out"))
    scored = predicted(slim.select("doc_id", "held_out", "text"), slim.where("NOT held_out"), p)
    return scored.select("doc_id", "held_out", F.col("_lang_pred").alias("lang_pred"), F.col("_lang_score").alias("score"))


def keep_identified(docs: DataFrame, p: LangId = LangId()) -> DataFrame:
    """``docs`` without the rows whose language is unknown or too uncertain; columns of any name stay as they are."""
    out = unused(docs, "lang_pred"), unused(docs, "lang_score")
    scored = predicted(docs, docs.select("doc_id", "text", "lang").where(~held_out(F.col("doc_id"))), p, out=out)
    return scored.where((F.col(out[0]) != UNKNOWN) & (F.col(out[1]) >= p.min_score)).select(*docs.columns)


def unused(docs: DataFrame, name: str) -> str:
    """A name that no column begins with, however its letters are written."""
    while any(c.lower().startswith(name) for c in docs.columns):
        name = "_" + name
    return name
