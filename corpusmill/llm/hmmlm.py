"""Hidden Markov language model: exact word counts, Baum-Welch over all training texts, exact likelihoods.

Words are counted over all training texts. Those with at least a fixed share
of the tokens are symbols of the model; there can be no more of them than the
share allows, so they fit in a broadcast whatever the corpus. Any other word,
known or not, is met as one of a fixed number of classes by its last letters,
times its share of that class, so that the model gives a probability to every
text. The counts of such words never leave the cluster: each block of texts
asks every part of the vocabulary for its words, in packed rows, and gets one
sum per text back.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusmill.llm.batches import small_batches
from corpusmill.llm.hmm import COUNT, Hmm, cluster_sums, counts_of, expected_sums, log10_forward, maximise, mixture, sticky
from corpusmill.llm.langid import held_out
from corpusmill.llm.wordcodes import Words, chunks, words
from corpusmill.runtime import LONG_ROWS, materialise

SYMBOLS = 1 << 19  # about so many are learned from together; forward-backward holds some 150 bytes for each
LONG = 1024  # texts with more symbols are taken together with each other, or the few of a batch would add steps to all


@dataclass(frozen=True)
class HmmLm:
    """``share`` bounds the words with emissions of their own to ``1 / share``.

    Rounds end when one gains less than ``settled`` in log10 likelihood per
    token, or after ``iterations`` if given. ``clusterings`` passes place the start.
    """

    states: int = 8
    share: float = 1 / 50_000
    classes: int = 2048
    iterations: int | None = None
    settled: float = 0.002
    clusterings: int = 5
    strength: float = 50.0
    held: int = 1
    folds: int = 5
    part_words: int = 1_000_000
    part_tokens: int = 8_000_000
    merge_words: int = 250_000


@dataclass(frozen=True)
class Vocabulary:
    """Symbols: 0 the end of a text, then the frequent words, then the classes."""

    tokens: int
    kinds: int
    codes: np.ndarray
    counts: np.ndarray
    class_mass: np.ndarray
    parts: int

    @property
    def size(self) -> int:
        return 1 + len(self.codes) + len(self.class_mass)

    def plain(self) -> np.ndarray:
        """The unigram distribution over symbols."""
        mass = np.concatenate([self.counts + 0.5, self.class_mass])
        return mass / mass.sum()


def word_class(w: Words, classes: int) -> np.ndarray:
    """A class per word from its last three bytes."""
    out = np.zeros(len(w.start), dtype=np.int64)
    for back in (1, 2, 3):
        at = w.end - back
        out = out * 256 + np.where(at >= w.start, w.data[np.maximum(at, 0)], 0)
    return (out * 2654435761 % (1 << 32)) * classes >> 32


def count_words(texts: DataFrame, p: HmmLm) -> DataFrame:
    """``code, cls, n`` of every distinct word."""
    def run(batches) -> Iterator[pa.RecordBatch]:
        def rows(code, cls, n):
            return pa.RecordBatch.from_arrays([pa.array(code.view(np.int64)), pa.array(cls.astype(np.int32)),
                                               pa.array(n.astype(np.int64))], names=["code", "cls", "n"])

        def merged(parts):
            code, where = np.unique(np.concatenate([x[0] for x in parts]), return_inverse=True)
            cls = np.zeros(len(code), dtype=np.int64)
            cls[where] = np.concatenate([x[1] for x in parts])
            return code, cls, np.bincount(where, weights=np.concatenate([x[2] for x in parts]), minlength=len(code))

        held, size = [], 0
        for batch in chunks(batches, "text"):
            w = words(batch.column(0))
            code, at, n = np.unique(w.code, return_index=True, return_counts=True)
            held.append((code, word_class(w, p.classes)[at], n))
            size += len(code)
            if size > 2 * p.merge_words:
                held = [merged(held)]
                size = len(held[0][0])
                if size > p.merge_words:
                    yield rows(*held[0])
                    held, size = [], 0
        if held:
            yield rows(*merged(held))

    return texts.select("text").mapInArrow(run, "code long, cls int, n long").groupBy("code", "cls").agg(
        F.sum("n").alias("n"))


def vocabulary(counts: DataFrame, texts: int, p: HmmLm) -> Vocabulary:
    spark = counts.sparkSession
    total = counts.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"), F.count("*").alias("v")).first()
    tokens = total["n"] + texts
    frequent = F.col("n") >= max(1, p.share * tokens)
    top = counts.where(frequent).select("code", "n").toPandas().sort_values("code")
    mass = counts.where(~frequent).groupBy("cls").agg(F.sum("n").alias("n"), F.count("*").alias("v")).toPandas()
    class_mass = np.full(p.classes, 0.5)
    class_mass[mass["cls"].to_numpy(dtype=int)] += mass["n"].to_numpy(float) + 0.5 * mass["v"].to_numpy(float)
    order = np.argsort(top["code"].to_numpy(np.int64).view(np.uint64))
    rare = int(mass["n"].sum()) if len(mass) else 0
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-int(mass["v"].sum()) // p.part_words),
                -(-rare // p.part_tokens))
    return Vocabulary(tokens, total["v"] + (texts > 0), top["code"].to_numpy(np.int64).view(np.uint64)[order],
                      np.concatenate([[texts], top["n"].to_numpy(float)[order]]), class_mass, parts)


def encode(docs: DataFrame, v: Vocabulary, p: HmmLm) -> DataFrame:
    """Blocks of texts as packed rows, written: symbols under part -1, the codes of other words under their parts.

    Each kind has its own columns, so that the rounds of learning do not read the codes.
    """
    sent = docs.sparkSession.sparkContext.broadcast(v)

    def run(batches) -> Iterator[pa.RecordBatch]:
        v, block = sent.value, TaskContext.get().partitionId() << 32
        for batch in chunks(batches, "text"):
            w = words(batch.column(2))
            n, block = batch.num_rows, block + 1
            at = np.minimum(np.searchsorted(v.codes, w.code), max(0, len(v.codes) - 1))
            own = v.codes[at] == w.code if len(v.codes) else np.zeros(len(w.code), bool)
            symbol = np.where(own, 1 + at, 1 + len(v.codes) + word_class(w, len(v.class_mass))).astype(np.uint16)
            bounds = w.bounds + np.arange(n + 1)
            sequence = np.zeros(bounds[-1], dtype=np.uint16)
            sequence[np.arange(len(symbol)) + w.owner()] = symbol
            rare, text = w.code[~own], w.owner()[~own].astype(np.uint16 if n < 1 << 16 else np.uint32)
            part = np.mod(rare.view(np.int64), v.parts)
            order = np.argsort(part, kind="stable")
            rare, text, part = rare[order], text[order], part[order]
            cut = np.flatnonzero(np.diff(part, prepend=-1))
            ends = [*cut[1:], len(part)] if len(cut) else []
            yield pa.RecordBatch.from_arrays([
                pa.array([block] * (1 + len(cut)), pa.int64()), pa.array([-1, *map(int, part[cut])], pa.int32()),
                pa.array([batch.column(0).to_pylist(), *[None] * len(cut)], pa.list_(pa.int64())),
                pa.array([batch.column(1).to_pylist(), *[None] * len(cut)], pa.list_(pa.bool_())),
                pa.array([sequence.tobytes(), *[None] * len(cut)], pa.binary()),
                pa.array([bounds.astype(np.int64).tobytes(), *[None] * len(cut)], pa.binary()),
                pa.array([None, *(rare[a:b].tobytes() for a, b in zip(cut, ends, strict=True))], pa.binary()),
                pa.array([None, *(text[a:b].tobytes() for a, b in zip(cut, ends, strict=True))], pa.binary()),
            ], names=["block", "part", "doc_id", "held", "what", "whose", "codes", "owners"])

    schema = ("block long, part int, doc_id array<long>, held array<boolean>, what binary, whose binary, "
              "codes binary, owners binary")
    return materialise(docs.select("doc_id", "held_out", "text").mapInArrow(run, schema), "encoded", LONG_ROWS)


def _sequences(row) -> tuple[np.ndarray, np.ndarray]:
    return (np.frombuffer(row["what"].as_py(), np.uint16).astype(np.int64),
            np.frombuffer(row["whose"].as_py(), np.int64))


def _learning(batches) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Symbols and bounds of texts that are not held out, of several blocks together, short and long ones apart."""
    parts, lengths, size = ([], []), ([], []), [0, 0]

    def taken(kind):
        out = np.concatenate(parts[kind]).astype(np.int64), np.concatenate([[0], np.cumsum(np.concatenate(lengths[kind]))])
        parts[kind].clear()
        lengths[kind].clear()
        size[kind] = 0
        return out

    for batch in batches:
        for i in range(batch.num_rows):
            row = {name: batch.column(k)[i] for k, name in enumerate(batch.schema.names)}
            symbols = np.frombuffer(row["what"].as_py(), np.uint16)
            length = np.diff(np.frombuffer(row["whose"].as_py(), np.int64))
            learn = ~np.array(row["held"].as_py(), dtype=bool)
            for kind, keep in enumerate((learn & (length <= LONG), learn & (length > LONG))):
                parts[kind].append(symbols[np.repeat(keep, length)])
                lengths[kind].append(length[keep])
                size[kind] += len(parts[kind][-1])
                if size[kind] >= SYMBOLS:
                    yield taken(kind)
    for kind in (0, 1):
        if size[kind]:
            yield taken(kind)


def _summed(blocks: DataFrame, work, rows: int, states: int) -> np.ndarray:
    """Sum over all blocks of the whole numbers (``rows`` x ``states``) that ``work(symbols, bounds)`` gives."""
    names = [f"s{i}" for i in range(states)]

    def gather(batches) -> Iterator[pa.RecordBatch]:
        sums = None
        for symbols, bounds in _learning(batches):
            sums = work(symbols, bounds) + (0 if sums is None else sums)
        if sums is not None:
            key = np.flatnonzero(sums.any(axis=1))
            yield pa.RecordBatch.from_arrays([pa.array(key.astype(np.int32)), *map(pa.array, sums[key].astype(float).T)],
                                             names=["key", *names])

    got = blocks.mapInArrow(gather, "key int, " + ", ".join(f"{c} double" for c in names)).groupBy("key").agg(
        *(F.sum(c).alias(c) for c in names)).toPandas()
    out = np.zeros((rows, states))
    out[got["key"].to_numpy(int)] = got[names].to_numpy(float)
    return out


def first_texts(blocks: DataFrame, size: int, p: HmmLm) -> np.ndarray:
    """Symbol shares of as many different texts as there are states, chosen by a hash of their symbols."""
    def run(batches) -> Iterator[pa.RecordBatch]:
        least: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        for symbols, bounds in _learning(batches):
            for a, b in zip(bounds[:-1], bounds[1:], strict=True):
                text = symbols[a:b]
                # Texts of some length first.
                place = int.from_bytes(blake2b(text.tobytes(), digest_size=8).digest()) >> 2 | (int(b - a < 20) << 62)
                if len(least) < p.states or place < max(least):
                    least[place] = np.unique(text, return_counts=True)
                    if len(least) > p.states:
                        del least[max(least)]
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(least), pa.int64()), pa.array([s.tolist() for s, _ in least.values()], pa.list_(pa.int32())),
             pa.array([n.tolist() for _, n in least.values()], pa.list_(pa.int32()))], names=["place", "s", "n"])

    found = blocks.mapInArrow(run, "place long, s array<int>, n array<int>").dropDuplicates(["place"]).orderBy(
        "place").limit(p.states).collect()
    out = np.zeros((size, p.states))
    for k in range(p.states if found else 0):
        r = found[k % len(found)]
        out[r["s"], k] = np.array(r["n"]) / sum(r["n"])
    return out


def baum_welch(encoded: DataFrame, texts: int, v: Vocabulary, p: HmmLm) -> Hmm:
    """Fit to all texts that are not held out, each whole; the start comes from clusters of all of them."""
    plain, size, states = v.plain(), v.size, p.states
    blocks = encoded.where("part = -1").select("held", "what", "whose")
    sc = encoded.sparkSession.sparkContext
    if not texts:
        return sticky(np.tile(plain[:, None], (1, states)))
    emit = 0.5 * plain[:, None] + 0.5 * first_texts(blocks, size, p)
    for _ in range(p.clusterings if states > 1 else 0):
        sent = sc.broadcast(emit)
        emit = mixture(_summed(blocks, lambda s, b, sent=sent: cluster_sums(sent.value, s, b), size, states) / COUNT, plain)
        sent.unpersist()
    model, before = sticky(emit), -np.inf
    rounds = 0
    while p.iterations is None or rounds < p.iterations:
        sent = sc.broadcast(model)
        sums = _summed(blocks, lambda s, b, sent=sent: expected_sums(sent.value, s, b), 2 + 2 * states + size, states)
        *counts, log = counts_of(model, sums)
        model = maximise(*counts, plain, p.strength)
        sent.unpersist()
        rounds += 1
        if log - before < p.settled * v.tokens:
            break
        before = log
    return model


def rare_sums(encoded: DataFrame, counts: DataFrame, v: Vocabulary, p: HmmLm) -> DataFrame:
    """Per block and part of the vocabulary: sums of log10(c + 0.5) and known words, by text."""
    asked = encoded.where("part >= 0").select("part", "block", "codes", "owners")
    known = counts.where(F.col("n") < max(1, p.share * v.tokens)).select(
        F.pmod("code", F.lit(v.parts)).cast("int").alias("part"), "code", "n")
    schema = "block long, part int, text binary, total binary, known binary"

    def look_up(asked: pa.Table, known: pa.Table) -> pa.Table:
        code = np.asarray(known.column("code").combine_chunks()).astype(np.int64) if known.num_rows else np.zeros(0, np.int64)
        n = np.asarray(known.column("n").combine_chunks()).astype(np.float64) if known.num_rows else np.zeros(0)
        order = np.argsort(code)
        code, n = np.append(code[order], 0), np.append(n[order], 0.0)
        out = [[], [], [], [], []]
        for row in asked.to_pylist() if asked.num_rows else []:
            want = np.frombuffer(row["codes"], np.int64)
            text = np.frombuffer(row["owners"], np.uint16 if len(row["owners"]) == 2 * len(want) else np.uint32)
            at = np.searchsorted(code[:-1], want)
            c = np.where(code[at] == want, n[at], 0.0) if len(code) > 1 else np.zeros(len(want))
            c[at == len(code) - 1] = 0.0
            first = np.flatnonzero(np.diff(text.astype(np.int64), prepend=-1))
            out[0].append(row["block"])
            out[1].append(row["part"])
            out[2].append(text[first].astype(np.int32).tobytes())
            out[3].append(np.add.reduceat(np.log10(c + 0.5), first).tobytes())
            out[4].append(np.add.reduceat(c > 0, first, dtype=np.int32).tobytes())
        return pa.table([pa.array(out[0], pa.int64()), pa.array(out[1], pa.int32()),
                         *(pa.array(x, pa.binary()) for x in out[2:])], names=["block", "part", "text", "total", "known"])

    return asked.groupBy("part").cogroup(known.groupBy("part")).applyInArrow(look_up, schema)


def score(docs: DataFrame, p: HmmLm = HmmLm()) -> DataFrame:
    """Base and model scores of every row of ``docs`` (doc_id, text; other columns are ignored).

    Learns from rows whose crc32(doc_id as text) mod ``folds`` is not ``held``;
    a null doc_id is not held out. A null text is empty: its one token is the
    end. Repeated rows are scored and counted each, and scores do not depend on
    how the table is partitioned. A very long text is one sequence. Without rows to
    learn from all words are unknown and the model is uniform over its symbols.
    """
    small_batches(docs.sparkSession)
    marked = docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                         held_out(F.col("doc_id"), p.folds, p.held).alias("held_out"), "text")
    learn = marked.where("NOT held_out")
    texts = learn.select("doc_id").count()
    counts = materialise(count_words(learn, p), "word-counts")
    v = vocabulary(counts, texts, p)
    encoded = encode(marked, v, p)
    model = baum_welch(encoded, texts, v, p)
    sent = docs.sparkSession.sparkContext.broadcast((v, model))
    schema = ("doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, "
              "score double")

    def finish(blocks: pa.Table, sums: pa.Table) -> pa.Table:
        v, m = sent.value
        heavy = np.log10(v.counts + 0.5)
        mass = np.log10(v.class_mass)
        symbols, bounds = _sequences({c: blocks.column(c)[0] for c in ("what", "whose")})
        n = len(bounds) - 1
        rare_log, rare_known = np.zeros(n), np.zeros(n, dtype=np.int64)
        for row in sorted(sums.to_pylist(), key=lambda r: r["part"]) if sums.num_rows else []:
            text = np.frombuffer(row["text"], np.int32)
            rare_log[text] += np.frombuffer(row["total"])
            rare_known[text] += np.frombuffer(row["known"], np.int32)
        own = symbols < len(heavy)
        words = np.diff(bounds)
        start = bounds[:-1]
        frequent = np.add.reduceat(np.where(own, heavy[np.minimum(symbols, len(heavy) - 1)], 0.0), start)
        known = np.add.reduceat((own & (v.counts[np.minimum(symbols, len(heavy) - 1)] > 0)).astype(np.int64), start)
        classes = np.add.reduceat(np.where(own, 0.0, mass[np.maximum(symbols - len(heavy), 0)]), start)
        base = frequent + rare_log - words * np.log10(v.tokens + 0.5 * (v.kinds + 1))
        return pa.table([
            blocks.column("doc_id")[0].values, blocks.column("held")[0].values, pa.array(words), pa.array(known + rare_known),
            pa.array(np.full(n, v.tokens)), pa.array(base),
            pa.array(log10_forward(m, symbols, bounds) + rare_log - classes)],
            names=["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"])

    blocks = encoded.where("part = -1").select("block", "doc_id", "held", "what", "whose")
    return blocks.groupBy("block").cogroup(rare_sums(encoded, counts, v, p).groupBy("block")).applyInArrow(finish, schema)
