"""Benchmark passages in documents, found through an FM-index of each shard of documents.

A shard is a few megabytes of texts inside a task. Its words become symbols;
a word that no benchmark item contains ends a run, and runs shorter than the
shortest window cannot hold one and are left out. The index of the remaining
runs is searched backwards for all windows at once, occurrences are located
and merged into spans. Benchmark items reach the executors in blocks of
bounded size, with one pass over the documents per block.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType, StringType, StructField, StructType

from corpusmill.llm.batches import small_batches
from corpusmill.llm.fmindex import FmIndex
from corpusmill.llm.wordcodes import ALNUM, chunks, words
from corpusmill.runtime import materialise


@dataclass(frozen=True)
class Decontaminate:
    """``window`` words; contaminated from ``1 / part`` hit words on; ``block_chars`` of items per pass."""

    window: int = 13
    part: int = 20
    sample: int = 8
    block_chars: int = 8_000_000


@dataclass(frozen=True)
class Windows:
    """Vocabulary codes in order, distinct windows aligned to the right, and the items of each."""

    vocabulary: np.ndarray
    patterns: np.ndarray
    length: np.ndarray
    owner: np.ndarray
    item: np.ndarray
    names: list[str | None]


def windows(texts: list[str | None], names: list[str | None], size: int) -> Windows:
    w = words(pa.array(texts, pa.large_string()), ALNUM)
    vocabulary = np.unique(w.code)
    symbol = np.searchsorted(vocabulary, w.code) + 1
    rows, lengths, items = [], [], []
    for i in range(len(texts)):
        own = symbol[w.bounds[i]:w.bounds[i + 1]]
        if len(own) >= size:
            rows.append(np.lib.stride_tricks.sliding_window_view(own, size))
        elif len(own):
            rows.append(np.concatenate([np.zeros(size - len(own), np.int64), own])[None])
        else:
            continue
        lengths += [min(len(own), size)] * len(rows[-1])
        items += [i] * len(rows[-1])
    if not rows:
        return Windows(vocabulary, np.zeros((0, size), np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64),
                       np.zeros(0, np.int64), names)
    patterns, owner = np.unique(np.concatenate(rows), axis=0, return_inverse=True)
    order = np.argsort(owner, kind="stable")
    return Windows(vocabulary, patterns, (patterns > 0).sum(axis=1), owner[order], np.array(items)[order], names)


def find(column: pa.Array, b: Windows, sample: int) -> tuple:
    """Words of the texts, which of them are hit, and the distinct (text, item) pairs."""
    w = words(column, ALNUM)
    n = len(w.code)
    hit, none = np.zeros(n, dtype=bool), (np.zeros(0, np.int64), np.zeros(0, np.int64))
    if not n or not len(b.patterns):
        return w, hit, none
    at = np.minimum(np.searchsorted(b.vocabulary, w.code), len(b.vocabulary) - 1)
    symbol = np.where(b.vocabulary[at] == w.code, at + 1, 0)
    # Runs of known words inside a text; a break also where the next text begins.
    opens = np.zeros(n + 1, dtype=bool)
    opens[w.bounds] = True
    run = np.cumsum(opens[:n] | (symbol == 0) | np.concatenate([[True], symbol[:-1] == 0])) - 1
    size = np.bincount(run[symbol > 0], minlength=run[-1] + 1)
    keep = (symbol > 0) & (size[run] >= b.length.min())
    where = np.flatnonzero(keep)
    if not len(where):
        return w, hit, none
    breaks = np.concatenate([[0], np.cumsum(run[where][1:] != run[where][:-1])])
    text = np.zeros(len(where) + breaks[-1] + 1, dtype=np.int64)
    place = np.arange(len(where)) + breaks
    text[place] = symbol[where]
    word = np.zeros(len(text), dtype=np.int64)
    word[place] = where
    index = FmIndex(text, len(b.vocabulary), sample)
    low, high = index.search(b.patterns, b.length)
    found = np.flatnonzero(high > low)
    count = (high - low)[found]
    row = np.repeat(low[found], count) + np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
    pattern = np.repeat(found, count)
    start = word[index.locate(row)]
    cover = np.zeros(n + 1, dtype=np.int64)
    np.add.at(cover, start, 1)
    np.add.at(cover, start + b.length[pattern], -1)
    hit = np.cumsum(cover[:n]) > 0
    text_of = np.searchsorted(w.bounds, start, side="right") - 1
    pairs = np.unique(np.stack([text_of, pattern], axis=1), axis=0)
    first, last = np.searchsorted(b.owner, pairs[:, 1]), np.searchsorted(b.owner, pairs[:, 1], side="right")
    each = last - first
    item = b.item[np.repeat(first, each) + np.arange(each.sum()) - np.repeat(np.cumsum(each) - each, each)]
    both = np.unique(np.stack([np.repeat(pairs[:, 0], each), item], axis=1), axis=0) if len(pairs) else np.zeros((0, 2), int)
    return w, hit, (both[:, 0], both[:, 1])


def spans(w, hit: np.ndarray) -> list[list[dict] | None]:
    """Per text the hit stretches, from the first to behind the last code point; None without hits."""
    out: list[list[dict] | None] = [None] * (len(w.bounds) - 1)
    if not hit.any():
        return out
    text = w.owner()
    joined = hit[1:] & hit[:-1] & (text[1:] == text[:-1])
    first = np.flatnonzero(hit & ~np.concatenate([[False], joined]))
    last = np.flatnonzero(hit & ~np.concatenate([joined, [False]]))
    points = np.concatenate([[0], np.cumsum((w.data & 0xC0) != 0x80)])
    for a, b in zip(first, last, strict=True):
        t = text[a]
        zero = points[w.text_start[t]]
        out[t] = (out[t] or []) + [{"start": int(points[w.start[a]] - zero), "end": int(points[w.end[b]] - zero)}]
    return out


def mark(docs: DataFrame, benchmark: DataFrame, p: Decontaminate = Decontaminate()) -> DataFrame:
    """``docs`` with ``_n_words``, ``_n_hit``, ``_items`` (sorted ids) and ``_spans`` (code points) behind its columns.

    Null texts, of documents or items, have no words. An item without an id
    hits words but is not named; repeated items are one. An empty benchmark
    hits nothing, an empty table gives no rows.
    """
    small_batches(docs.sparkSession)
    total = benchmark.agg(F.coalesce(F.sum(F.length("text")), F.lit(0))).first()[0]
    blocks = max(1, -(-int(total) // p.block_chars))
    fields = [StructField("_n_words", LongType()), StructField("_hits", ArrayType(LongType())),
              StructField("_items", ArrayType(StringType())), StructField("_spans", ArrayType(
                  StructType([StructField("start", LongType()), StructField("end", LongType())])))]
    names = docs.columns
    schema = StructType([*docs.schema.fields, *fields])
    items = benchmark.select(F.col("item_id").cast("string").alias("name"), "text")
    for block in range(blocks):
        own = items.where(F.pmod(F.xxhash64("name", "text"), F.lit(blocks)) == block).distinct().toPandas()
        sent = docs.sparkSession.sparkContext.broadcast(
            windows(own["text"].tolist(), [x if isinstance(x, str) else None for x in own["name"]], p.window))
        docs = docs.mapInArrow(_marker(sent, len(names), schema, p), schema)
        if blocks > 1:
            docs = materialise(docs, "marked")
    return docs.select(*names, "_n_words", F.size("_hits").cast("long").alias("_n_hit"), "_items", "_spans")


def _marker(sent, own: int, schema: StructType, p: Decontaminate):
    def run(batches) -> Iterator[pa.RecordBatch]:
        b = sent.value
        for batch in chunks(batches, "text"):
            column = batch.column(batch.schema.get_field_index("text"))
            w, hit, (text, item) = find(column, b, p.sample)
            n = batch.num_rows
            found: list[set[str]] = [set() for _ in range(n)]
            for t, i in zip(text, item, strict=True):
                if b.names[i] is not None:
                    found[t].add(b.names[i])
            if batch.num_columns > own:  # what earlier blocks of the benchmark have hit
                for t, (places, named) in enumerate(zip(batch.column(own + 1).to_pylist(),
                                                        batch.column(own + 2).to_pylist(), strict=True)):
                    hit[w.bounds[t] + np.array(places, dtype=np.int64)] = True
                    found[t].update(named)
            places = np.flatnonzero(hit)
            cut = np.searchsorted(places, w.bounds)
            base = np.repeat(w.bounds[:-1], np.diff(cut))
            yield pa.RecordBatch.from_arrays([
                *batch.columns[:own], pa.array(w.counts),
                pa.ListArray.from_arrays(pa.array(cut, pa.int32()), pa.array(places - base)),
                pa.array([sorted(x) for x in found], pa.list_(pa.string())),
                pa.array([x or [] for x in spans(w, hit)],
                         pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))),
            ], names=schema.names)
    return run


def contaminated(p: Decontaminate = Decontaminate()):
    return (F.col("_n_hit") > 0) & (p.part * F.col("_n_hit") >= F.col("_n_words"))


def report(docs: DataFrame, benchmark: DataFrame, p: Decontaminate = Decontaminate()) -> DataFrame:
    """Hit words and items of every document, and whether it is contaminated."""
    marked = mark(docs.select(F.col("doc_id").alias("doc_id"), "text"), benchmark, p)
    return marked.select(
        "doc_id", F.col("_n_words").alias("n_words"), F.col("_n_hit").alias("n_hit"),
        F.size("_items").cast("long").alias("n_items"), F.sha2(F.array_join("_items", ","), 256).alias("items_sha256"),
        contaminated(p).alias("contaminated"), F.col("_spans").alias("spans"))


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, p: Decontaminate = Decontaminate()) -> DataFrame:
    """``docs`` without contaminated rows, all columns kept."""
    return mark(docs, benchmark, p).where(~contaminated(p)).select(*docs.columns)
