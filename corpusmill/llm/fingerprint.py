"""Document fingerprints: threshold-scaled sketches of shingles.

A sketch keeps every shingle hash below a fixed fraction of the hash range, so
its size follows the text's and sketches of very unequal texts can be held
against each other. A short text with few such hashes keeps its smallest ones
up to a fixed number. Up to some bound a sketch thus has all of a text's hashes,
and two sketches are compared up to the lower of their bounds. The sketch of
two texts' shingles together comes from the union of their sketches.
"""

from __future__ import annotations

from base64 import b64encode
from collections.abc import Iterator
from dataclasses import dataclass
from math import isqrt

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from corpusmill.llm.batches import small_batches
from corpusmill.llm.wordcodes import chunks, distinct, shingles, words


@dataclass(frozen=True)
class Sketch:
    """Hashes below ``2**64 / scale`` are kept, and the ``least`` smallest."""

    shingle: int = 5
    scale: int = 8
    least: int = 64


RESULT = ("doc_id long, n_chars long, edited_sha256 string, fingerprint binary, edited_fingerprint binary, "
          "near_edited double, near_next double, contained_edited double, contained_next double")
#: Keys of the sample that split points are taken from, at most about so many.
SPLIT_SAMPLE = 100_000
RESULT_NAMES = [c.split()[0] for c in RESULT.split(", ")]


def _limit(p: Sketch) -> np.uint64:
    return np.uint64((1 << 64) // p.scale - 1)


def sketches(texts: list[str], p: Sketch) -> list[np.ndarray]:
    """The kept hashes of each text in ascending order; none for a text without words."""
    codes, bounds = distinct(*shingles(words(pa.array(texts, pa.large_string())), p.shingle))
    return [_cut(codes[a:b], p) for a, b in zip(bounds[:-1], bounds[1:], strict=True)]


def _cut(codes: np.ndarray, p: Sketch) -> np.ndarray:
    return codes[:max(int(np.searchsorted(codes, _limit(p), side="right")), p.least)]


def merged(x: np.ndarray, y: np.ndarray, p: Sketch) -> np.ndarray:
    """The sketch of both texts' shingles together."""
    return _cut(np.union1d(x, y), p)


def _bound(sketch: np.ndarray, p: Sketch) -> int:
    """Up to here a sketch has every hash of its text."""
    if len(sketch) < p.least:
        return (1 << 64) - 1
    return max(int(_limit(p)), int(sketch[-1]))


def likeness(x: np.ndarray, y: np.ndarray, p: Sketch) -> tuple[float, float]:
    """Estimated shared part of the union, and of ``x``. Two texts without words are alike."""
    if not len(x) or not len(y):
        same = float(len(x) == len(y))
        return same, same
    bound = np.uint64(min(_bound(x, p), _bound(y, p)))
    x, y = x[:np.searchsorted(x, bound, side="right")], y[:np.searchsorted(y, bound, side="right")]
    both = len(np.intersect1d(x, y, assume_unique=True))
    return both / max(1, len(x) + len(y) - both), both / max(1, len(x))


def packed(sketch: np.ndarray) -> bytes:
    """The hashes, 8 bytes each from the highest."""
    return sketch.astype(">u8").tobytes()


def written(sketch: np.ndarray) -> str:
    """The packed hashes in base 64, as results show them."""
    return b64encode(packed(sketch)).decode()


def edited(text: str, following: str) -> str:
    cut = len(text) // 3
    return text[:len(text) - cut] + following[:cut]


def _rows(ids: list, texts: list[str], following: list[str], p: Sketch) -> pa.RecordBatch:
    """Results of texts, each held against the one that follows it."""
    from hashlib import sha256

    changed = [edited(a, b) for a, b in zip(texts, following, strict=True)]
    n = len(texts)
    chained = texts[1:] == following[:-1]  # each following text is the next row's own, but for the last
    all_ = sketches(texts + (following[-1:] if chained else following) + changed, p)
    own, last = all_[:n], all_[n:-n]
    after = own[1:] + last if chained else last
    new = all_[-n:]
    pairs = [likeness(a, b, p) for a, b in zip(own, new, strict=True)]
    others = [likeness(a, b, p) for a, b in zip(own, after, strict=True)]
    return pa.RecordBatch.from_arrays([
        pa.array(ids, pa.int64()), pa.array([len(t) for t in texts], pa.int64()),
        pa.array([sha256(t.encode()).hexdigest() for t in changed], pa.string()),
        pa.array(list(map(packed, own)), pa.binary()), pa.array(list(map(packed, new)), pa.binary()), *(pa.array([x[k] for x in y], pa.float64())
                                             for k, y in ((0, pairs), (0, others), (1, pairs), (1, others)))],
        names=RESULT_NAMES)


def _key(doc_id, text):
    """A string that ascends as ids descend (null last), and among equal ids by a hash of the text."""
    def digits(number):
        return F.lpad(F.hex(number.bitwiseXOR(F.lit(-(1 << 63)).cast("long"))), 16, "0")
    return F.concat(F.coalesce(digits(F.bitwise_not(doc_id)), F.lit("g" * 16)), digits(F.xxhash64(text)))


def _splits(keys: DataFrame, ranges: int) -> list[str]:
    """At most ``ranges - 1`` keys that cut the table into about equal ranges, from a bounded sample chosen by hash."""
    wanted = min(64 * ranges, SPLIT_SAMPLE)
    share = min(1.0, wanted / max(1, keys.count()))
    drawn = keys.where(F.pmod(F.xxhash64("key", F.lit(1)), F.lit(1 << 30)) < int(share * (1 << 30))).distinct().collect()
    drawn = sorted(r["key"] for r in drawn)
    return sorted({drawn[i * len(drawn) // ranges] for i in range(1, ranges)}) if drawn else []


def _range_of(key, splits: list[str]):
    """How many of ``splits`` are at most ``key``: first among every so manieth, then among those up to the next."""
    if not splits:
        return F.lit(0)
    step = isqrt(len(splits)) + 1
    passed = F.lit(0)
    if splits[step - 1::step]:
        passed = F.size(F.filter(F.lit(splits[step - 1::step]), lambda x: x <= key)) * step
    return passed + F.size(F.filter(F.slice(F.lit(splits), passed + 1, F.lit(step)), lambda x: x <= key))


def fingerprints(docs: DataFrame, p: Sketch = Sketch()) -> DataFrame:
    """Sketch of every text and of its edited text, and their likeness to each other and the next document's.

    Documents follow one another by descending doc_id (null ids last; equal ids
    by text), and after the last comes the first. They are dealt out by ranges
    of ids between split points that are fixed before, and each range is walked
    in order. The last row of a range meets the first of the next one by their
    keys, which are known from an aggregation, so nothing depends on ranges being
    the same in two plans. Null texts are empty; their sketch is the empty string.
    A single row follows itself, and repeated rows follow one another. A very
    long text is worked on alone. An empty table gives no rows.
    """
    small_batches(docs.sparkSession)
    n = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text"), F.lit("")).alias("text"))
    rows = rows.withColumn("key", _key(F.col("doc_id"), F.col("text")))
    rows = rows.withColumn("part", _range_of(F.col("key"), _splits(rows.select("key"), n)))
    dealt = rows.repartitionById(n, F.col("part")).sortWithinPartitions("key", "text").select("doc_id", "part", "text")

    def walk(batches) -> Iterator[pa.RecordBatch]:
        ids, parts, texts = [], [], []
        for batch in chunks(batches, "text"):
            ids, parts, texts = (x + batch.column(i).to_pylist() for i, x in enumerate((ids, parts, texts)))
            cut = [i for i in range(1, len(parts)) if parts[i] != parts[i - 1]]
            for a, b in zip([0, *cut], [*cut, len(parts)], strict=True):
                if b - a > 1:
                    yield _rows(ids[a:b - 1], texts[a:b - 1], texts[a + 1:b], p)
            ids, parts, texts = ids[-1:], parts[-1:], texts[-1:]

    # Two keys per range, one range per shuffle partition: so many rows go through one window and a broadcast.
    ends = rows.groupBy("part").agg(F.min("key").alias("head"), F.max("key").alias("tail"))
    w = Window.orderBy("part")
    ends = ends.select("head", "tail", F.coalesce(F.lead("head").over(w), F.min("head").over(
        w.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))).alias("after"))
    meeting = ends.select(F.explode(F.array(
        F.struct(F.col("tail").alias("key"), F.col("after").alias("meet"), F.lit(True).alias("before")),
        F.struct(F.col("head").alias("key"), F.col("head").alias("meet"), F.lit(False).alias("before")))).alias("e")).select("e.*")
    met = rows.select("key", "doc_id", "text").join(F.broadcast(meeting), "key").groupBy("meet").agg(
        F.first(F.when(F.col("before"), F.struct("doc_id", "text")), ignorenulls=True).alias("row"),
        F.first(F.when(~F.col("before"), F.col("text")), ignorenulls=True).alias("following"))

    def close(batches) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches, "text"):
            ids, texts, following = (batch.column(i).to_pylist() for i in range(3))
            for i, t, f in zip(ids, texts, following, strict=True):
                yield _rows([i], [t], [f], p)

    closed = met.select("row.doc_id", "row.text", "following").mapInArrow(close, RESULT)
    return dealt.mapInArrow(walk, RESULT).union(closed).withColumns(
        {c: F.base64(c) for c in ("fingerprint", "edited_fingerprint")})
