"""Near-duplicates by b-bit MinHash, confirmed on full shingle sets.

Equal shingle sets become one class first. A class keeps the low bits of its
minima, packed in a few numbers, and one key per band of minima. Classes that
share a band key are candidates; the packed bits estimate their similarity,
corrected for chance agreement, and pairs that may reach the threshold are
confirmed on their full sets. A bucket's members are held against its smallest
member first. Only members that are still in different components afterwards
are held against each other, by longer signatures that these classes alone get,
and each pair in one of its common buckets only. So a large group of copies
costs a few links per copy, and a group of texts that are merely alike few
confirmations. At a similarity of 0.75 a link misses all 32 bands of 4 minima
with probability 5e-6, and falls below a cut of the estimates with 5e-6.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusmill.llm.batches import small_batches
from corpusmill.llm.components import components
from corpusmill.llm.wordcodes import chunks, distinct, mix, shingles, words
from corpusmill.runtime import materialise

HALF_MASK = 0x5555555555555555


@dataclass(frozen=True)
class NearDup:
    """``percent`` of the union that two sets must share; ``cut`` on the estimate, ``fine_cut`` on that of ``fine`` minima."""

    shingle: int = 5
    percent: int = 75
    bands: int = 32
    rows: int = 4
    cut: float = 0.5
    more: int = 2
    fine: int = 2048
    fine_cut: float = 0.7
    block: int = 1024
    seed: int = 1


def sketch_batches(p: NearDup):
    """Shingle-set size, digest, band keys, packed two-bit minima and packed text per row."""
    n = p.bands * p.rows

    def run(batches) -> Iterator[pa.RecordBatch]:
        from hashlib import blake2b

        for batch in chunks(batches, "text"):
            column = batch.column(batch.schema.get_field_index("text"))
            codes, bounds = distinct(*shingles(words(column), p.shingle))
            size, raw = np.diff(bounds), codes.view(np.uint8)
            digest = [blake2b(raw[8 * a:8 * b], digest_size=16).digest() if b > a else None
                      for a, b in zip(bounds[:-1], bounds[1:], strict=True)]
            some = np.flatnonzero(size)
            mixed = minima(codes, bounds[:-1][some], n, p.seed)
            packed = low_bits(mixed)
            key = np.zeros((len(some), p.bands), dtype=np.uint64)
            for r in range(p.rows):
                key = mix(key + mixed[:, r::p.rows][:, :p.bands])
            key = mix(key + np.arange(p.bands, dtype=np.uint64))
            yield pa.RecordBatch.from_arrays(
                [*(c for f, c in zip(batch.schema.names, batch.columns, strict=True) if f != "text"),
                 pa.array(size, pa.int64()), pa.array(digest, pa.binary()),
                 _spread(key, some, len(size)), _spread(packed, some, len(size)), pack(column)],
                names=[*(f for f in batch.schema.names if f != "text"), "n_shingles", "digest", "bands", "bits", "z"])
    return run


def minima(codes: np.ndarray, starts: np.ndarray, n: int, seed: int) -> np.ndarray:
    """``n`` minima of each set, set after set in ``codes``, their bits spread."""
    rng = np.random.default_rng(seed)
    times = rng.integers(0, 1 << 63, n, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    plus = rng.integers(0, 1 << 63, n, dtype=np.uint64)
    out = np.zeros((len(starts), n), dtype=np.uint64)
    if len(starts):
        for j in range(n):
            out[:, j] = np.minimum.reduceat(codes * times[j] + plus[j], starts)
    return mix(out)


def low_bits(mixed: np.ndarray) -> np.ndarray:
    """Two bits of every minimum, 32 in a number."""
    bits = (mixed & np.uint64(3)).reshape(len(mixed), mixed.shape[1] // 32, 32)
    return (bits << (np.arange(32, dtype=np.uint64) * np.uint64(2))).sum(axis=2, dtype=np.uint64)


def fine_batches(p: NearDup):
    """``(node, fine)``: a longer packed signature from the packed text."""
    def run(batches) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for i in range(0, whole.num_rows, 256):
                batch = whole.slice(i, 256)
                codes, bounds = distinct(*shingles(words(unpack(batch.column(1))), p.shingle))
                packed = low_bits(minima(codes, bounds[:-1], p.fine, p.seed + 1))
                yield pa.RecordBatch.from_arrays([batch.column(0), _spread(packed, np.arange(len(packed)), len(packed))],
                                                 names=["node", "fine"])
    return run


def _spread(rows: np.ndarray, at: np.ndarray, n: int) -> pa.Array:
    """Rows as lists of longs at their places, null elsewhere."""
    take = np.full(n, -1)
    take[at] = np.arange(len(at))
    lists = pa.ListArray.from_arrays(np.arange(0, rows.size + 1, rows.shape[1], dtype=np.int32),
                                     pa.array(rows.reshape(-1).view(np.int64)))
    return lists.take(pa.array(take, mask=take < 0))


def pack(column: pa.Array) -> pa.Array:
    """Each text compressed, its length in front."""
    codec = pa.Codec("zstd")
    packed = []
    for text in pc.fill_null(column, ""):
        data = text.as_buffer()
        packed.append(data.size.to_bytes(8, "little") + codec.compress(data, asbytes=True))
    return pa.array(packed, pa.large_binary()).cast(pa.binary())


def unpack(column: pa.Array) -> pa.Array:
    codec = pa.Codec("zstd")
    texts = []
    for z in column:
        data = z.as_py()
        texts.append(codec.decompress(data[8:], int.from_bytes(data[:8], "little"), asbytes=True))
    return pa.array(texts, pa.large_binary()).cast(pa.large_string())


def confirm_batches(p: NearDup):
    """Pairs ``(a, b)`` whose full sets overlap enough, from both packed texts."""
    def run(batches) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for i in range(0, whole.num_rows, 256):
                batch = whole.slice(i, 256)
                texts = pa.chunked_array([unpack(batch.column(2)), unpack(batch.column(3))]).combine_chunks()
                codes, bounds = distinct(*shingles(words(texts), p.shingle))
                n, keep = batch.num_rows, []
                for k in range(n):
                    x, y = codes[bounds[k]:bounds[k + 1]], codes[bounds[n + k]:bounds[n + k + 1]]
                    both = len(np.intersect1d(x, y, assume_unique=True))
                    keep.append(100 * both >= p.percent * (len(x) + len(y) - both))
                yield batch.select([0, 1]).filter(pa.array(keep, pa.bool_()))
    return run


def _differing(pairs: list[tuple[Column, Column]]) -> Column:
    """How many two-bit minima differ in pairs of packed numbers."""
    total = F.lit(0)
    for x, y in pairs:
        d = x.bitwiseXOR(y)
        total = total + F.bit_count(d.bitwiseOR(F.shiftright(d, 1)).bitwiseAND(F.lit(HALF_MASK)))
    return total


def _most_differing(n: int, cut: float) -> int:
    """The most differing minima at which the similarity can be estimated as ``cut``."""
    return int(n * 0.75 * (1 - cut) + 1e-9)


def estimate(x: str, y: str, n: int) -> Column:
    """Similarity from equal two-bit minima, without those equal by chance."""
    differ = _differing([(F.col(x)[i], F.col(y)[i]) for i in range(n // 32)])
    return (1 - differ / n - 0.25) / 0.75


def _short(key: Column) -> Column:
    """Half of a band key: enough to see whether a pair has met in an earlier bucket."""
    return F.pmod(key, F.lit((1 << 31) - 1)).cast("int")


def sketches(docs: DataFrame, p: NearDup) -> DataFrame:
    """One row per document, written: ``row`` (unique), doc_id, text_key and its sketch."""
    small_batches(docs.sparkSession)
    slim = docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                       F.sha2(F.coalesce(F.col("text"), F.lit("")), 256).alias("text_key"), "text")
    made = slim.mapInArrow(
        sketch_batches(p), "doc_id long, text_key string, n_shingles long, digest binary, bands array<long>, "
        "bits array<long>, z binary")
    return materialise(made.withColumn("row", F.monotonically_increasing_id()), "sketches")


def confirmed(pairs: DataFrame, texts: DataFrame, p: NearDup) -> DataFrame:
    left = texts.select(F.col("node").alias("a"), F.col("z").alias("za"))
    right = texts.select(F.col("node").alias("b"), F.col("z").alias("zb"))
    joined = pairs.select("a", "b").join(left, "a").join(right, "b")
    return joined.select("a", "b", "za", "zb").mapInArrow(confirm_batches(p), "a long, b long")


def near_duplicates(docs: DataFrame, p: NearDup = NearDup()) -> DataFrame:
    """``row, doc_id, text_key, n_shingles, component_id, kept, first`` of every row of ``docs``.

    Needs the columns doc_id and text; others are ignored. ``component_id`` is
    the smallest doc_id that links reach, ``kept`` says whether it is the row's
    own, ``first`` marks one row of each component (the lowest doc_id, then the
    first read). A null or empty text, or one without words, has no shingles
    and is its own component. A null doc_id counts as larger than any other;
    a component of such rows only has a null id, of which nothing is ``kept``
    but one row is ``first``. Repeated rows are one class. An empty table gives
    no rows.
    """
    s = sketches(docs, p)
    # One class per set; its node is the row that stands for it.
    classes = s.where("digest IS NOT NULL").groupBy("digest").agg(
        F.min("row").alias("node"), F.min("doc_id").alias("least"))
    classes = materialise(classes, "classes")
    parts = materialise(
        s.select(F.col("row").alias("node"), "bands", "bits").join(classes.select("node"), "node"), "parts")
    bits = parts.select("node", "bits")

    buckets = parts.select("node", F.explode("bands").alias("key"))
    centres = buckets.groupBy("key").agg(F.min("node").alias("centre"), F.count("*").alias("n")).where("n > 1")
    members = materialise(buckets.join(centres.select("key", "centre"), "key"), "members")
    texts = materialise(s.select(F.col("row").alias("node"), "z").join(
        members.select("node").distinct(), "node"), "texts")

    def near(pairs: DataFrame) -> DataFrame:
        return (pairs.join(bits.toDF("a", "xa"), "a").join(bits.toDF("b", "xb"), "b")
                .withColumn("likeness", estimate("xa", "xb", p.bands * p.rows)).where(F.col("likeness") >= p.cut)
                .select("a", "b", "likeness"))

    stars = materialise(near(members.where("node <> centre").select(
        F.col("node").alias("a"), F.col("centre").alias("b")).distinct()), "stars")
    # First the likeliest centre of each member.
    best = stars.groupBy("a").agg(F.max(F.struct("likeness", "b")).alias("m")).select("a", "m.b")
    links = materialise(confirmed(best, texts, p), "confirmed")
    comp = materialise(components(links), "comp")

    def unresolved() -> DataFrame:
        """``(key, node, comp)`` of the buckets whose members are not all in one component."""
        placed = members.select("key", "node").join(comp, "node", "left").select(
            "key", "node", F.coalesce("comp", "node").alias("comp"))
        mixed = placed.groupBy("key").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi")).where("lo < hi")
        return materialise(placed.join(mixed.select("key"), "key"), "open")

    # Then its other centres as far as they still matter, and a few more by chance, since the smallest
    # member need not be the one that the others are near to.
    rest = stars.join(best, ["a", "b"], "left_anti").select("a", "b")
    open_ = unresolved()
    by_chance = [F.min(F.struct(F.xxhash64("node", F.lit(i)), "node"))["node"].alias(f"c{i}") for i in range(p.more)]
    more = open_.join(open_.groupBy("key").agg(*by_chance), "key").select(
        F.col("node").alias("a"), F.explode(F.array(*[f"c{i}" for i in range(p.more)])).alias("b")).where("a <> b").distinct()
    both = apart(rest, comp).union(near(apart(more, comp)).select("a", "b")).distinct()
    links = materialise(links.union(confirmed(both, texts, p)), "confirmed")
    comp = materialise(components(links), "comp")
    # Then all members of a bucket that are not in one component.
    open_ = unresolved()
    fine = materialise(texts.join(open_.select("node").distinct(), "node").select("node", "z").mapInArrow(
        fine_batches(p), "node long, fine array<long>"), "fine")
    cross = materialise(_across(open_, parts, fine, p), "cross")
    done = stars.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
    cross = cross.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).join(
        done, ["a", "b"], "left_anti")
    links = links.union(confirmed(cross, texts, p))
    comp = materialise(components(links), "comp")

    named = classes.join(comp, "node", "left").withColumn("comp", F.coalesce("comp", "node"))
    named = materialise(named, "named")
    # Written, so that the join below can split a component that has very many classes.
    ids = materialise(named.groupBy("comp").agg(F.min("least").alias("component_id")), "ids")
    table = s.select("row", "doc_id", "text_key", "n_shingles", "digest").join(
        named.join(ids, "comp").select("digest", "component_id", "comp"), "digest", "left")
    table = table.withColumn("component_id", F.when(F.col("digest").isNull(), F.col("doc_id"))
                             .otherwise(F.col("component_id")))
    # The row that stands for a component is the first with its id.
    heads = table.where("comp IS NOT NULL AND doc_id <=> component_id").groupBy("comp").agg(F.min("row").alias("row"))
    table = table.join(heads.select("row", F.lit(True).alias("head")), "row", "left")
    return table.select(
        "row", "doc_id", "text_key", "n_shingles", "component_id",
        F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(False)).alias("kept"),
        (F.col("comp").isNull() | F.coalesce("head", F.lit(False))).alias("first"))


def _across(members: DataFrame, parts: DataFrame, fine: DataFrame, p: NearDup) -> DataFrame:
    """Pairs ``(a, b)`` of a bucket in different components that both signatures let through, each pair once.

    A bucket is cut into blocks and every two blocks meet in a group of their
    own, so no group holds more than about twice ``p.block`` members.
    """
    sizes = members.groupBy("key").agg(F.ceil(F.count("*") / p.block).cast("int").alias("blocks"))
    keys = parts.select("node", "bits", F.transform("bands", _short).alias("keys"))
    rows = members.join(sizes, "key").withColumn("block", F.pmod(F.xxhash64("node", F.lit(p.seed)), F.col("blocks")).cast("int"))
    rows = rows.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).select(
        "key", F.least("block", "other").alias("lo"), F.greatest("block", "other").alias("hi"), "block", "node", "comp")
    rows = rows.join(fine, "node").join(keys, "node").select(
        "key", "lo", "hi", "block", "node", "comp", F.array_position("keys", _short(F.col("key"))).cast("int").alias("band"),
        "bits", "fine", "keys")
    n = int(members.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = rows.repartition(n, "key", "lo", "hi").sortWithinPartitions("key", "lo", "hi")
    return dealt.mapInArrow(_across_batches(p), "a long, b long")


def _across_batches(p: NearDup):
    def differing(x: np.ndarray, y: np.ndarray) -> np.ndarray:
        d = x ^ y
        return np.bitwise_count((d | (d >> np.uint64(1))) & np.uint64(HALF_MASK))

    def compare(g: list[np.ndarray]) -> list[tuple[np.ndarray, np.ndarray]]:
        _, lo, hi, block, node, comp, band, bits, fine, keys = g
        same = lo[0] == hi[0]
        left, right = (np.arange(len(node)),) * 2 if same else (np.flatnonzero(block == lo[0]), np.flatnonzero(block == hi[0]))
        found = []
        for i in range(0, len(left), 256):
            some = left[i:i + 256]
            differ = sum(differing(bits[some, w][:, None], bits[right, w][None]).astype(np.int32) for w in range(bits.shape[1]))
            near = (differ <= _most_differing(p.bands * p.rows, p.cut)) & (comp[some][:, None] != comp[right][None])
            if same:
                near &= node[some][:, None] < node[right][None]
            x, y = np.nonzero(near)
            for j in range(0, len(x), 1 << 15):
                u, v = some[x[j:j + (1 << 15)]], right[y[j:j + (1 << 15)]]
                close = differing(fine[u], fine[v]).sum(axis=1, dtype=np.int32) <= _most_differing(p.fine, p.fine_cut)
                u, v = u[close], v[close]
                first = (keys[u] == keys[v]).argmax(axis=1) == band[0] - 1  # their first common bucket
                found.append((node[u[first]], node[v[first]]))
        return found

    def run(batches) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] | None = None

        def emit(group):
            if len(group[4]) > 1 and (group[5] != group[5][0]).any():
                for a, b in compare(group):
                    if len(a):
                        yield pa.RecordBatch.from_arrays([pa.array(np.minimum(a, b)), pa.array(np.maximum(a, b))],
                                                         names=["a", "b"])

        for batch in batches:
            if not batch.num_rows:
                continue
            new = [np.asarray(c) for c in batch.columns[:7]]
            for k, kind in ((7, np.uint64), (8, np.uint64), (9, np.int32)):
                flat = np.asarray(batch.column(k).flatten())
                new.append(flat.astype(np.int64).view(np.uint64).reshape(len(new[0]), -1) if kind is np.uint64
                           else flat.reshape(len(new[0]), -1))
            held = new if held is None else [np.concatenate(x) for x in zip(held, new, strict=True)]
            change = (held[0][1:] != held[0][:-1]) | (held[1][1:] != held[1][:-1]) | (held[2][1:] != held[2][:-1])
            cuts = [0, *(np.flatnonzero(change) + 1)]
            for a, b in zip(cuts[:-1], cuts[1:], strict=True):
                yield from emit([x[a:b] for x in held])
            held = [x[cuts[-1]:] for x in held]
        if held is not None:
            yield from emit(held)
    return run


def apart(pairs: DataFrame, comp: DataFrame) -> DataFrame:
    """Pairs whose ends are not known to be in one component."""
    where = lambda c: comp.toDF(c, f"c{c}")
    return (pairs.join(where("a"), "a", "left").join(where("b"), "b", "left")
            .where(F.coalesce("ca", "a") != F.coalesce("cb", "b")).select("a", "b"))


def drop_near_duplicates(docs: DataFrame, p: NearDup = NearDup()) -> DataFrame:
    """``docs`` with one row of each component of near-duplicates, all columns kept.

    Rows without words are no duplicates of anything, but repeated rows (same
    doc_id, same text) stay only once.
    """
    names = docs.columns
    kept = near_duplicates(docs, p).where("first").select(
        F.col("doc_id").alias("_id"), F.col("text_key").alias("_key")).distinct()
    keyed = docs.withColumn("_key", F.sha2(F.coalesce(F.col("text"), F.lit("")), 256))
    joined = keyed.join(kept.withColumnRenamed("_key", "_kept"), F.col("doc_id").cast("long").eqNullSafe(F.col("_id"))
                        & (F.col("_key") == F.col("_kept")), "left_semi")
    return joined.dropDuplicates(["doc_id", "_key"]).select(*names)
