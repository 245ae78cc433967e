"""Line dedup: repeated lines as keep bitmaps.

Every document sends one row per distinct line key: a 128-bit hash, the
document, the places of its lines. The rows are dealt out by ranges of (hash,
document) and sorted in each range, places ascending, so one hash however
frequent may run over many ranges. A range is streamed once: runs of equal
hashes are decided inside it, and only its first and its last run, which may
go on in a neighbouring range, meet the sums over ranges, at most two each.
What comes back is a compressed bitmap per document with a bit per line; no
text is shuffled for it.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusmill.llm.batches import small_batches
from corpusmill.llm.wordcodes import chunks
from corpusmill.runtime import materialise


@dataclass(frozen=True)
class Rule:
    """Lines whose key has ``least_chars`` code points and is in ``least_docs`` documents go.

    With ``keep_first`` the first of them stays, by document and place.
    """

    least_chars: int = 1
    least_docs: int = 10
    keep_first: bool = False


#: The hash, the document (its text by a hash of its own), the places of the lines and how many lines the document has.
_LINES = pa.schema([("hi", pa.int64()), ("lo", pa.int64()), ("doc_id", pa.int64()), ("mark", pa.int64()),
                    ("places", pa.list_(pa.int32())), ("n_lines", pa.int32())])
_LINES_SQL = "hi long, lo long, doc_id long, mark long, places array<int>, n_lines int"
#: Decided rows have no hash; ``rows`` is the length of a run in the range ``part``, and null for rows of lines.
_FOUND_SQL = _LINES_SQL + ", rows long, part int"
_DOCUMENT = ["doc_id", "mark"]
#: Rows that are sent on together.
_ROWS = 1 << 14


def line_key(line: bytes) -> bytes:
    """What equal lines have in common: stripped of ASCII white space, A-Z in lower case."""
    return line.strip().lower()


def _hashed(batches, rule: Rule) -> Iterator[pa.RecordBatch]:
    """One row per document and distinct key of sufficient length."""
    out: list[tuple] = []

    def sent() -> pa.RecordBatch:
        columns = [pa.array(c, f.type) for c, f in zip(zip(*out, strict=True), _LINES, strict=True)]
        out.clear()
        return pa.RecordBatch.from_arrays(columns, schema=_LINES)

    for batch in chunks(batches, "text"):
        for doc_id, mark, text in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
            lines = text.encode().split(b"\n")
            places: dict[bytes, list[int]] = {}
            for i, line in enumerate(lines):
                key = line_key(line)
                # A code point has at most four bytes, so only short keys are counted.
                if len(key) >= 4 * rule.least_chars or len(key.decode()) >= rule.least_chars:
                    places.setdefault(xxhash.xxh3_128_digest(key), []).append(i)
            for digest, at in places.items():
                out.append((int.from_bytes(digest[:8], "big", signed=True), int.from_bytes(digest[8:], "big", signed=True),
                            doc_id, mark, at, len(lines)))
                if len(out) >= _ROWS:
                    yield sent()
    if out:
        yield sent()


class _Range:
    """The stream through one range: what is known of the run at hand."""

    def __init__(self, rule: Rule, part: int):
        self.rule, self.part = rule, part
        self.key: tuple | None = None
        self.inside = False  # the run began in this range after another one
        self.count, self.held, self.lead = 0, [], None

    def stream(self, batches) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            rows = pa.Table.from_batches([batch])
            hi, lo = (batch.column(i).to_numpy(zero_copy_only=False) for i in (0, 1))
            cuts = np.flatnonzero((hi[1:] != hi[:-1]) | (lo[1:] != lo[:-1])) + 1
            if self.key is not None and self.key != (hi[0], lo[0]):
                yield from self._closed()
            self.key = (hi[0], lo[0])
            yield from self._more(rows.slice(0, cuts[0] if len(cuts) else None))
            if len(cuts):
                yield from self._closed()
                yield from self._between(rows.slice(cuts[0], cuts[-1] - cuts[0]), np.diff(cuts))
                self.key = (hi[-1], lo[-1])
                yield from self._more(rows.slice(cuts[-1]))
        if self.key is not None:
            for rows in self.held:
                yield from self._sent(rows, decided=False)
            yield from self._total()

    def _more(self, rows: pa.Table) -> Iterator[pa.RecordBatch]:
        """More rows of the run at hand; they wait until it is frequent, at most ``least_docs`` of them."""
        before = self.count
        self.count += rows.num_rows
        if not before:
            self.lead = (rows["doc_id"][0].as_py(), rows["mark"][0].as_py())
        if not self.inside:
            yield from self._sent(rows, decided=False)
            return
        self.held.append(rows)
        if self.count >= self.rule.least_docs:
            ready, self.held = pa.concat_tables(self.held), []
            if self.rule.keep_first:
                own = pc.and_(_same(ready["doc_id"], self.lead[0]), _same(ready["mark"], self.lead[1]))
                ready = _later_places(ready, own.to_numpy(zero_copy_only=False))
            yield from self._sent(ready, decided=True)

    def _between(self, rows: pa.Table, lengths: np.ndarray) -> Iterator[pa.RecordBatch]:
        """Whole runs of these lengths."""
        often = np.repeat(lengths >= self.rule.least_docs, lengths)
        if not often.any():
            return
        first = np.repeat(np.cumsum(lengths) - lengths, lengths)
        if self.rule.keep_first:
            own = np.ones(rows.num_rows, bool)
            for name in _DOCUMENT:
                codes = pc.dictionary_encode(rows[name].combine_chunks(), null_encoding="encode").indices.to_numpy()
                own &= codes == codes[first]
            rows = _later_places(rows.append_column("__often", pa.array(often)), own)
            often = rows["__often"].to_numpy()
            rows = rows.drop_columns("__often")
        yield from self._sent(rows.filter(pa.array(often)), decided=True)

    def _closed(self) -> Iterator[pa.RecordBatch]:
        if not self.inside:
            yield from self._total()
        self.count, self.held, self.inside = 0, [], True

    def _sent(self, rows: pa.Table, decided: bool) -> Iterator[pa.RecordBatch]:
        n = rows.num_rows
        if decided:
            rows = pa.table([pa.nulls(n, pa.int64()), pa.nulls(n, pa.int64()), *rows.columns[2:]], schema=rows.schema)
        rows = rows.append_column("rows", pa.nulls(n, pa.int64())).append_column("part", pa.nulls(n, pa.int32()))
        yield from rows.to_batches()

    def _total(self) -> Iterator[pa.RecordBatch]:
        row = [*self.key, *self.lead, None, None, self.count, self.part]
        schema = _LINES.append(pa.field("rows", pa.int64())).append(pa.field("part", pa.int32()))
        yield pa.RecordBatch.from_arrays([pa.array([v], f.type) for v, f in zip(row, schema, strict=True)], schema=schema)


def _same(column: pa.ChunkedArray, value) -> pa.ChunkedArray:
    return pc.is_null(column) if value is None else pc.fill_null(pc.equal(column, value), False)


def _later_places(rows: pa.Table, own: np.ndarray) -> pa.Table:
    """Rows of a run's first document (``own``) keep all but their first place, and go if they have no other."""
    if not own.any():
        return rows
    places = rows["places"].to_pylist()
    places = [p[1:] if o else p for p, o in zip(places, own, strict=True)]
    rows = rows.set_column(rows.schema.get_field_index("places"), "places", pa.array(places, pa.list_(pa.int32())))
    return rows.filter(pa.array([bool(p) for p in places]))


def _lines(docs: DataFrame) -> DataFrame:
    text = F.coalesce(F.col("text"), F.lit(""))
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(text).alias("mark"), text.alias("text"))


def dropped_places(docs: DataFrame, rule: Rule = Rule()) -> DataFrame:
    """``(doc_id, mark, places, n_lines)``: the places of lines that go, for documents that lose any.

    ``mark`` is ``xxhash64`` of the text. Rows that repeat both doc_id and text
    count as documents of their own and are one row here; they lose the same
    lines, and with ``keep_first`` count as one.
    """
    small_batches(docs.sparkSession)
    hashed = materialise(_lines(docs).mapInArrow(lambda b: _hashed(b, rule), _LINES_SQL), "lines")
    n = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    order = ["hi", "lo", *_DOCUMENT]
    found = materialise(
        hashed.repartitionByRange(n, *order).sortWithinPartitions(*order)
        .mapInArrow(lambda b: _Range(rule, TaskContext.get().partitionId()).stream(b), _FOUND_SQL), "line-runs")
    # At most two rows per range, so their number is fixed.
    totals = (found.where("rows IS NOT NULL").groupBy("hi", "lo")
              .agg(F.sum("rows").alias("all"), F.min_by(F.struct(*_DOCUMENT), "part").alias("lead"))
              .where(F.col("all") >= rule.least_docs).select("hi", "lo", "lead"))
    rows = found.where("rows IS NULL").select(*order, "places", "n_lines")
    border = rows.where("hi IS NOT NULL").join(F.broadcast(totals), ["hi", "lo"])
    if rule.keep_first:
        own = F.col("lead").eqNullSafe(F.struct(*_DOCUMENT))
        border = border.withColumn("places", F.when(own, F.slice("places", 2, F.size("places"))).otherwise(F.col("places")))
    gone = rows.where("hi IS NULL").drop("hi", "lo").unionByName(border.drop("hi", "lo", "lead"))
    return gone.groupBy(*_DOCUMENT).agg(F.array_distinct(F.flatten(F.collect_set("places"))).alias("places"),
                                        F.any_value("n_lines").alias("n_lines")).where(F.size("places") > 0)


def packed(places: list[int], n_lines: int) -> bytes:
    """The compressed bitmap in which these places are 0 and all others 1, line 0 in the highest bit."""
    keep = np.ones(n_lines, bool)
    keep[places] = False
    return zlib.compress(np.packbits(keep).tobytes())


def unpacked(bitmap: bytes, n_lines: int) -> np.ndarray:
    return np.unpackbits(np.frombuffer(zlib.decompress(bitmap), np.uint8), count=n_lines).view(bool)


def _bitmaps(batches) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        places, sizes = (batch.column(i).to_pylist() for i in (2, 3))
        maps = [packed(p, n) for p, n in zip(places, sizes, strict=True)]
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), batch.column(3), pa.array(maps, pa.binary())],
                                         names=["doc_id", "mark", "n_lines", "keep"])


def keep_bitmaps(docs: DataFrame, rule: Rule = Rule()) -> DataFrame:
    """``(doc_id, mark, n_lines, keep)`` of the documents that lose lines; all other documents keep every line.

    A null or empty text is one empty line. A line of any length counts whole.
    Null ids come before all others. An empty table gives no rows.
    """
    return dropped_places(docs, rule).mapInArrow(_bitmaps, "doc_id long, mark long, n_lines int, keep binary")


def _applied(batches) -> Iterator[pa.RecordBatch]:
    for batch in chunks(batches, "text"):
        sizes, gone, kept = [], [], []
        for text, bitmap in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True):
            if bitmap is None:
                sizes.append(text.count("\n") + 1)
                gone.append(0)
                kept.append(text)
                continue
            lines = text.split("\n")
            stay = unpacked(bitmap, len(lines))
            sizes.append(len(lines))
            gone.append(len(lines) - int(stay.sum()))
            kept.append("\n".join(line for line, s in zip(lines, stay.tolist(), strict=True) if s))
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(sizes, pa.int64()), pa.array(gone, pa.int64()),
                                          pa.array(kept, pa.string()), batch.column(2)],
                                         names=["doc_id", "n_lines", "n_dropped", "kept", "keep"])


def apply_bitmaps(docs: DataFrame, bitmaps: DataFrame) -> DataFrame:
    """``(doc_id, n_lines, n_dropped, kept, keep)`` of every document; ``keep`` is null where all lines stay."""
    small_batches(docs.sparkSession)
    maps = bitmaps.select(*[F.col(c).alias(f"_{c}") for c in _DOCUMENT], "keep")
    met = _lines(docs).join(maps, F.col("doc_id").eqNullSafe(F.col("_doc_id")) & (F.col("mark") == F.col("_mark")), "left")
    return met.select("doc_id", "text", "keep").mapInArrow(
        _applied, "doc_id long, n_lines long, n_dropped long, kept string, keep binary")


def dedup_lines(docs: DataFrame, rule: Rule = Rule()) -> DataFrame:
    """Every document without its frequent lines, see ``apply_bitmaps``; other columns of ``docs`` are not looked at."""
    return apply_bitmaps(docs, keep_bitmaps(docs, rule))
