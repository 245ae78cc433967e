"""Words of a whole Arrow string column at once, as 64-bit codes in numpy arrays.

Texts are worked on as UTF-8 bytes. ASCII letters are lower-cased; every other
byte above 0x7F belongs to a word, so words never cut a character. Null texts
count as empty. Temporary arrays cover about ``BLOCK`` bytes at a time, however
long a text is; only a single word longer than that needs more.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

BLOCK = 1 << 19
#: Bytes of text that are turned into words together.
CHUNK = 2 << 20

_BASE = 0x9E3779B97F4A7C15
_STEP = np.random.default_rng(20260101).integers(0, 1 << 63, 64, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def _table(inside) -> np.ndarray:
    return np.array([inside(b) for b in range(256)], dtype=bool)


#: Bytes of words ``[^\x20\x09-\x0D]+``.
UNSPACED = _table(lambda b: b != 0x20 and not 0x09 <= b <= 0x0D)
#: Bytes of lower-cased words ``[^\x00-\x2F\x3A-\x60\x7B-\x7F]+``.
ALNUM = _table(lambda b: b >= 0x80 or 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A)
_LOWER = np.array([b + 32 if 0x41 <= b <= 0x5A else b for b in range(256)], dtype=np.uint8)


@lru_cache(maxsize=2)
def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse modulo 2**64."""
    def row(x: int) -> np.ndarray:
        out = np.full(n + 1, x, dtype=np.uint64)
        out[0] = 1
        return np.cumprod(out, dtype=np.uint64)
    return row(_BASE), row(pow(_BASE, -1, 1 << 64))


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every input bit."""
    x = x ^ (x >> np.uint64(30))
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


@dataclass
class Words:
    """``code`` per word; ``bounds[i]:bounds[i + 1]`` are the words of text i, which begins at byte ``text_start[i]``."""

    data: np.ndarray
    start: np.ndarray
    end: np.ndarray
    code: np.ndarray
    bounds: np.ndarray
    text_start: np.ndarray

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.bounds)

    def owner(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.bounds) - 1), self.counts)


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of all texts and where each begins."""
    column = pc.fill_null(column, "").cast(pa.large_string())
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, dtype=np.int64)[column.offset:column.offset + len(column) + 1]
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[at[0]:at[-1]], at - at[0]


def words(column: pa.Array, inside: np.ndarray = UNSPACED) -> Words:
    raw, at = text_bytes(column)
    data = _LOWER[raw]
    member = inside[data]
    n = len(data)
    before = np.empty(n + 1, dtype=bool)
    before[0] = False
    before[1:] = member
    before[at] = False
    start = np.flatnonzero(member & ~before[:n])
    after = np.empty(n + 1, dtype=bool)
    after[n] = False
    after[:n] = member
    after[at] = False
    end = np.flatnonzero(member & ~after[1:]) + 1
    bounds = np.searchsorted(start, at)
    return Words(data, start, end, _codes(data, start, end), bounds, at[:-1])


def _codes(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    out = np.empty(len(start), dtype=np.uint64)
    i = 0
    while i < len(start):
        a = start[i]
        j = max(i + 1, int(np.searchsorted(end, a + BLOCK, side="right")))
        b = end[j - 1]
        size = BLOCK if b - a <= BLOCK else 1 << int(b - a).bit_length()
        up, down = _powers(size)
        total = np.zeros(b - a + 1, dtype=np.uint64)
        np.cumsum((data[a:b].astype(np.uint64) + np.uint64(1)) * up[:b - a], dtype=np.uint64, out=total[1:])
        s, e = start[i:j] - a, end[i:j] - a
        out[i:j] = mix((total[e] - total[s]) * down[s] + (e - s).astype(np.uint64))
        i = j
    return out


def shingles(w: Words, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Codes of all runs of ``size`` words, and their bounds per text.

    A text with fewer words, but not none, has its whole sequence as one.
    """
    n, counts = len(w.code), w.counts
    full = np.maximum(counts - size + 1, 0)
    made = np.where(counts > 0, np.maximum(full, 1), 0)
    bounds = np.concatenate([[0], np.cumsum(made)])
    out = np.empty(bounds[-1], dtype=np.uint64)
    if n >= size:
        run = np.zeros(n - size + 1, dtype=np.uint64)
        for k in range(size):
            run += w.code[k:n - size + 1 + k] * _STEP[k]
        first = np.repeat(w.bounds[:-1], full) + np.arange(full.sum()) - np.repeat(np.cumsum(full) - full, full)
        place = np.repeat(bounds[:-1], full) + np.arange(full.sum()) - np.repeat(np.cumsum(full) - full, full)
        out[place] = mix(run[first])
    for i in np.flatnonzero((counts > 0) & (counts < size)):
        own = w.code[w.bounds[i]:w.bounds[i + 1]]
        out[bounds[i]] = mix((own * _STEP[:len(own)]).sum(dtype=np.uint64, keepdims=True) + np.uint64(len(own)))[0]
    return out, bounds


def distinct(codes: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct codes of each text in ascending order, and their bounds."""
    owner = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
    order = np.lexsort((codes, owner))
    codes = codes[order]
    new = np.ones(len(codes), dtype=bool)
    new[1:] = (codes[1:] != codes[:-1]) | (owner[1:] != owner[:-1])
    kept = codes[new]
    return kept, np.searchsorted(owner[new], np.arange(len(bounds)))


def chunks(batches, text: str, size: int = CHUNK) -> Iterator[pa.RecordBatch]:
    """The same rows in batches whose texts have about ``size`` bytes at most."""
    for batch in batches:
        n = batch.num_rows
        if not n:
            continue
        lengths = np.asarray(pc.fill_null(pc.binary_length(batch.column(batch.schema.get_field_index(text))), 0))
        total = np.cumsum(lengths.astype(np.int64))
        i = 0
        while i < n:
            used = total[i - 1] if i else 0
            j = max(i + 1, int(np.searchsorted(total, used + size, side="right")))
            yield batch.slice(i, j - i)
            i = j


def signed(codes: np.ndarray) -> pa.Array:
    return pa.array(codes.view(np.int64))


def lists(codes: np.ndarray, bounds: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), signed(codes))
