"""Embedding whitening from exact bit-sliced sums.

An entry c becomes the integer ``floor(scale * c) + shift``. Blocks of distinct
vectors are cut into bit planes: per dimension and bit one row of 64-bit words
that holds this bit of every vector of the block, after the block's smallest
value of the dimension is taken off. The cross-product of two dimensions is the
sum over pairs of planes of ``2 ** (i + j)`` times the bits they share, counted
by AND and popcount, so it is an exact integer however the rows are dealt out.
The sums are centred as integers; floating point begins with the division by
``n ** 2`` before the eigenvectors are found.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusmill.llm.batches import small_batches
from corpusmill.runtime import materialise


@dataclass(frozen=True)
class Grid:
    """Entries as integers, and how many components are wanted."""

    scale: int = 64
    shift: int = 1_000_000
    components: int = 16
    #: Rows that are cut into planes together, a multiple of 64.
    block: int = 8192
    #: Components with a smaller share of the largest eigenvalue are rounding errors.
    least: float = 1e-11


@dataclass(frozen=True)
class Model:
    """``n`` distinct vectors, their sums, and the components as rows by falling eigenvalue."""

    n: int
    sums: list[int]
    axes: np.ndarray
    values: np.ndarray
    trace: float


#: Scaled entries from here on fit in no 64-bit integer.
_LARGEST = float(1 << 62)
_HALF = 1 << 60
_INT64 = (1 << 63) - 1


def _usable(vector: Column, p: Grid) -> Column:
    scaled = lambda c: c.cast("double") * F.lit(float(p.scale))
    return vector.isNotNull() & F.coalesce(F.forall(vector, lambda c: F.coalesce(
        ~F.isnan(c) & (F.abs(scaled(c)) < _LARGEST), F.lit(False))), F.lit(False))


def on_grid(rows: DataFrame, p: Grid = Grid(), *, vec_id: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """``(vec_id, x)`` of the rows whose entries all are finite numbers.

    Entries that times ``scale`` exceed 2**62 have no integer and count as not
    finite. Rows of another length than the commonest (the longer on a tie)
    lack entries of the space and are left out as well, as are empty vectors.
    """
    v = F.col(vector)
    usable = rows.select(F.col(vec_id).alias("vec_id"), v.alias("v")).where(_usable(F.col("v"), p))
    lengths = usable.groupBy(F.size("v").alias("size")).agg(F.count("*").alias("n"))
    common = lengths.agg(F.max_by("size", F.struct("n", "size")).alias("size")).first()["size"]
    x = F.transform("v", lambda c: F.floor(c.cast("double") * F.lit(float(p.scale))) + F.lit(p.shift))
    return usable.where((F.size("v") == F.lit(common or 0)) & (F.size("v") > 0)).select("vec_id", x.alias("x"))


def _vectors(column: pa.Array) -> np.ndarray:
    """A column of equally long lists as a matrix."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), -1) if len(column) else flat.reshape(0, 0)


def planes(y: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bit planes of a matrix of unsigned integers: ``(dimension, bit, words)``; empty planes are left out."""
    rows = -len(y) % 64
    dims, bits, words = [], [], []
    for bit in range(int(y.max(initial=0)).bit_length()):
        on = ((y >> np.uint64(bit)) & np.uint64(1)).astype(np.uint8)
        used = np.flatnonzero(on.any(axis=0))
        if not len(used):
            continue
        packed = np.packbits(np.pad(on[:, used], ((0, rows), (0, 0))).T, axis=1)
        dims.append(used)
        bits.append(np.full(len(used), bit))
        words.append(np.ascontiguousarray(packed).view(np.uint64).reshape(len(used), -1))
    if not dims:
        return np.zeros(0, int), np.zeros(0, int), np.zeros((0, 0), np.uint64)
    return np.concatenate(dims), np.concatenate(bits), np.concatenate(words)


def cross_products(y: np.ndarray) -> np.ndarray:
    """``y.T @ y`` of unsigned integers as Python integers, from shared bits of planes."""
    size = y.shape[1]
    out = np.zeros((size, size), dtype=object)
    dims, bits, words = planes(y)
    if not len(dims):
        return out
    # All sums below 2 ** 62 go through 64-bit integers, others through Python's.
    small = 2 * (int(bits.max()) + 1) + len(y).bit_length() <= 62
    total = np.zeros((size, size), dtype=np.int64 if small else object)
    weight = [1 << int(b) for b in bits]
    weight = np.array(weight, dtype=np.int64 if small else object)
    for a in range(len(dims)):
        shared = np.bitwise_count(words[a] & words).sum(axis=1, dtype=np.int64)
        np.add.at(total, (dims[a], dims), (shared if small else shared.astype(object)) * weight * weight[a])
    return out + total


@dataclass
class Sums:
    """Number, sums and cross-products of vectors, exact. Sums of parts add up to those of the whole."""

    n: int
    one: np.ndarray
    two: np.ndarray

    @classmethod
    def of(cls, z: np.ndarray) -> Sums:
        low = z.min(axis=0)
        y = (z.astype(object) - low.astype(object)).astype(np.uint64) if np.abs(z).max() >= 1 << 61 else (z - low).astype(np.uint64)
        base, n = low.astype(object), len(z)
        rest = y.astype(object).sum(axis=0) if int(y.max()) > _INT64 // max(n, 1) else y.sum(axis=0).astype(object)
        mixed = np.multiply.outer(base, rest)
        return cls(n, base * n + rest, cross_products(y) + mixed + mixed.T + np.multiply.outer(base, base) * n)

    def __add__(self, other: Sums) -> Sums:
        return Sums(self.n + other.n, self.one + other.one, self.two + other.two)


def _block_sums(batches, p: Grid) -> Iterator[pa.RecordBatch]:
    """Sums of all vectors of a task, in two parts each because they may not fit in 64 bits."""
    total, waiting, size = None, [], 0

    def added() -> Sums:
        block = Sums.of(np.concatenate(waiting))
        waiting.clear()
        return block if total is None else total + block

    for batch in batches:
        if batch.num_rows:
            z = _vectors(batch.column(0)) - p.shift
            for i in range(0, len(z), p.block):
                part = z[i:i + p.block]
                if size + len(part) > p.block:
                    total, size = added(), 0
                waiting.append(part)
                size += len(part)
    if waiting:
        total = added()
    if total is None:
        return
    a, b = np.triu_indices(len(total.one))
    numbers = [total.n, *total.one, *total.two[a, b]]
    at = [(-2, -2), *((-1, i) for i in range(len(total.one))), *zip(a.tolist(), b.tolist(), strict=True)]
    yield pa.RecordBatch.from_arrays([
        pa.array([x[0] for x in at], pa.int32()), pa.array([x[1] for x in at], pa.int32()),
        pa.array([int(v) // _HALF for v in numbers], pa.decimal128(38, 0)),
        pa.array([int(v) % _HALF for v in numbers], pa.decimal128(38, 0))], names=["a", "b", "high", "low"])


def scatter(distinct: DataFrame, p: Grid = Grid()) -> Sums | None:
    """Exact sums over a table of vectors ``x``, less ``shift`` each; none for an empty table.

    What reaches the driver is one row per pair of dimensions.
    """
    parts = distinct.select("x").mapInArrow(lambda b: _block_sums(b, p), "a int, b int, high decimal(38,0), low decimal(38,0)")
    rows = parts.groupBy("a", "b").agg(F.sum("high").alias("high"), F.sum("low").alias("low")).collect()
    if not rows:
        return None
    cells = {(r["a"], r["b"]): int(r["high"]) * _HALF + int(r["low"]) for r in rows}
    size = sum(a == -1 for a, _ in cells)
    one = np.array([cells[-1, i] for i in range(size)], dtype=object)
    two = np.array([[cells[min(i, j), max(i, j)] for j in range(size)] for i in range(size)], dtype=object)
    return Sums(cells[-2, -2], one, two.reshape(size, size))


def centred(s: Sums) -> np.ndarray:
    """``n ** 2`` times the covariance, as integers."""
    return s.two * s.n - np.multiply.outer(s.one, s.one)


def fit(s: Sums, p: Grid = Grid()) -> Model:
    """Components of the covariance with divisor ``n``; the largest entry of each is positive."""
    square = s.n * s.n
    exact = centred(s)
    # Division of Python integers is correctly rounded.
    cov = np.array([[int(v) / square for v in row] for row in exact], dtype=float)
    values, vectors = np.linalg.eigh(cov)
    values, vectors = values[::-1], vectors.T[::-1]
    kept = int((values > max(values[0], 0.0) * p.least).sum()) if values[0] > 0 else 0
    axes = vectors[:min(kept, p.components)]
    top = np.abs(axes).argmax(axis=1)
    axes = axes * np.sign(axes[np.arange(len(axes)), top])[:, None]
    trace = sum(int(exact[i, i]) for i in range(len(exact))) / square
    return Model(s.n, [int(v) for v in s.one], axes, values[:len(axes)].copy(), trace)


def _deviations(z: np.ndarray, m: Model) -> np.ndarray:
    """``n * z - sums``, exact: 64-bit integers where they fit, else Python's."""
    reach = max(abs(int(z.max(initial=0))), abs(int(z.min(initial=0)))) * m.n + max(map(abs, m.sums))
    kind = np.int64 if reach <= _INT64 else object
    return z.astype(kind) * m.n - np.array(m.sums, dtype=kind)


def whitened(z: np.ndarray, m: Model) -> np.ndarray:
    centre = _deviations(z, m) / m.n
    return centre.astype(float) @ (m.axes / np.sqrt(m.values)[:, None]).T


def squared(z: np.ndarray, m: Model) -> list[int | None]:
    """Sum over dimensions of ``(n * z - sums) ** 2``; none where it exceeds 64 bits."""
    d = _deviations(z, m)
    largest = max(abs(int(d.max(initial=0))), abs(int(d.min(initial=0))))
    if largest * largest * max(1, d.shape[1]) <= _INT64:
        return (d * d).sum(axis=1).tolist()
    sums = (d.astype(object) ** 2).sum(axis=1)
    return [int(v) if v <= _INT64 else None for v in sums]


def identity_error(distinct: DataFrame, m: Model, p: Grid = Grid()) -> float:
    """Largest entry of the whitened fit list's covariance minus the identity, measured on the list."""
    k = len(m.axes)
    if not k:
        return 0.0

    def moments(batches) -> Iterator[pa.RecordBatch]:
        one, two = np.zeros(k), np.zeros((k, k))
        for batch in batches:
            if batch.num_rows:
                w = whitened(_vectors(batch.column(0)) - p.shift, m)
                one, two = one + w.sum(axis=0), two + w.T @ w
        cells = np.concatenate([one, two.ravel()])
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(cells)), pa.int32()), pa.array(cells)], names=["i", "v"])

    rows = distinct.select("x").mapInArrow(moments, "i int, v double").groupBy("i").agg(F.sum("v").alias("v")).collect()
    cells = np.zeros(k + k * k)
    for r in rows:
        cells[r["i"]] = r["v"] / m.n
    mean = cells[:k]
    cov = cells[k:].reshape(k, k) - np.outer(mean, mean)
    return float(np.abs(cov - np.eye(k)).max())


RESULT = ("vec_id long, component int, n long, deviation long, whitened double, explained double, eigenvalue double, "
          "identity_error double")


def whiten(rows: DataFrame, p: Grid = Grid(), *, vec_id: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """One row per usable vector and component, see ``RESULT``.

    The model is fitted on each distinct vector once, so copies do not weigh
    more; they all get rows, alike but for their id. ``deviation`` is null
    where it exceeds 64 bits. Without two different vectors there is no
    component and no row; a covariance of lower rank has fewer components.
    Null ids and other columns do not matter. See ``on_grid`` for rows left out.
    """
    small_batches(rows.sparkSession)
    usable = on_grid(rows, p, vec_id=vec_id, vector=vector)
    distinct = materialise(usable.select("x").distinct(), "distinct-vectors")
    sums = scatter(distinct, p)
    model = None if sums is None else fit(sums, p)
    if model is None or not len(model.axes):
        return rows.sparkSession.createDataFrame([], RESULT)
    error = identity_error(distinct, model, p)
    k = len(model.axes)

    def project(batches) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            size = batch.num_rows
            if not size:
                continue
            z = _vectors(batch.column(1)) - p.shift
            each = np.repeat(np.arange(size), k)
            yield pa.RecordBatch.from_arrays([
                batch.column(0).cast(pa.int64()).take(pa.array(each)), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), size)),
                pa.array(np.full(size * k, model.n)), pa.array(squared(z, model), pa.int64()).take(pa.array(each)),
                pa.array(whitened(z, model).ravel()), pa.array(np.tile(model.values / model.trace, size)),
                pa.array(np.tile(model.values, size)), pa.array(np.full(size * k, error))],
                names=[c.split()[0] for c in RESULT.split(", ")])

    return usable.select("vec_id", "x").mapInArrow(project, RESULT)
