"""Arithmetic on array columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def pack(columns) -> Column:
    """Columns as one array of doubles."""
    return F.array(*[F.col(c).cast("double") for c in columns])


def standardise(x: Column, mean: Column, scale: Column) -> Column:
    """``(x - mean) / scale`` by element."""
    centred = F.zip_with(x, mean, lambda a, b: a - b)
    return F.zip_with(centred, scale, lambda a, s: a / s)


def euclidean(a: Column, b: Column) -> Column:
    squares = F.zip_with(a, b, lambda p, q: (p - q) * (p - q))
    return F.sqrt(F.aggregate(squares, F.lit(0.0), lambda s, v: s + v))
