"""Statistics as column expressions."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

# The series of Stirling's formula is used from here on, where its error is below double precision.
_SHIFT = 10


def ln_gamma(a: Column) -> Column:
    """Logarithm of the gamma function for positive arguments."""
    z = a + F.lit(float(_SHIFT))
    inner = F.lit(0.0)
    # The first terms of Stirling's series.
    for power, divisor in ((9, 1188.0), (7, -1680.0), (5, 1260.0), (3, -360.0), (1, 12.0)):
        inner = inner + F.lit(1.0 / divisor) / F.pow(z, power)
    below = F.lit(0.0)
    for i in range(_SHIFT):
        below = below + F.ln(a + F.lit(float(i)))
    return (z - 0.5) * F.ln(z) - z + F.lit(0.5 * math.log(2 * math.pi)) + inner - below


def _terms(a: Column) -> Column:
    """How many terms reach double precision: both expansions take some square roots of ``a``, most at ``x = a``."""
    return F.sequence(F.lit(1), F.ceil(F.sqrt(a) * 12 + 80).cast("int"))


def gamma_tail(a: Column, x: Column) -> Column:
    """Upper part of the gamma distribution: a series below ``a + 1``, a continued fraction beyond."""
    front = F.exp(a * F.ln(x) - x - ln_gamma(a))
    series = F.aggregate(
        _terms(a), F.struct((1 / a).alias("t"), (1 / a).alias("s")),
        lambda acc, i: F.struct((acc.t * x / (a + i)).alias("t"), (acc.s + acc.t * x / (a + i)).alias("s")),
        lambda acc: acc.s)
    steps = _terms(a)
    fraction = F.aggregate(F.reverse(steps), x + 2 * F.size(steps) + 1 - a,
                           lambda acc, i: (x + 2 * i - 1 - a) - i * (i - a) / acc)
    tail = F.when(x < a + 1, 1 - front * series).otherwise(front / fraction)
    return F.when(x <= 0, F.lit(1.0)).otherwise(F.greatest(F.lit(0.0), F.least(F.lit(1.0), tail)))


def chi_square_tail(x: Column, df: Column | int) -> Column:
    """Upper tail of the chi-square distribution; null for a null ``x`` or without a degree of freedom.

    The work grows with the square root of the degrees, so millions of classes
    take some thousand terms.
    """
    df = df if isinstance(df, Column) else F.lit(df)
    tail = gamma_tail(df.cast("double") / 2, x / F.lit(2.0))
    return F.when((df < 1) | x.isNull(), F.lit(None).cast("double")).otherwise(tail)


def tidy(value: Column, digits: int) -> Column:
    """Rounded for output; a negative zero becomes zero."""
    return F.round(value, digits) + F.lit(0.0)
