"""Selection under a limit per author and a limit per class.

The rule is a walk through the rows in order: a row is taken while neither its
author nor its class is full, and only taken rows use up places.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from corpusmill.runtime import materialise


# Parts of a class that are limited on their own first.
CELLS = 64


def _numbered(df: DataFrame, keys: list[str], order: list[str], limit: int) -> DataFrame:
    place = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("__rn", F.row_number().over(place)).where(F.col("__rn") <= limit).drop("__rn")


def quota_select(rows: DataFrame, *, author: str, group: str, order: list[str], per_author: int,
                 per_group: int) -> DataFrame:
    """The walk for authors that belong to one class only: two row limits.

    Both limits are applied on the map side first. A class may hold most of
    the rows, so its limit is applied in cells and then to what these leave.
    """
    few = _numbered(rows, [author], order, per_author).withColumn("__cell", F.pmod(F.xxhash64(*order), F.lit(CELLS)))
    return _numbered(_numbered(few, [group, "__cell"], order, per_group).drop("__cell"), [group], order, per_group)


def quota_select_general(rows: DataFrame, *, author: str, group: str, order: list[str], per_author: int,
                         per_group: int) -> DataFrame:
    """The walk for authors that may belong to several classes.

    Rows beyond the first ``per_author`` of an author within one class can
    never be taken, which bounds the rows that have to be looked at; these are
    written first. A class is full from some place on, and its later rows use
    up no places of their authors. All classes' places are found together: from
    those known so far follow the rows taken, and from these each class's place
    anew, until none changes. The first place that was wrong is right after a
    round, so there are at most as many rounds as classes fill up, and commonly
    a few. The places are a table; only whether it changed reaches the driver.
    Rows without a class are a class, rows without an author one author's.
    """
    live = materialise(_numbered(rows, [author, group], order, per_author), "quota")
    place = F.struct(*order)
    limits = None
    while True:
        open_ = live
        if limits is not None:
            open_ = (live.join(limits, live[group].eqNullSafe(limits["__g"]), "left")
                     .where(F.col("__limit").isNull() | (place <= F.col("__limit"))).select(*live.columns))
        taken = _numbered(open_, [author], order, per_author)
        at = Window.partitionBy(group).orderBy(*order)
        filled = (taken.withColumn("__rn", F.row_number().over(at)).where(F.col("__rn") <= per_group)
                  .where(F.col("__rn") == per_group).select(F.col(group).alias("__g"), place.alias("__limit")))
        found = materialise(filled, "quota-limits")
        if found.isEmpty() if limits is None else _same(found, limits):
            return taken
        limits = found


def _same(a: DataFrame, b: DataFrame) -> bool:
    """Whether two tables of limits, a row per class, are equal."""
    other = b.withColumnsRenamed({"__g": "__h", "__limit": "__other"})
    met = a.withColumn("__a", F.lit(1)).join(other.withColumn("__b", F.lit(1)), F.col("__g").eqNullSafe(F.col("__h")), "full")
    return met.where(F.col("__a").isNull() | F.col("__b").isNull() | ~F.col("__limit").eqNullSafe(F.col("__other"))).isEmpty()
