"""Reproducible order and ranks that no single task has to compute.

``row_number`` over one big partition puts that partition into one task. The
ranks here come from two levels instead: rows are cut into cells by the leading
digits of a hash key, the cells are counted and summed up in order, and each
row adds its place inside its cell. Hash digits are uniform, so the cells are
even whatever the data looks like.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

PREFIX = 3  # 16 ** 3 cells


def order_key(*parts: Column | int | str) -> Column:
    """A hash key that depends on its parts only, never on partitioning."""
    cols = [p if isinstance(p, Column) else F.lit(str(p)) for p in parts]
    return F.md5(F.concat_ws(":", *[c.cast("string") for c in cols]))


def join_on(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    """Inner join in which a null key meets the null key, so no row is lost."""
    renamed = right.withColumnsRenamed({k: f"__r_{k}" for k in keys})
    same = [F.col(k).eqNullSafe(F.col(f"__r_{k}")) for k in keys]
    return left.join(renamed, same).drop(*[f"__r_{k}" for k in keys])


def with_rank(df: DataFrame, *, key: str, ties: list[str], by: list[str] = (), leading: list[str] = (),
              out: str = "rank", prefix: int = PREFIX) -> DataFrame:
    """Exact 1-based ``row_number`` within ``by``, ordered by leading, key, ties.

    ``leading`` are ascending columns with few values; ``key`` is a hash in
    hexadecimal. Rows with a null grouping column are a group of their own.
    ``prefix`` digits make ``16 ** prefix`` cells per group.
    """
    by, leading, ties = list(by), list(leading), list(ties)
    cell, before, local = "__cell", "__before", "__local"
    rows = df.withColumn(cell, F.substring(key, 1, prefix))
    group = by + leading + [cell]
    # Cells are added up inside one combination of the leading columns, and these among themselves.
    earlier = Window.partitionBy(*by, *leading).orderBy(cell).rowsBetween(Window.unboundedPreceding, -1)
    counts = rows.groupBy(*group).agg(F.count("*").alias("__n"))
    cells = counts.select(*group, F.coalesce(F.sum("__n").over(earlier), F.lit(0)).alias(before))
    if leading:
        sooner = Window.partitionBy(*by).orderBy(*leading).rowsBetween(Window.unboundedPreceding, -1)
        heads = (counts.groupBy(*by, *leading).agg(F.sum("__n").alias("__n"))
                 .select(*by, *leading, F.coalesce(F.sum("__n").over(sooner), F.lit(0)).alias("__sooner")))
        cells = join_on(cells, heads, by + leading).select(*group, (F.col(before) + F.col("__sooner")).alias(before))
    placed = rows.withColumn(local, F.row_number().over(Window.partitionBy(*group).orderBy(key, *ties)))
    return (join_on(placed, cells, group)
            .withColumn(out, F.col(before) + F.col(local))
            .select(*df.columns, out))


def seeded_order(df: DataFrame, id_col: str, seed: int, out: str = "shuffle_key") -> DataFrame:
    """Add the key of a random order that a seed fixes; sort by it and the id."""
    return df.withColumn(out, order_key(F.col(id_col), seed))


def block_rank(df: DataFrame, *, by: str, pos: str, out: str, block: int = 4096) -> DataFrame:
    """1-based rank by an integer position within ``by``, block by block.

    The positions may have gaps. A long sequence is split into blocks of
    positions, so one huge document is ranked by many tasks.
    """
    cell, before, local = "__cell", "__before", "__local"
    rows = df.withColumn(cell, F.floor(F.col(pos) / block).cast("long"))
    earlier = Window.partitionBy(by).orderBy(cell).rowsBetween(Window.unboundedPreceding, -1)
    cells = (rows.groupBy(by, cell).agg(F.count("*").alias("__n"))
             .select(by, cell, F.coalesce(F.sum("__n").over(earlier), F.lit(0)).alias(before)))
    placed = rows.withColumn(local, F.row_number().over(Window.partitionBy(by, cell).orderBy(pos)))
    return (join_on(placed, cells, [by, cell]).withColumn(out, F.col(before) + F.col(local))
            .select(*df.columns, out))


def block_sum(df: DataFrame, *, by: str, pos: str, amount: str, out: str, block: int = 4096) -> DataFrame:
    """Sum of ``amount`` over the earlier positions within ``by``."""
    cell, before, local = "__cell", "__before", "__local"
    rows = df.withColumn(cell, F.floor(F.col(pos) / block).cast("long"))
    earlier = Window.partitionBy(by).orderBy(cell).rowsBetween(Window.unboundedPreceding, -1)
    cells = (rows.groupBy(by, cell).agg(F.sum(amount).alias("__n"))
             .select(by, cell, F.coalesce(F.sum("__n").over(earlier), F.lit(0)).alias(before)))
    inside = Window.partitionBy(by, cell).orderBy(pos).rowsBetween(Window.unboundedPreceding, -1)
    placed = rows.withColumn(local, F.coalesce(F.sum(amount).over(inside), F.lit(0)))
    return (join_on(placed, cells, [by, cell]).withColumn(out, F.col(before) + F.col(local))
            .select(*df.columns, out))
