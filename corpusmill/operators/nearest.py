"""Nearest centroid among many classes: blocks of classes, the least distance per row.

No row ever holds all classes. Classes that lie close together share a block
of bounded size, blocks that lie close together share a larger box, and so on
up to a few. A row goes down these boxes, and is only held against blocks whose
boxes may have a nearer class than the best of the block first reached. So the
result is that of all pairs, while each row meets a few boxes per level.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusmill.operators.centroid import BROADCAST_NUMBERS
from corpusmill.runtime import materialise

# Classes per block, about: the root of their number between these.
LEAST_BLOCK, LARGEST_BLOCK = 16, 64
# Boxes inside a larger one, about; at most four times as many are the first that a row meets.
FAN = 64
# The columns along which classes are put into blocks, at most.
_SPLIT_DIMS = 4
# Copies of the first boxes in a join that cannot send them to every task, so that a model's rows are not one task's.
_SALTS = 16


def _listed(value: str) -> Column:
    return F.transform(F.sort_array(F.collect_list(F.struct("dim", value))), lambda v: v[value])


def scales(stats: DataFrame, by: list[str] = ()) -> DataFrame:
    """``(by.., dim, mean, scale)`` of all rows behind ``centroid.class_stats``, by aggregation alone."""
    by = list(by)
    total = stats.groupBy(*by, "dim").agg(
        F.try_divide(F.sum(F.col("c") * F.col("mean")), F.sum("c")).alias("__mean"), F.sum("c").alias("__c"))
    parts = _join(stats, total, [*by, "dim"])
    gap = F.col("mean") - F.col("__mean")
    square = F.try_divide(F.sum(F.col("m2") + F.col("c") * gap * gap), F.max("__c"))
    return parts.groupBy(*by, "dim").agg(F.max("__mean").alias("mean"),
                                         F.when(square > 0, F.sqrt(square)).otherwise(1.0).alias("scale"))


def _join(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    renamed = right.withColumnsRenamed({k: f"__j_{k}" for k in keys})
    return left.join(renamed, [F.col(k).eqNullSafe(F.col(f"__j_{k}")) for k in keys]).drop(*[f"__j_{k}" for k in keys])


def class_blocks(stats: DataFrame, known: DataFrame, size: int, by: list[str] = (), block: int | None = None) -> DataFrame:
    """``(by.., up1, up2, .., block, label, c0, c1, ..)`` from ``class_stats`` of ``size`` columns and their ``scales``.

    ``up1`` is the box around the block, ``up2`` the one around that. A row per class with its standardised mean. Classes without a value in some
    column have no distance and are left out. Blocks are cells between
    quantiles of the columns in which classes differ most; a cell with too many
    classes is dealt out by a hash of the label.
    """
    by = list(by)
    own = stats.groupBy(*by, "label", "dim").agg(F.try_divide(F.sum(F.col("c") * F.col("mean")), F.sum("c")).alias("__own"))
    cells = _join(own, known, [*by, "dim"]).withColumn("centroid", (F.col("__own") - F.col("mean")) / F.col("scale"))
    classes = materialise(cells.groupBy(*by, "label").agg(_listed("centroid").alias("centroid"))
                          .where(~F.exists("centroid", lambda c: c.isNull()) & (F.size("centroid") == size)), "classes")
    wide = lambda f: [f(F.get("centroid", F.lit(j))).alias(str(j)) for j in range(size)]
    per_key = classes.groupBy(*by).agg(F.count("*").alias("n"), *wide(F.stddev_pop))
    spread = per_key.agg(F.coalesce(F.max("n"), F.lit(0)).alias("n"), *[
        F.coalesce(F.max(str(j)), F.lit(0.0)).alias(str(j)) for j in range(size)]).first()
    most = spread["n"]
    block = block or min(max(math.isqrt(most), LEAST_BLOCK), LARGEST_BLOCK)
    dims = sorted(range(size), key=lambda j: -spread[str(j)])[:_SPLIT_DIMS]
    # Where classes hardly differ in a column, cuts there make no block smaller.
    dims = [j for j in dims if spread[str(j)] > spread[str(dims[0])] / 4] or dims[:1]
    parts = math.ceil(math.ceil(most / block) ** (1 / len(dims)))
    shares = [i / parts for i in range(1, parts)]
    at = F.array(F.lit(0))
    if shares:
        cuts = classes.agg(*[F.percentile_approx(F.get("centroid", F.lit(j)), shares).alias(str(j)) for j in dims]).first()
        at = F.array(*[_cuts_below(cuts[str(j)], F.get("centroid", F.lit(j))) for j in dims])
    width, wide_by, upper = 1, max(2, int(FAN ** (1 / len(dims)) + 1e-9)), []
    while math.ceil(parts / width) ** len(dims) > 4 * FAN:
        width *= wide_by
        upper.append(_coarser("__at", width))
    placed = classes.withColumn("__at", at).withColumn("__cell", F.concat_ws(":", F.col("__at").cast("array<string>")))
    placed = placed.withColumns({f"up{i}": up for i, up in enumerate(upper, 1)})
    counts = placed.groupBy(*by, "__cell").agg(F.ceil(F.count("*") / block).alias("__parts"))
    meets = [F.col(f"p.{c}").eqNullSafe(F.col(f"c.{c}")) for c in (*by, "__cell")]
    dealt = placed.alias("p").join(counts.alias("c"), meets).select(
        *[F.col(f"p.{c}").alias(c) for c in by], *[f"up{i}" for i in range(1, len(upper) + 1)], "label", "centroid",
        F.xxhash64(F.col("p.__cell"), F.pmod(F.xxhash64("label"), F.col("__parts"))).alias("block"))
    return materialise(dealt.select(*dealt.columns[:-3], "block", "label", *[F.get("centroid", F.lit(j)).alias(f"c{j}") for j in range(size)]),
                       "class-blocks")


def _coarser(at: str, width: int) -> Column:
    """A number for the larger cell, ``width`` cells wide, that the place ``at`` of a cell lies in."""
    return F.xxhash64(F.transform(at, lambda i: F.floor(i / width)))


def box_levels(classes: DataFrame, size: int, by: list[str] = ()) -> list[DataFrame]:
    """``(by.., box, id, low0, high0, ..)`` per level, from the largest boxes, which have no ``box`` around them, to the blocks.

    A box is put together from those inside it, so it covers them.
    """
    edges = [(f"{name}{j}", f) for j in range(size) for name, f in (("low", F.min), ("high", F.max))]
    ups = [c for c in classes.columns if c.startswith("up") and c not in by]
    inner = classes.select(*by, *ups, F.col("block").alias("id"), *[F.col(f"c{n[len(n.rstrip('0123456789')):]}").alias(n) for n, _ in edges])
    levels = []
    while True:
        boxes = materialise(inner.groupBy(*by, "id").agg(*[F.max(u).alias(u) for u in ups], *[f(n).alias(n) for n, f in edges]), "boxes")
        levels.insert(0, boxes.select(*by, *[F.col(u).alias("box") for u in ups[:1]], "id", *[n for n, _ in edges]))
        if not ups:
            return levels
        inner = boxes.drop("id").withColumnRenamed(ups.pop(0), "id")


def _cuts_below(cuts: list[float], value: Column) -> Column:
    return F.size(F.filter(F.array(*map(F.lit, cuts)), lambda c: c < value))


def _total(squares: list[Column]) -> Column:
    total = F.lit(0.0)
    for square in squares:
        total = total + square
    return total


def _distance(size: int) -> Column:
    return F.sqrt(_total([F.pow(F.col(f"__z{j}") - F.col(f"__c{j}"), 2) for j in range(size)]))


def _least(size: int) -> Column:
    """Least distance to any point of a box; a little less, so that rounding leaves no class out."""
    gaps = [F.greatest(F.col(f"__low{j}") - F.col(f"__z{j}"), F.col(f"__z{j}") - F.col(f"__high{j}"), F.lit(0.0))
            for j in range(size)]
    return F.sqrt(_total([F.pow(g, 2) for g in gaps])) * F.lit(1 - 1e-9)


def _meet(rows: DataFrame, right: DataFrame, keys: list[str], small: bool, salted: bool = False) -> DataFrame:
    """Equal keys side by side; ``right`` goes to every task if it is small, else it may be ``salted`` to deal a key's rows out."""
    right = right.withColumnsRenamed({c: f"__{c}" for c in right.columns if c not in keys})
    right = right.withColumnsRenamed({k: f"__j_{k}" for k in keys})
    on = F.lit(True)
    for k in keys:
        on = on & F.col(k).eqNullSafe(F.col(f"__j_{k}"))
    drop = [f"__j_{k}" for k in keys]
    if small or not salted:
        return rows.join(F.broadcast(right) if small else right, on).drop(*drop)
    rows = rows.withColumn("__salt", F.pmod(F.xxhash64(*[c for c in rows.columns if c.startswith("__z")]), F.lit(_SALTS)))
    right = right.withColumn("__j_salt", F.explode(F.sequence(F.lit(0), F.lit(_SALTS - 1))))
    return rows.join(right, on & (F.col("__salt") == F.col("__j_salt"))).drop(*drop, "__salt", "__j_salt")


def predict_many(df: DataFrame, stats: DataFrame, *, columns: list[str], key: list[str], by: list[str] = (),
                 out: str = "pred", block: int | None = None, numbers: int = BROADCAST_NUMBERS) -> DataFrame:
    """``df`` with the label of the nearest class of ``stats`` (``centroid.class_stats``), for any number of classes.

    ``key`` are columns that tell the rows apart, ``by`` those that say which
    model a row goes by. On a tie the first label counts; a row with a missing
    value, or without a class, gets null. Boxes and classes are sent to every
    task as long as they have at most ``numbers`` numbers.

    Rounds of plain columns: down to the block with the nearest boxes, the least
    distance in it, down again to all blocks whose boxes reach so far, and the
    classes within this distance in them.
    """
    by, size = list(by), len(columns)
    stats = materialise(stats, "class-stats")
    known = materialise(scales(stats, by), "scales")
    classes = class_blocks(stats, known, size, by, block)
    levels = [(boxes, boxes.count() * 2 * size <= numbers) for boxes in box_levels(classes, size, by)]
    few_classes = classes.count() * size <= numbers
    classes = classes.select(*by, "block", "label", *[f"c{j}" for j in range(size)])
    wide = known.groupBy(*by).agg(_listed("mean").alias("means"), _listed("scale").alias("scales"))
    scaled = _meet(df, wide, by, True)  # one row per model
    z = [((F.col(c).cast("double") - F.get("__means", F.lit(j))) / F.get("__scales", F.lit(j))).alias(f"__z{j}") for j, c in enumerate(columns)]
    # Written once: several rounds read the rows, and however small they are, all tasks take part in comparing them.
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = materialise(scaled.select(*dict.fromkeys([*key, *by]), *z).repartition(n, *key), "rows")
    rows = rows.where(" AND ".join(f"__z{j} IS NOT NULL" for j in range(size)))

    def inside(some: DataFrame, boxes: DataFrame, few: bool) -> DataFrame:
        nested = "box" in boxes.columns
        return _meet(some, boxes, [*by, "box"] if nested else by, few, salted=not nested).withColumnRenamed("__id", "__box")

    near = rows
    for boxes, few in levels:
        near = inside(near, boxes, few).groupBy(*rows.columns).agg(F.min_by("__box", _least(size)).alias("box"))
    near = near.withColumnRenamed("box", "block")
    reached = first = _meet(near, classes, [*by, "block"], few_classes).groupBy(*rows.columns).agg(F.min(_distance(size)).alias("__reach"))
    for boxes, few in levels:
        reached = inside(reached, boxes, few).where(_least(size) <= F.col("__reach")).select(*first.columns, F.col("__box").alias("box"))
    reached = reached.withColumnRenamed("box", "block")
    best = (_meet(reached, classes, [*by, "block"], few_classes).withColumn("__d", _distance(size))
            .where(F.col("__d") <= F.col("__reach")).groupBy(*key).agg(F.min(F.struct("__d", "__label")).alias("__best")))
    best = best.select(*[F.col(k).alias(f"__j_{k}") for k in key], F.col("__best")["__label"].alias(out))
    on = [F.col(k).eqNullSafe(F.col(f"__j_{k}")) for k in key]
    return df.join(best, on, "left").drop(*[f"__j_{k}" for k in key])
