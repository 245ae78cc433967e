"""Mixing sources to target weights by Efraimidis-Spirakis sampling.

Every document gets an exponential key divided by its quality weight. In the
order of these keys a source's documents fill its word budget: complete epochs
first, then the fraction that is left, the last document in part.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpusmill.runtime import materialise

WORD = r"[^\x20\x09-\x0D]+"


@dataclass(frozen=True)
class Mix:
    """Sources in order weigh ``weights`` in turn and share ``total`` times all words, at most ``most`` times their own."""

    weights: tuple[float, ...] = (3, 1, 2)
    total: float = 1.5
    most: int = 2
    seed: str = "mix"
    copies: int = 64


def prose_likeness(text: Column, size: Column) -> Column:
    """A quality weight in (0, 1]: highest where words have six characters on average."""
    mean = F.length(text) / F.greatest(size, F.lit(1))
    return 1 / (1 + F.abs(F.log(F.greatest(mean, F.lit(0.5)) / 6)))


def exponential_key(doc_id: Column, weight: Column, seed: str) -> Column:
    """``-ln(u) / weight`` with u from the md5 of the id: small keys come first."""
    bits = F.conv(F.substring(F.md5(F.concat(F.lit(seed), F.coalesce(doc_id.cast("string"), F.lit("")))), 1, 13), 16, 10)
    return -F.log((bits.cast("long") + 0.5) / float(1 << 52)) / weight


def sums_before(rows: DataFrame, order: list, value: str, name: str) -> DataFrame:
    """Rank and the sum of ``value`` over all rows before, in a total order, without one task for all.

    Rows are dealt out by ranges of ``order`` and written with their range;
    ranges are summed, and windows run inside ranges only.
    """
    n = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = materialise(rows.repartitionByRange(n, *order).withColumn("_range", F.spark_partition_id()), name)
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    sums = dealt.groupBy("_range").agg(F.sum(value).alias("_s"), F.count("*").alias("_n")).select(
        "_range", F.coalesce(F.sum("_s").over(before), F.lit(0)).alias("_s"),
        F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_n"))
    own = Window.partitionBy("_range").orderBy(*order)
    inside = own.rowsBetween(Window.unboundedPreceding, -1)
    placed = dealt.withColumns({"_own": F.coalesce(F.sum(value).over(inside), F.lit(0)), "_row": F.row_number().over(own)})
    return placed.join(F.broadcast(sums), "_range").select(  # one row per range
        *rows.columns, (F.col("_own") + F.col("_s")).alias("before"), (F.col("_row") + F.col("_n")).alias("rank"))


def targets(sources: DataFrame, p: Mix) -> DataFrame:
    """``source, source_size, target``: shares by weight, none above its cap, the excess shared out again.

    With sources by rising cap per weight, those up to some place are capped
    and the others get weight times one level; prefix sums give the level of
    every place, and the first that no later cap contradicts is the right one.
    """
    by_name = sums_before(sources, [F.col("source").isNull(), F.col("source")], "source_size", "sources")
    weight = F.element_at(F.array(*map(F.lit, map(float, p.weights))),
                          ((F.col("rank") - 1) % len(p.weights) + 1).cast("int"))
    weighed = by_name.select("source", "source_size", weight.alias("w"),
                             (p.most * F.col("source_size")).alias("cap")).withColumn("per", F.col("cap") / F.col("w"))
    order = [F.col("per"), F.col("source").isNull(), F.col("source")]
    caps = sums_before(weighed, order, "cap", "caps").withColumnRenamed("before", "cap_before")
    both = materialise(sums_before(caps.withColumnRenamed("rank", "place"), order, "w", "weights").select(
        "source", "source_size", "w", "cap", "per", "cap_before", F.col("before").alias("w_before"), "rank"), "levels")
    all_ = both.agg(F.sum("source_size").alias("s"), F.sum("w").alias("ws"))
    level = (p.total * F.col("s") - F.col("cap_before")) / (F.col("ws") - F.col("w_before"))
    found = both.crossJoin(all_).withColumn("level", level).where(F.col("per") >= F.col("level")).agg(
        F.min_by("level", "rank").alias("level"))
    return both.crossJoin(found).select(  # single rows
        "source", "source_size",
        F.least(F.col("cap").cast("double"), F.coalesce(F.col("w") * F.col("level"), F.col("cap").cast("double"))).alias("target"))


def mix(docs: DataFrame, p: Mix = Mix(), quality=prose_likeness) -> DataFrame:
    """``doc_id, text_key, source, size, source_size, target, taken`` of every row of ``docs``.

    Needs doc_id, text, source. ``taken`` are the words the mix takes from the
    row, repeats counted. A null text has size 0; null is a source of its own,
    the last. Ties of keys go by doc_id, then text. Repeated rows count each. A
    source without words has target 0. An empty table gives no rows.
    """
    size = F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long")
    sized = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("source").cast("string").alias("source"),
                        F.md5(F.coalesce(F.col("text"), F.lit(""))).alias("text_key"), size.alias("size"),
                        F.coalesce(F.col("text"), F.lit("")).alias("text"))
    keyed = sized.withColumn("key", exponential_key(F.col("doc_id"), quality(F.col("text"), F.col("size")), p.seed))
    keyed = materialise(keyed.select("doc_id", "text_key", "source", "size", "key"), "sized")
    sources = keyed.groupBy("source").agg(F.sum("size").alias("source_size"))
    goal = targets(sources, p)
    order = [F.col("source").isNull(), F.col("source"), F.col("key"), F.col("doc_id"), F.col("text_key")]
    placed = sums_before(keyed, order, "size", "placed").withColumnRenamed("before", "all_before")
    # Words before a source's first document, to count from there.
    start = placed.groupBy("source").agg(F.min("all_before").alias("start"))
    known = goal.join(start, goal["source"].eqNullSafe(start["source"])).select(
        goal["source"].alias("_source"), "source_size", "target", "start")
    # A source may have a third of all rows: they are dealt out to copies of its one row.
    known = known.withColumn("_copy", F.explode(F.sequence(F.lit(0), F.lit(p.copies - 1))))
    joined = placed.withColumn("_deal", F.pmod("rank", F.lit(p.copies)).cast("int")).join(
        known, F.col("source").eqNullSafe(F.col("_source")) & (F.col("_deal") == F.col("_copy")))
    aim, whole = F.round("target").cast("long"), F.greatest("source_size", F.lit(1))
    epochs = F.floor(aim / whole)
    rest = aim - epochs * F.col("source_size") - (F.col("all_before") - F.col("start"))
    taken = epochs * F.col("size") + F.greatest(F.lit(0), F.least("size", rest))
    return joined.select("doc_id", "text_key", "source", "size", "source_size", "target", taken.cast("long").alias("taken"))


def mixed(docs: DataFrame, p: Mix = Mix()) -> DataFrame:
    """``docs`` that the mix takes words from, with ``size, source_size, target, taken`` behind their columns.

    Rows that repeat doc_id and text are one row, with what is taken of all of them.
    """
    taken = mix(docs, p).groupBy("doc_id", "text_key").agg(
        F.sum("size").alias("size"), F.first("source_size").alias("source_size"), F.first("target").alias("target"),
        F.sum("taken").alias("taken")).where("taken > 0").withColumnsRenamed({"doc_id": "_id", "text_key": "_key"})
    keyed = docs.withColumn("_text", F.md5(F.coalesce(F.col("text"), F.lit(""))))
    joined = keyed.join(taken, F.col("doc_id").cast("long").eqNullSafe(F.col("_id")) & (F.col("_text") == F.col("_key")))
    return joined.dropDuplicates(["doc_id", "_text"]).select(*docs.columns, "size", "source_size", "target", "taken")
