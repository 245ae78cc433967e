"""Exact ranks and quantiles of numeric columns without a single hot task.

Rows become counts of distinct values first, so a value that fills a third of
the table is one row. The values are then cut into buckets at split points that
a hash picks among them: the choice is uniform over the distinct values and the
same on every run, also when a lost task is computed again. Windows run inside
buckets; across buckets only their totals are summed up.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

# Split points per feature. The broadcast side of the bucket join holds one
# array of at most this many doubles for every feature column.
SPLITS = 512


def long_form(df: DataFrame, by: str, columns: list[str]) -> DataFrame:
    """``(feature, grp, value)``, one row per input row and column, no nulls."""
    cells = F.array(*[F.struct(F.lit(c).alias("feature"), F.col(c).cast("double").alias("value"))
                      for c in columns])
    return (df.select(F.col(by).alias("grp"), F.explode(cells).alias("__c"))
            .select(F.col("__c.feature").alias("feature"), "grp", F.col("__c.value").alias("value"))
            .where(F.col("value").isNotNull() & F.col("grp").isNotNull()))


def value_counts(long: DataFrame, splits: int = SPLITS) -> DataFrame:
    """``(feature, grp, value, n, bucket)``: counts of distinct values."""
    counts = long.groupBy("feature", "grp", "value").agg(F.count("*").alias("n"))
    digest = F.xxhash64("value")
    # The filter keeps every row; it keeps the count column in this branch too,
    # so that both branches share one shuffle of the counts.
    picks = (counts.where(F.col("n") > 0).groupBy("feature", F.pmod(digest, F.lit(splits)).alias("cell"))
             .agg(F.min_by("value", digest).alias("pick"))
             .groupBy("feature").agg(F.sort_array(F.collect_set("pick")).alias("picks")))
    out = counts.join(F.broadcast(picks), "feature").withColumn("bucket", F.lit(0))
    # Binary search: the number of split points below the value. One projection
    # per step keeps each of them a plain array access in generated code.
    step = 1 << (splits.bit_length() - 1)
    while step:
        below = F.get("picks", F.col("bucket") + (step - 1)) < F.col("value")
        out = out.withColumn("bucket", F.col("bucket") + F.when(below, step).otherwise(0))
        step >>= 1
    return out.drop("picks")


def _ranked_in_bucket(counts: DataFrame) -> DataFrame:
    """Add ``ties`` (rows with this value) and ``mid`` (mid-rank in the bucket)."""
    upto = (Window.partitionBy("feature", "bucket").orderBy("value")
            .rangeBetween(Window.unboundedPreceding, Window.currentRow))
    same = Window.partitionBy("feature", "bucket", "value")
    ties = F.sum("n").over(same)
    return (counts.withColumns({"ties": ties, "__upto": F.sum("n").over(upto)})
            .withColumn("mid", F.col("__upto") - F.col("ties") + (F.col("ties") + 1) / 2.0)
            .drop("__upto"))


def average_ranks(long: DataFrame) -> DataFrame:
    """``(feature, grp, value, n, ties, mid_rank)`` over all groups together."""
    ranked = _ranked_in_bucket(value_counts(long))
    earlier = Window.partitionBy("feature").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (ranked.groupBy("feature", "bucket").agg(F.sum("n").alias("m"))
               .select("feature", "bucket", F.coalesce(F.sum("m").over(earlier), F.lit(0)).alias("before")))
    return (ranked.join(offsets, ["feature", "bucket"])
            .select("feature", "grp", "value", "n", "ties",
                    (F.col("mid") + F.col("before")).alias("mid_rank")))


def rank_sums(long: DataFrame) -> DataFrame:
    """``(feature, grp, n, rank_sum, tie_term)`` with Σ(t²-1) over the rows.

    The places of the buckets are added to the sums, not to the rows, so the
    values are shuffled once. They come from the buckets' totals: a window over
    buckets and groups would put all groups of a feature into one task.
    """
    counts = value_counts(long)
    cells = _ranked_in_bucket(counts).groupBy("feature", "bucket", "grp").agg(
        F.sum("n").alias("m"),
        F.sum(F.col("n") * F.col("mid")).alias("local"),
        F.sum(F.col("n") * (F.col("ties").cast("double") * F.col("ties") - 1.0)).alias("tie"))
    earlier = Window.partitionBy("feature").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (counts.groupBy("feature", "bucket").agg(F.sum("n").alias("__m"))
               .select("feature", "bucket", F.coalesce(F.sum("__m").over(earlier), F.lit(0)).alias("before")))
    # At most a row per feature and bucket.
    placed = cells.join(F.broadcast(offsets), ["feature", "bucket"])
    return placed.groupBy("feature", "grp").agg(
        F.sum("m").alias("n"),
        F.sum(F.col("local") + F.col("m") * F.col("before")).alias("rank_sum"),
        F.sum("tie").alias("tie_term"))


def quantiles(long: DataFrame, probs: list[float]) -> DataFrame:
    """``(feature, grp, prob, value)``: exact quantiles, linear between ranks."""
    return quantiles_of(value_counts(long), probs)


def quantiles_of(counts: DataFrame, probs: list[float]) -> DataFrame:
    """The same from counted values.

    The totals of the buckets tell which bucket holds each wanted rank; only
    these buckets are ordered.
    """
    keys = ["feature", "grp", "bucket"]
    whole = Window.partitionBy("feature", "grp")
    earlier = whole.orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    totals = (counts.groupBy(*keys).agg(F.sum("n").alias("m"))
              .withColumns({"before": F.coalesce(F.sum("m").over(earlier), F.lit(0)),
                            "size": F.sum("m").over(whole)}))

    wanted = []
    for p in probs:
        place = F.lit(float(p)) * (F.col("size") - 1)
        frac = place - F.floor(place)
        for rank, weight in ((F.floor(place), 1.0 - frac), (F.ceil(place), frac)):
            wanted.append(F.struct(F.lit(float(p)).alias("prob"), rank.cast("long").alias("rank"),
                                   weight.alias("weight")))
    inside = lambda w: (w["rank"] >= F.col("before")) & (w["rank"] < F.col("before") + F.col("m"))
    targets = (totals.withColumn("wanted", F.filter(F.array(*wanted), inside))
               .where(F.size("wanted") > 0).select(*keys, "before", "wanted"))

    upto = Window.partitionBy(*keys).orderBy("value").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    placed = (counts.join(targets, keys)
              .withColumn("last", F.col("before") + F.sum("n").over(upto)))
    hit = lambda w: (w["rank"] >= F.col("last") - F.col("n")) & (w["rank"] < F.col("last"))
    found = placed.select("feature", "grp", "value", F.explode(F.filter("wanted", hit)).alias("w"))
    return (found.groupBy("feature", "grp", F.col("w.prob").alias("prob"))
            .agg(F.sum(F.col("value") * F.col("w.weight")).alias("value")))
