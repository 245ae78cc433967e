"""Comparing groups: counts, moments, medians, rank test, box statistics."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusmill.functions.stats import chi_square_tail
from corpusmill.operators.orderstats import long_form, quantiles, quantiles_of, rank_sums, value_counts
from corpusmill.params import order_table


def reindex(table: DataFrame, key: str, order: list[str], fill: dict | None = None) -> DataFrame:
    """One row per entry of ``order``; others are dropped, missing ones filled."""
    full = order_table(table.sparkSession, order, key).join(table, key, "left")
    return full.na.fill(fill) if fill else full


def distribution(df: DataFrame, *, by: str, member: str, order: list[str]) -> DataFrame:
    """``(ord, <by>, texts, authors)``: rows and distinct members per class."""
    counts = df.groupBy(by).agg(F.count("*").alias("texts"), F.count_distinct(F.col(member)).alias("authors"))
    return (reindex(counts, by, order, {"texts": 0, "authors": 0})
            .select("ord", by, "texts", "authors").orderBy("ord"))


def moments(df: DataFrame, *, by: str, columns: list[str]) -> DataFrame:
    """``(grp, feature, n, mean, sd)`` with the sample standard deviation."""
    aggs = []
    for i, c in enumerate(columns):
        x = F.col(c).cast("double")
        aggs += [F.count(x).alias(f"n{i}"), F.avg(x).alias(f"m{i}"), F.stddev_samp(x).alias(f"s{i}")]
    wide = df.where(F.col(by).isNotNull()).groupBy(F.col(by).alias("grp")).agg(*aggs)
    rows = F.array(*[F.struct(F.lit(c).alias("feature"), F.col(f"n{i}").alias("n"), F.col(f"m{i}").alias("mean"),
                              F.col(f"s{i}").alias("sd")) for i, c in enumerate(columns)])
    return wide.select("grp", F.explode(rows).alias("r")).select("grp", "r.*")


def summary(df: DataFrame, *, by: str, columns: list[str], order: list[str] | None = None) -> DataFrame:
    """``(grp, feature, n, mean, sd, median)``; with ``order`` every class."""
    middle = (quantiles(long_form(df, by, columns), [0.5])
              .select("grp", "feature", F.col("value").alias("median")))
    table = moments(df, by=by, columns=columns).join(middle, ["grp", "feature"], "left")
    if order is None:
        return table.select("grp", "feature", "n", "mean", "sd", "median")
    spark = df.sparkSession
    names = spark.createDataFrame([(c,) for c in columns], "feature string")
    domain = order_table(spark, order, "grp").crossJoin(F.broadcast(names))
    return (domain.join(table, ["grp", "feature"], "left").na.fill({"n": 0})
            .select("ord", "grp", "feature", "n", "mean", "sd", "median").orderBy("ord", "feature"))


def kruskal(df: DataFrame, *, by: str, columns: list[str], order: list[str] | None = None) -> DataFrame:
    """``(feature, n, h, p_value)``: rank test over the classes of ``order``, or over all.

    Corrected for ties; null when all values of a feature are equal. The
    degrees of freedom follow from the classes that have rows; the plan does
    not depend on their number.
    """
    rows = df.where(F.col(by).isNotNull() if order is None else F.col(by).isin(list(order)))
    per_class = rank_sums(long_form(rows, by, columns))
    n = F.col("n").cast("double")
    total = per_class.groupBy("feature").agg(
        F.sum("n").alias("n"), F.count("*").alias("classes"),
        F.sum(F.col("rank_sum") * F.col("rank_sum") / F.col("n")).alias("squares"),
        F.sum("tie_term").alias("ties"))
    raw = F.lit(12.0) / (n * (n + 1)) * F.col("squares") - 3 * (n + 1)
    fair = 1 - F.col("ties") / (n * n * n - n)
    scored = total.withColumn("h", F.when((F.col("n") > 1) & (fair > 0), F.try_divide(raw, fair)))
    return scored.select("feature", "n", "h", chi_square_tail(F.col("h"), F.col("classes") - 1).alias("p_value"))


def box_stats(df: DataFrame, *, by: str, columns: list[str]) -> DataFrame:
    """``(grp, feature, q1, median, q3, whisker_low, whisker_high)``.

    The whiskers end at the last value within 1.5 quartile ranges of the box,
    and at the box when there is none beyond it. The limits meet the ends of
    the value buckets first; single values are looked at only in the buckets
    that a limit cuts through.
    """
    counts = value_counts(long_form(df, by, columns))
    wide = quantiles_of(counts, [0.25, 0.5, 0.75]).groupBy("feature", "grp").agg(
        *[F.max(F.when(F.col("prob") == p, F.col("value"))).alias(name)
          for p, name in ((0.25, "q1"), (0.5, "median"), (0.75, "q3"))])
    reach = 1.5 * (F.col("q3") - F.col("q1"))
    limits = wide.withColumns({"low": F.col("q1") - reach, "high": F.col("q3") + reach})
    keys = ["feature", "grp", "bucket"]
    ends = (counts.groupBy(*keys).agg(F.min("value").alias("first"), F.max("value").alias("last"))
            .join(limits, ["feature", "grp"]))
    inside = ends.select("feature", "grp", F.when(F.col("first") >= F.col("low"), F.col("first")).alias("from"),
                         F.when(F.col("last") <= F.col("high"), F.col("last")).alias("to"))
    cut = ((F.col("first") < F.col("low")) & (F.col("last") >= F.col("low"))) | (
        (F.col("first") <= F.col("high")) & (F.col("last") > F.col("high")))
    value = F.col("value")
    near = counts.join(ends.where(cut).select(*keys, "low", "high"), keys).select(
        "feature", "grp", F.when(value >= F.col("low"), value).alias("from"),
        F.when(value <= F.col("high"), value).alias("to"))
    reached = inside.unionByName(near).groupBy("feature", "grp").agg(F.min("from").alias("from"), F.max("to").alias("to"))
    return wide.join(reached, ["feature", "grp"]).select(
        "grp", "feature", "q1", "median", "q3",
        F.least("from", "q1").alias("whisker_low"), F.greatest("to", "q3").alias("whisker_high"))
