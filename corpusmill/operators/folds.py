"""Folds for training and testing, with and without disjoint authors."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusmill.operators.ordering import PREFIX, join_on, order_key, with_rank


def group_folds(df: DataFrame, *, group: str, label: str, folds: int, seed: int, prefix: int = PREFIX) -> DataFrame:
    """``(<group>, fold)``: every group in one fold, class shares similar.

    Each group counts for the class most of its rows have (the first by name
    on a tie, a missing label before all). Within a class the groups are dealt
    out from large to small, back and forth over the folds. Rows without a
    group are one group.
    """
    per_class = df.groupBy(group, label).agg(F.count("*").alias("n"))
    groups = per_class.groupBy(group).agg(
        F.min(F.struct((-F.col("n")).alias("n"), F.col(label).alias("label")))["label"].alias("__class"),
        (-F.sum("n")).alias("__size"))
    ranked = with_rank(groups.withColumn("__key", order_key(F.coalesce(F.col(group).cast("string"), F.lit("")), seed)),
                       by=["__class"], leading=["__size"], key="__key", ties=[group], out="__rank", prefix=prefix)
    turn = F.floor((F.col("__rank") - 1) / folds)
    place = F.pmod(F.col("__rank") - 1, F.lit(folds))
    return ranked.select(group, F.when(turn % 2 == 0, place).otherwise(folds - 1 - place).cast("int").alias("fold"))


def with_group_folds(df: DataFrame, *, group: str, label: str, folds: int, seed: int, out: str = "fold") -> DataFrame:
    """Add the fold of the row's group."""
    table = group_folds(df, group=group, label=label, folds=folds, seed=seed).withColumnRenamed("fold", out)
    return join_on(df, table, [group]).select(*df.columns, out)


def with_random_folds(df: DataFrame, *, id_col: str, label: str, folds: int, seed: int, out: str = "fold") -> DataFrame:
    """Add a fold that has the same class shares but ignores groups.

    Rows without a label are a class of their own; a null id is an empty one.
    """
    keyed = df.withColumn("__key", order_key(F.coalesce(F.col(id_col).cast("string"), F.lit("")), seed))
    ranked = with_rank(keyed, by=[label], key="__key", ties=[id_col], out="__rank")
    return ranked.select(*df.columns, F.pmod(F.col("__rank") - 1, F.lit(folds)).cast("int").alias(out))


def split(df: DataFrame, *, group: str, label: str, folds: int, seed: int) -> tuple[DataFrame, DataFrame]:
    """``(train, test)`` without a shared group; fold 0 is the test set."""
    marked = with_group_folds(df, group=group, label=label, folds=folds, seed=seed, out="__fold")
    return (marked.where(F.col("__fold") != 0).drop("__fold"), marked.where(F.col("__fold") == 0).drop("__fold"))


def shared_groups(train: DataFrame, test: DataFrame, *, group: str) -> DataFrame:
    """Groups on both sides; has no rows for a sound split."""
    return train.select(group).intersect(test.select(group))


def assert_no_leak(train: DataFrame, test: DataFrame, *, group: str) -> None:
    found = shared_groups(train, test, group=group).limit(3).collect()
    if found:
        raise ValueError(f"groups in both train and test: {[r[0] for r in found]}")


def split_sizes(train: DataFrame, test: DataFrame, *, group: str) -> DataFrame:
    """``(part, texts, authors)`` for the whole table, train and test."""
    rows = (train.select(F.lit("train").alias("part"), group)
            .unionByName(test.select(F.lit("test").alias("part"), group)))
    both = rows.withColumn("part", F.explode(F.array(F.lit("all"), F.col("part"))))
    return both.groupBy("part").agg(F.count("*").alias("texts"), F.count_distinct(F.col(group)).alias("authors"))
