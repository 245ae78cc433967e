"""Permutation importance of the features of a fitted model."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusmill.operators.evaluate import pair_counts, scores
from corpusmill.operators.ordering import order_key, with_rank


def permuted(test: DataFrame, *, id_col: str, columns: list[str], repeats: int, seed: int) -> DataFrame:
    """The test rows once per feature and repeat, that feature shuffled.

    ``(rank, feature, repeat, label.., columns..)``. The row in place i of a
    fixed order gets the value of the row in place i of the order that the
    cell's hash key gives, so a column keeps its values and only changes their
    rows. The rows are shuffled once by rank; only the narrow ``(cell, rank,
    value)`` triples are multiplied.
    """
    base = with_rank(test.withColumn("__key", order_key(F.col(id_col), "rows", seed)),
                     key="__key", ties=[id_col], out="rank").drop("__key")
    cells = F.array(*[F.struct(F.lit(i).alias("dim"), F.lit(c).alias("feature"), F.lit(r).alias("repeat"),
                               F.col(c).cast("double").alias("value"))
                      for i, c in enumerate(columns) for r in range(repeats)])
    donors = (test.select(id_col, F.explode(cells).alias("c")).select(id_col, "c.*")
              .withColumn("__key", order_key(F.col(id_col), F.col("feature"), F.col("repeat"), seed)))
    ranked = (with_rank(donors, by=["feature", "repeat"], key="__key", ties=[id_col], out="rank")
              .select("rank", "feature", "repeat", "value"))
    joined = ranked.join(base, "rank")
    return joined.withColumns({c: F.when(F.col("feature") == c, F.col("value"))
                               .otherwise(F.col(c).cast("double")) for c in columns}).drop("value")


def permutation_importance(test: DataFrame, predict: Callable[[DataFrame], DataFrame], *, id_col: str, label: str,
                           columns: list[str], repeats: int, seed: int) -> DataFrame:
    """``(feature, importance_mean, importance_sd)``: drop of macro-F1.

    ``predict`` adds a column ``pred``. All cells are predicted in one job; the
    scores of the cells come from counts.
    """
    cells = ["feature", "repeat"]
    keep = test.select(id_col, F.col(label).alias("truth"), *columns)
    shuffled = permuted(keep, id_col=id_col, columns=columns, repeats=repeats, seed=seed)
    after = scores(pair_counts(predict(shuffled), truth="truth", by=cells), cells)
    before = scores(pair_counts(predict(keep), truth="truth")).select(F.col("macro_f1").alias("intact"))
    drop = F.col("intact") - F.col("macro_f1")
    return (after.crossJoin(F.broadcast(before)).groupBy("feature")
            .agg(F.avg(drop).alias("importance_mean"), F.stddev_pop(drop).alias("importance_sd")))
