"""Majority baseline and nearest centroid, fitted from group statistics.

One pass over the rows yields count, mean and sum of squared deviations per
class and column, and per fold when there are folds, as rows. Models are put
together from these few numbers. The training part of a fold is the other
folds' statistics put together, so cross-validation reads the rows once instead
of once per fold. A missing value is left out of its column's statistics; a row
with a missing value has no nearest class.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpusmill.functions.vectors import euclidean, pack, standardise
from corpusmill.runtime import materialise

# A model of up to this many numbers (8 bytes each) is sent to every task.
BROADCAST_NUMBERS = 16_000_000


def class_stats(df: DataFrame, *, label: str, columns: list[str], by: list[str] = ()) -> DataFrame:
    """``(by.., label, dim, n, c, mean, m2)``: rows, values, their mean and squared deviations."""
    cells = df.select(*by, F.col(label).alias("label"), F.posexplode(pack(columns)).alias("dim", "x"))
    return cells.groupBy(*by, "label", "dim").agg(
        F.count("*").alias("n"), F.count("x").alias("c"), F.coalesce(F.avg("x"), F.lit(0.0)).alias("mean"),
        F.coalesce(F.var_pop("x") * F.count("x"), F.lit(0.0)).alias("m2"))


def held_out(stats: DataFrame, fold: str, folds: int) -> DataFrame:
    """Statistics of the training part of every fold: all the other folds."""
    others = F.filter(F.sequence(F.lit(0), F.lit(folds - 1)), lambda f: f != F.col("part"))
    return stats.withColumnRenamed(fold, "part").withColumn(fold, F.explode(others))


def model_rows(stats: DataFrame, by: list[str] = ()) -> DataFrame:
    """``(by.., label, dim, n, mean, scale, centroid)``: one row per class and column.

    Mean and scale are those of all rows (population standard deviation, 1 for
    a constant column); a class mean is standardised with them, which equals
    the mean of the standardised rows. A class may come in several parts.
    """
    by = list(by)
    column = Window.partitionBy(*by, "dim")
    mean = F.try_divide(F.sum(F.col("c") * F.col("mean")).over(column), F.sum("c").over(column))
    parts = stats.withColumn("__mean", mean)
    gap = F.col("mean") - F.col("__mean")
    square = F.try_divide(F.sum(F.col("m2") + F.col("c") * gap * gap).over(column), F.sum("c").over(column))
    parts = parts.withColumn("__scale", F.when(square > 0, F.sqrt(square)).otherwise(1.0))
    rows = parts.groupBy(*by, "label", "dim").agg(
        F.sum("n").alias("n"), F.max("__mean").alias("mean"), F.max("__scale").alias("scale"),
        F.try_divide(F.sum(F.col("c") * F.col("mean")), F.sum("c")).alias("__own"))
    return rows.select(*by, "label", "dim", "n", "mean", "scale",
                       ((F.col("__own") - F.col("mean")) / F.col("scale")).alias("centroid"))


def model_row(stats: DataFrame, by: list[str] = ()) -> DataFrame:
    """``(by.., mean, scale, classes)``: one written row per key, to put next to rows.

    ``classes`` is an array of ``(label, n, centroid)`` in label order. It is
    put together from ``model_rows`` class by class, so its work grows with
    classes times columns. Without rows there is no model.
    """
    by = list(by)
    listed = lambda *cols: F.sort_array(F.collect_list(F.struct("dim", *cols)))
    per_class = model_rows(stats, by).groupBy(*by, "label").agg(
        F.max("n").alias("n"), listed("centroid", "mean", "scale").alias("v"))
    one = per_class.groupBy(*by).agg(
        F.any_value(F.transform("v", lambda v: v["mean"])).alias("mean"),
        F.any_value(F.transform("v", lambda v: v["scale"])).alias("scale"),
        F.sort_array(F.collect_list(F.struct("label", "n", F.transform("v", lambda v: v["centroid"]).alias("centroid"))))
        .alias("classes"))
    return materialise(one.where(F.size("classes") > 0), "model")


def fit(df: DataFrame, *, label: str, columns: list[str]) -> DataFrame:
    """The model of all rows, in one row."""
    return model_row(class_stats(df, label=label, columns=columns))


def model_table(model: DataFrame) -> DataFrame:
    """``(label, dim, n, mean, scale, centroid)``: the model in long form."""
    cells = model.select("mean", "scale", F.explode("classes").alias("c"))
    return cells.select("c.label", "c.n", F.posexplode(F.arrays_zip(
        F.col("mean"), F.col("scale"), F.col("c.centroid").alias("centroid"))).alias("dim", "v")).select(
        "label", "dim", "n", "v.mean", "v.scale", "v.centroid")


def _joined(df: DataFrame, model: DataFrame, by: list[str]) -> DataFrame:
    """Rows next to their model; it is sent to every task up to a size, and met by a plain join beyond."""
    small = model.withColumnsRenamed({"mean": "__mean", "scale": "__scale", "classes": "__classes"})
    numbers = model.agg(F.coalesce(F.sum(F.size("classes").cast("long") * F.size("mean")), F.lit(0))).first()[0]
    if numbers <= BROADCAST_NUMBERS:
        small = F.broadcast(small)
    return df.join(small, by) if by else df.crossJoin(small)


def with_standardised(df: DataFrame, model: DataFrame, *, columns: list[str], out: str = "z") -> DataFrame:
    """Add the standardised columns as an array."""
    z = standardise(pack(columns), F.col("__mean"), F.col("__scale"))
    return _joined(df, model, []).withColumn(out, z).select(*df.columns, out)


def with_distances(df: DataFrame, model: DataFrame, *, columns: list[str], by: list[str] = (),
                   out: str = "distances") -> DataFrame:
    """Add the distance to every class as an array of ``(dist, label)``."""
    rows = _joined(df, model, list(by)).withColumn(
        "__z", standardise(pack(columns), F.col("__mean"), F.col("__scale")))
    each = F.transform("__classes", lambda c: F.struct(
        euclidean(F.col("__z"), c["centroid"]).alias("dist"), c["label"].alias("label")))
    return rows.withColumn(out, each).select(*df.columns, out)


def predict(df: DataFrame, model: DataFrame, *, columns: list[str], by: list[str] = (), out: str = "pred") -> DataFrame:
    """Add the label of the nearest centroid, the first by name on a tie; null where a value is missing."""
    near = with_distances(df, model, columns=columns, by=by, out="__d")
    return near.withColumn(out, _nearest(F.col("__d"))).drop("__d")


def _nearest(distances: Column) -> Column:
    """The label at the least distance. A class without a value in some column has no distance."""
    return F.array_min(F.filter(distances, lambda d: d["dist"].isNotNull()))["label"]


def _most_frequent() -> Column:
    ranked = F.transform("__classes", lambda c: F.struct((-c["n"]).alias("n"), c["label"].alias("label")))
    return F.array_min(ranked)["label"]


def majority(model: DataFrame, by: list[str] = ()) -> DataFrame:
    """``(by.., pred)``: the most frequent class, the first by name on a tie."""
    return model.withColumnRenamed("classes", "__classes").select(*by, _most_frequent().alias("pred"))


def predict_both(df: DataFrame, model: DataFrame, *, columns: list[str], by: list[str] = (), baseline: str,
                 nearest: str) -> DataFrame:
    """Add the labels of the baseline and of the nearest centroid in one go."""
    rows = _joined(df, model, list(by)).withColumn(
        "__z", standardise(pack(columns), F.col("__mean"), F.col("__scale")))
    near = _nearest(F.transform("__classes", lambda c: F.struct(
        euclidean(F.col("__z"), c["centroid"]).alias("dist"), c["label"].alias("label"))))
    return rows.withColumns({baseline: _most_frequent(), nearest: near}).select(*df.columns, baseline, nearest)
