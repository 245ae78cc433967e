"""Scores of predictions, all from one table of counts.

Predictions are aggregated to ``(keys.., truth, pred, n)`` first. That is the
only pass over the rows; every score below works on those counts.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusmill.operators import centroid as N
from corpusmill.operators.folds import with_group_folds, with_random_folds
from corpusmill.runtime import materialise

BASELINE, CENTROID = "majority baseline", "nearest centroid"
LOGISTIC, FOREST = "logistic regression", "random forest"
GROUPED, RANDOM = "author-disjoint", "random (leaky)"


def pair_counts(preds: DataFrame, *, truth: str, pred: str = "pred", by: list[str] = ()) -> DataFrame:
    return preds.groupBy(*by, F.col(truth).alias("truth"), F.col(pred).alias("pred")).agg(F.count("*").alias("n"))


def label_counts(pairs: DataFrame, by: list[str] = ()) -> DataFrame:
    """``(by.., label, hits, predicted, actual)`` for truth and prediction labels."""
    side = F.explode(F.array(
        F.struct(F.col("truth").alias("label"), F.col("n").alias("actual"), F.lit(0).cast("long").alias("predicted")),
        F.struct(F.col("pred").alias("label"), F.lit(0).cast("long").alias("actual"), F.col("n").alias("predicted"))))
    hit = F.when((F.col("truth") == F.col("pred")) & (F.col("s.actual") > 0), F.col("n")).otherwise(0)
    return (pairs.withColumn("s", side).withColumn("hit", hit)
            .groupBy(*by, F.col("s.label").alias("label"))
            .agg(F.sum("hit").alias("hits"), F.sum("s.predicted").alias("predicted"),
                 F.sum("s.actual").alias("actual")))


def scores(pairs: DataFrame, by: list[str] = ()) -> DataFrame:
    """``(by.., accuracy, macro_f1)``; F1 is averaged over the labels seen."""
    per_label = label_counts(pairs, by)
    f1 = 2.0 * F.col("hits") / (F.col("predicted") + F.col("actual"))
    aggs = [(F.sum("hits") / F.sum("actual")).alias("accuracy"), F.avg(f1).alias("macro_f1")]
    return per_label.groupBy(*by).agg(*aggs) if by else per_label.agg(*aggs)


def class_report(pairs: DataFrame, order: list[str], by: list[str] = ()) -> DataFrame:
    """``(by.., ord, label, precision, recall, f1, support)`` and the averages.

    The rows ``accuracy``, ``macro avg`` and ``weighted avg`` follow the
    classes; a quotient without a denominator is 0. The counts of one key are
    one row, at most an entry per label.
    """
    counts = F.map_from_entries(F.collect_list(F.struct("label", F.struct("hits", "predicted", "actual"))))
    one = label_counts(pairs, by).groupBy(*by).agg(counts.alias("m"))
    ratio = lambda a, b: F.coalesce(F.try_divide(a.cast("double"), b.cast("double")), F.lit(0.0))
    number = lambda label, name: F.coalesce(F.try_element_at("m", label)[name], F.lit(0).cast("long"))
    names = F.array(*[F.struct(F.lit(i).alias("ord"), F.lit(c).alias("label")) for i, c in enumerate(order)])
    one = one.withColumn("c", F.transform(names, lambda c: F.struct(
        c["ord"].alias("ord"), c["label"].alias("label"), number(c["label"], "hits").alias("hits"),
        number(c["label"], "predicted").alias("predicted"), number(c["label"], "actual").alias("support"))))
    one = one.withColumn("r", F.transform("c", lambda c: F.struct(
        c["ord"].alias("ord"), c["label"].alias("label"),
        ratio(c["hits"], c["predicted"]).alias("precision"), ratio(c["hits"], c["support"]).alias("recall"),
        ratio(2 * c["hits"], c["predicted"] + c["support"]).alias("f1"), c["support"].alias("support"))))
    whole = lambda get: F.aggregate("c", F.lit(0).cast("long"), lambda a, c: a + get(c))
    one = one.withColumns({"size": whole(lambda c: c["support"]), "right": whole(lambda c: c["hits"])})
    add = lambda get: F.aggregate("r", F.lit(0.0), lambda a, r: a + get(r))
    score = ("precision", "recall", "f1")
    line = lambda i, label, cols: F.struct(
        F.lit(len(order) + i).alias("ord"), F.lit(label).alias("label"),
        *[col.cast("double").alias(n) for n, col in zip(score, cols)], F.col("size").alias("support"))
    nothing = F.lit(None)
    averages = F.array(
        line(0, "accuracy", [nothing, nothing, ratio(F.col("right"), F.col("size"))]),
        line(1, "macro avg", [add(lambda r, n=n: r[n]) / len(order) for n in score]),
        line(2, "weighted avg", [ratio(add(lambda r, n=n: r[n] * r["support"]), F.col("size")) for n in score]))
    return one.select(*by, F.explode(F.concat("r", averages)).alias("row")).select(*by, "row.*")


def confusion(pairs: DataFrame, order: list[str], by: list[str] = ()) -> DataFrame:
    """``(by.., t_ord, truth, p_ord, pred, n, share)``; share of the truth row."""
    cells = F.map_from_entries(F.collect_list(F.struct(F.struct("truth", "pred"), "n")))
    one = pairs.groupBy(*by).agg(cells.alias("m"))
    count = lambda t, p: F.coalesce(F.try_element_at("m", F.struct(t.alias("truth"), p.alias("pred"))),
                                    F.lit(0).cast("long"))
    names = F.array(*[F.struct(F.lit(i).alias("ord"), F.lit(c).alias("label")) for i, c in enumerate(order)])
    grid = F.transform(names, lambda t: F.transform(names, lambda p: F.struct(
        t["ord"].alias("t_ord"), t["label"].alias("truth"), p["ord"].alias("p_ord"), p["label"].alias("pred"),
        count(t["label"], p["label"]).alias("n"))))
    rows = one.select(*by, F.explode(grid).alias("row"))
    total = F.aggregate("row", F.lit(0).cast("long"), lambda a, c: a + c["n"])
    cells = rows.withColumn("total", total).select(*by, "total", F.explode("row").alias("c"))
    share = F.coalesce(F.try_divide(F.col("c.n").cast("double"), F.col("total").cast("double")), F.lit(0.0))
    return cells.select(*by, "c.*", share.alias("share"))


def by_model(wide: DataFrame, columns: dict[str, str]) -> DataFrame:
    """Long form ``(.., model, pred)`` of one prediction column per model."""
    keep = [c for c in wide.columns if c not in columns.values()]
    named = F.array(*[F.struct(F.lit(m).alias("model"), F.col(c).alias("pred")) for m, c in columns.items()])
    return wide.select(*keep, F.explode(named).alias("__m")).select(*keep, "__m.*")


def pred_column(model: str) -> str:
    return "pred_" + model.replace(" ", "_")


def fold_predictions(train: DataFrame, *, label: str, columns: list[str], fold: str, folds: int) -> DataFrame:
    """``(truth, <fold>, model, pred)``: baseline and centroid, each row
    predicted by the models that did not see its fold."""
    stats = N.held_out(N.class_stats(train, label=label, columns=columns, by=[fold]), fold, folds)
    rows = train.select(fold, F.col(label).alias("truth"), *columns)
    both = N.predict_both(rows, N.model_row(stats, [fold]), columns=columns, by=[fold], baseline="base",
                          nearest="near").drop(*columns)
    return by_model(both, {BASELINE: "base", CENTROID: "near"})


def cv_scores(fold_scores: DataFrame, split: str | None) -> DataFrame:
    """Mean and population sd over the folds per model; with None also per ``split`` of the rows."""
    named = fold_scores if split is None else fold_scores.withColumn("split", F.lit(split))
    return named.groupBy("model", "split").agg(
        F.avg("accuracy").alias("accuracy_mean"), F.stddev_pop("accuracy").alias("accuracy_sd"),
        F.avg("macro_f1").alias("macro_f1_mean"), F.stddev_pop("macro_f1").alias("macro_f1_sd"),
    ).select(
        "model", "split", "accuracy_mean", "accuracy_sd", "macro_f1_mean", "macro_f1_sd")


def with_cv_folds(train: DataFrame, *, id_col: str, group: str, label: str, folds: int, seed: int,
                  grouped: bool) -> DataFrame:
    if grouped:
        return with_group_folds(train, group=group, label=label, folds=folds, seed=seed)
    return with_random_folds(train, id_col=id_col, label=label, folds=folds, seed=seed)


def cross_validate(train: DataFrame, *, id_col: str, group: str, label: str, columns: list[str], folds: int,
                   seed: int, grouped: bool = True) -> DataFrame:
    """Cross-validated scores of the baseline and the centroid model.

    The rows with their folds are written once, since fitting and predicting
    both read them.
    """
    marked = materialise(with_cv_folds(train, id_col=id_col, group=group, label=label, folds=folds, seed=seed,
                                       grouped=grouped).select("fold", label, *columns), "folds")
    return cross_validate_folds(marked, label=label, columns=columns, fold="fold", folds=folds, split=GROUPED if grouped else RANDOM)


def cross_validate_folds(marked: DataFrame, *, label: str, columns: list[str], fold: str, folds: int, split: str) -> DataFrame:
    """The same over written rows that know their fold."""
    preds = fold_predictions(marked, label=label, columns=columns, fold=fold, folds=folds)
    return cv_scores(scores(pair_counts(preds, truth="truth", by=["model", fold]), ["model", fold]), split)


def with_both_folds(train: DataFrame, *, id_col: str, group: str, label: str, columns: list[str], folds: int, seed: int) -> DataFrame:
    """``(label, columns.., <GROUPED>, <RANDOM>)``: the fold of either kind. Written once, as all models read it."""
    rows = with_random_folds(train.select(id_col, group, label, *columns), id_col=id_col, label=label, folds=folds, seed=seed, out=RANDOM)
    rows = with_group_folds(rows, group=group, label=label, folds=folds, seed=seed, out=GROUPED)
    return materialise(rows.select(label, *columns, GROUPED, RANDOM), "folds")


def best_model(cv: DataFrame) -> DataFrame:
    """``(model, macro_f1_mean)``: best author-disjoint model, no baseline."""
    return (cv.where((F.col("split") == GROUPED) & (F.col("model") != BASELINE))
            .orderBy(F.desc("macro_f1_mean"), "model").limit(1).select("model", "macro_f1_mean"))


def misclassified(predictions: DataFrame, *, truth: str, pred: str) -> DataFrame:
    """Rows whose prediction is not the truth; a missing prediction is wrong too."""
    return predictions.where(~F.col(truth).eqNullSafe(F.col(pred)))
