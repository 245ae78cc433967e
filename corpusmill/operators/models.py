"""Logistic regression on Spark's own learner, random forests grown by `forest`, and what is done with either."""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from contextvars import copy_context

from pyspark.ml import PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.functions import vector_to_array
from pyspark.ml.feature import IndexToString, SQLTransformer, StringIndexer, VectorAssembler
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusmill.operators import forest as R
from corpusmill.operators import logistic as L
from corpusmill.operators.evaluate import FOREST, GROUPED, LOGISTIC, RANDOM, cv_scores, pair_counts, scores, with_cv_folds
from corpusmill.runtime import materialise

_PREFIX = "__z_"
# Tasks of a fit. Sums follow the layout of the rows, so it is fixed here and
# not taken from wherever the rows come from.
FIT_TASKS = 8


def laid_out(df: DataFrame, columns: list[str], tasks: int = FIT_TASKS) -> DataFrame:
    """The same rows dealt out and sorted by their own values: equal for any former partitioning."""
    key = F.xxhash64(*columns)
    return df.repartition(tasks, key).sortWithinPartitions(key, *columns)


def _scaler(df: DataFrame, columns: list[str]) -> tuple[SQLTransformer, int]:
    """Z-scores with the population sd (1 for a constant column), and the row count.

    Spark's own scaler uses the sample sd, which would change a penalised fit.
    """
    stats = df.agg(F.count("*").alias("n"), *[
        f(F.col(c).cast("double")).alias(f"{n}{i}") for i, c in enumerate(columns)
        for n, f in (("m", F.avg), ("s", F.stddev_pop))]).first()
    cols = ", ".join(f"(CAST(`{c}` AS DOUBLE) - ({stats[f'm{i}']!r}D)) / {(stats[f's{i}'] or 1.0)!r}D AS `{_PREFIX}{c}`"
                     for i, c in enumerate(columns))
    return SQLTransformer(statement=f"SELECT *, {cols} FROM __THIS__"), stats["n"]


def _train(train: DataFrame, label: str, columns: list[str], before: list, learner, tasks: int) -> PipelineModel:
    """Fit ``learner`` on indexed labels; the result needs no label column."""
    train = laid_out(train.select(label, *columns), [*columns, label], tasks)
    indexer = StringIndexer(inputCol=label, outputCol="__y", stringOrderType="alphabetAsc").fit(train)
    rows = indexer.transform(train)
    for stage in before:
        rows = stage.transform(rows)
    back = IndexToString(inputCol="__p", outputCol="pred", labels=indexer.labels)
    return PipelineModel(stages=[*before, learner.fit(rows), back])


_COLUMNS = dict(featuresCol="__x", labelCol="__y", predictionCol="__p", probabilityCol="__prob",
                rawPredictionCol="__raw")


def fit_logistic(train: DataFrame, *, label: str, columns: list[str], max_iter: int = 1000,
                 c: float = 1.0, tasks: int = FIT_TASKS) -> PipelineModel:
    """Multinomial regression on z-scores with an L2 penalty.

    The penalty of the whole likelihood is ``1 / (2 c)``; Spark averages the
    likelihood over the rows, so its weight is divided by their number.
    """
    scaler, n = _scaler(train, columns)
    assembler = VectorAssembler(inputCols=[_PREFIX + col for col in columns], outputCol="__x")
    learner = LogisticRegression(**_COLUMNS, family="multinomial", regParam=1.0 / (c * n), elasticNetParam=0.0,
                                 maxIter=max_iter, tol=1e-8, standardization=False)
    return _train(train, label, list(columns), [scaler, assembler], learner, tasks)


def fit_forest(train: DataFrame, *, label: str, columns: list[str], seed: int, trees: int = 300,
               min_leaf: int = 2) -> R.Forest:
    """A forest that depends on the rows and the seed alone."""
    return R.fit(train, label=label, columns=columns, seed=seed, trees=trees, min_leaf=min_leaf)


def apply_model(model: PipelineModel | R.Forest, rows: DataFrame) -> DataFrame:
    """``rows`` with a column ``pred``."""
    return model.transform(rows).select(*rows.columns, "pred")


def save_model(model: PipelineModel | R.Forest, path: str) -> None:
    if isinstance(model, R.Forest):
        model.save(path)
    else:
        model.write().overwrite().save(path)


def load_model(path: str) -> PipelineModel | R.Forest:
    spark = SparkSession.active()
    return R.load(spark, path) if R.is_forest(spark, path) else PipelineModel.load(path)


def coefficients(model: PipelineModel, columns: list[str], order: list[str]) -> DataFrame:
    """``(ord, label, feature, coefficient)`` of a fitted regression."""
    labels = model.stages[-1].getLabels()
    matrix = model.stages[-2].coefficientMatrix.toArray()
    rows = [(order.index(name) if name in order else None, name, feature, float(matrix[i][j]))
            for i, name in enumerate(labels) for j, feature in enumerate(columns)]
    return SparkSession.active().createDataFrame(rows, "ord int, label string, feature string, coefficient double")


def logistic_gradient(model: PipelineModel, train: DataFrame, *, label: str, columns: list[str],
                      c: float = 1.0) -> DataFrame:
    """``(label, feature, slope)``: the objective's slope in every coefficient at the fitted model.

    Rows times (probability - truth) times the standardised value, plus the
    penalty's part; all but 0 where the fit has converged.
    """
    labels = model.stages[-1].getLabels()
    weights = model.stages[-2].coefficientMatrix.toArray()
    scored = model.transform(train).withColumn("__p", vector_to_array("__prob")).withColumn("__v", vector_to_array("__x"))
    cells = [(i, j) for i in range(len(labels)) for j in range(len(columns))]
    sums = scored.agg(*[F.sum((F.col("__p")[i] - (F.col(label) == labels[i]).cast("double")) * F.col("__v")[j])
                        .alias(f"s{i}_{j}") for i, j in cells])
    rows = F.array(*[F.struct(F.lit(labels[i]).alias("label"), F.lit(columns[j]).alias("feature"),
                              (F.col(f"s{i}_{j}") + F.lit(float(weights[i][j]) / c)).alias("slope")) for i, j in cells])
    return sums.select(F.explode(rows).alias("r")).select("r.*")


def cross_validate(train: DataFrame, fits: dict, *, id_col: str, group: str, label: str, folds: int, seed: int,
                   grouped: bool, split: str, parallel: int = 8) -> DataFrame:
    """Cross-validated scores of models that take a fit per fold.

    ``fits`` maps a model name to a function from rows to a fitted model. The
    fits are independent jobs over one kept table and run a few at a time; each
    returns its counts of truth and prediction, at most classes squared.
    """
    spark = train.sparkSession
    rows = materialise(with_cv_folds(train, id_col=id_col, group=group, label=label, folds=folds, seed=seed,
                                     grouped=grouped), "folds")

    def one(job):
        name, fold = job
        model = fits[name](rows.where(F.col("fold") != fold))
        preds = apply_model(model, rows.where(F.col("fold") == fold))
        return [(name, fold, r["truth"], r["pred"], r["n"]) for r in pair_counts(preds, truth=label).collect()]

    # Each job in a copy of the context, so that what it writes is deleted with the rest.
    jobs = [(copy_context(), (n, f)) for n in fits for f in range(folds)]
    with ThreadPoolExecutor(parallel) as pool:
        found = [row for some in pool.map(lambda j: j[0].run(one, j[1]), jobs) for row in some]
    pairs = spark.createDataFrame(found, "model string, fold int, truth string, pred string, n bigint")
    return cv_scores(scores(pairs, ["model", "fold"]), split)


def forest_specs(folds: int) -> list[R.Spec]:
    """All rows, and all outside of each fold of either kind."""
    return [R.Spec(), *[R.Spec(split, f) for split in (GROUPED, RANDOM) for f in range(folds)]]


def cross_validate_forests(rows: DataFrame, forests: R.Forests, *, label: str) -> DataFrame:
    """Scores of forests of ``forest_specs`` on the folds they left out, by both kinds of folds."""
    preds = forests.predict_folds(rows, keep=[label])
    found = pair_counts(preds.withColumn("model", F.lit(FOREST)), truth=label, by=["split", "model", "fold"])
    return cv_scores(scores(found, ["split", "model", "fold"]), None)


def logistic_scores_by_fold(rows: DataFrame, sets: dict[str, list[str]], *, label: str, columns: list[str], folds: int,
                            max_iter: int = 1000) -> DataFrame:
    """``(model, fold, accuracy, macro_f1)`` of one regression per set of columns and fold, all fitted together.

    ``rows`` have a column ``fold`` and are written, as every pass reads them.
    """
    specs = [L.Spec(name, f, tuple(used)) for name, used in sets.items() for f in range(folds)]
    models = L.fit_many(rows, specs, label=label, columns=columns, fold="fold", passes=max_iter)
    preds = L.predict_folds(rows, models, columns=columns, fold="fold", keep=[label])
    return scores(pair_counts(preds, truth=label, by=["model", "fold"]), ["model", "fold"])


def cross_validate_logistic(train: DataFrame, *, id_col: str, group: str, label: str, columns: list[str], folds: int,
                            seed: int, grouped: bool, split: str, max_iter: int = 1000) -> DataFrame:
    """Cross-validated scores of the regression, its folds fitted together."""
    rows = materialise(with_cv_folds(train, id_col=id_col, group=group, label=label, folds=folds, seed=seed,
                                     grouped=grouped).select("fold", label, *columns), "folds")
    return cv_scores(logistic_scores_by_fold(rows, {LOGISTIC: columns}, label=label, columns=columns, folds=folds,
                                             max_iter=max_iter), split)


def feature_ablation(train: DataFrame, *, id_col: str, group: str, label: str, columns: list[str], folds: int,
                     seed: int, max_iter: int = 1000) -> DataFrame:
    """``(feature, macro_f1_only_this, macro_f1_without_this, drop_when_removed)``.

    The regressions of all sets of columns and all folds are fitted together.
    """
    rows = materialise(with_cv_folds(train, id_col=id_col, group=group, label=label, folds=folds, seed=seed,
                                     grouped=True).select("fold", label, *columns), "folds")
    return ablation_of_folds(rows, label=label, columns=columns, folds=folds, max_iter=max_iter)


def ablation_of_folds(rows: DataFrame, *, label: str, columns: list[str], folds: int, max_iter: int = 1000) -> DataFrame:
    """The same over written rows with a column ``fold``."""
    sets = {"all": list(columns)}
    for c in columns:
        sets["only:" + c] = [c]
        sets["without:" + c] = [o for o in columns if o != c]
    sets = {name: used for name, used in sets.items() if used}
    per_fold = logistic_scores_by_fold(rows, sets, label=label, columns=columns, folds=folds, max_iter=max_iter)
    table = cv_scores(per_fold, "")
    value = lambda name: F.max(F.when(F.col("model") == name, F.col("macro_f1_mean")))
    cells = table.agg(value("all").alias("whole"), F.array(*[
        F.struct(F.lit(c).alias("feature"), value("only:" + c).alias("macro_f1_only_this"),
                 value("without:" + c).alias("macro_f1_without_this")) for c in columns]).alias("r"))
    rows = cells.select("whole", F.explode("r").alias("r")).select("r.*", "whole")
    return rows.select("feature", "macro_f1_only_this", "macro_f1_without_this",
                       (F.col("whole") - F.col("macro_f1_without_this")).alias("drop_when_removed"))


def default_fits(columns: list[str], label: str, settings) -> dict:
    """The two learned models by name."""
    return {
        LOGISTIC: lambda rows: fit_logistic(rows, label=label, columns=columns, max_iter=settings.max_iter),
        FOREST: lambda rows: fit_forest(rows, label=label, columns=columns, seed=settings.seed,
                                        trees=settings.trees, min_leaf=settings.min_leaf),
    }
