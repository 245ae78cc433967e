"""Forests grown in parts against plain recursion, Spark's own learner and themselves in other layouts."""

import random

import numpy as np
import pytest
from pyspark.ml import Pipeline
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import StringIndexer, VectorAssembler
from pyspark.sql import functions as F

from corpusmill.operators import evaluate as E
from corpusmill.operators import forest as R
from corpusmill.operators import models as M
from corpusmill.params import Evaluation
from corpusmill.plans import jobs

COLUMNS = ["a", "b", "c", "d"]


def clouds(spark, n=3000, seed=1):
    rng = random.Random(seed)
    data = [(i, "xyz"[i % 3], *[rng.gauss(i % 3 * (j < 2), 1) for j in range(4)]) for i in range(n)]
    return spark.createDataFrame(data, "id long, label string, a double, b double, c double, d double")


def preds(model, rows):
    return {r["id"]: r["pred"] for r in M.apply_model(model, rows).collect()}


def plain(bins, y, w, tree, node, shape):
    """The subtree as nested tuples by the definition: (feature, cut, left, right) or a leaf's counts."""
    counts = np.bincount(y, w, shape.classes)
    leaf = tuple(counts.tolist())
    best = (sum(c * c for c in leaf) / max(sum(leaf), 1) * (1 + 1e-12), None)
    if sum(c > 0 for c in leaf) > 1 and node < 2**R.DEPTH:
        for f in shape.chosen(np.array([tree]), np.array([node]))[0].tolist():
            for cut in range(R.BINS - 1):
                left = bins[:, f] <= cut
                sides = [np.bincount(y[s], w[s], shape.classes) for s in (left, ~left)]
                if min(s.sum() for s in sides) >= shape.min_leaf:
                    score = sum((s * s).sum() / s.sum() for s in sides)
                    if score > best[0]:
                        best = (score, (f, cut))
    if best[1] is None:
        return leaf
    f, cut = best[1]
    left = bins[:, f] <= cut
    down = [plain(bins[s], y[s], w[s], tree, 2 * node + i, shape) for i, s in enumerate((left, ~left))]
    if all(not isinstance(d[-1], tuple) for d in down) and np.argmax(down[0]) == np.argmax(down[1]):
        return leaf
    return (f, cut, *down)


def nested(tree, i=0):
    feature, cut, child, counts = tree
    if feature[i] < 0:
        return tuple(counts[i].tolist())
    return (int(feature[i]), int(cut[i]), nested(tree, child[i]), nested(tree, child[i] + 1))


@pytest.mark.parametrize("seed", range(6))
def test_subtrees_are_those_of_plain_recursion(monkeypatch, seed):
    monkeypatch.setattr(R, "_AT_ONCE", 10_000 if seed % 2 else 100)
    rng = np.random.default_rng(seed)
    shape = R.Shape(4, 3, 1, seed, 1 + seed % 3)
    bins = rng.integers(0, (32, 32, 3, 1), (250, 4)).astype(np.uint8)
    y = np.where(rng.random(250) < 0.7, bins[:, 0] // 11, rng.integers(0, 3, 250)).astype(np.int64)
    w = rng.integers(1, 4, 250)
    assert nested(R.grown(bins, y, w, 5, 1, shape)) == plain(bins, y, w, 5, 1, shape)


def test_draws_are_those_of_a_bag():
    rng = np.random.default_rng(1)
    bins, y = rng.integers(0, 32, (20_000, 4)).astype(np.uint8), rng.integers(0, 3, 20_000)
    for n in (1, 4, 30, 100):
        drawn = R.bag(bins[:2000], y[:2000], np.full(2000, n), 20, 7)
        assert drawn.mean() == pytest.approx(n, rel=0.05) and drawn.var() == pytest.approx(n, rel=0.05)
    drawn = R.bag(bins, y, np.ones(20_000, int), 2, 7)
    assert abs(np.corrcoef(drawn.T)[0, 1]) < 0.05 and abs(np.corrcoef(drawn[:-1, 0], drawn[1:, 0])[0, 1]) < 0.05


def test_the_driver_holds_few_nodes_and_the_layout_does_not_matter(spark):
    rows = clouds(spark)
    train, test = rows.where("id % 5 <> 0"), rows.where("id % 5 = 0")
    whole = M.fit_forest(train, label="label", columns=COLUMNS, seed=3, trees=12)
    assert whole.parts.count() == len(whole.upper.tree) == 12  # one root per tree
    some = R.fit(train.repartition(7), label="label", columns=COLUMNS, seed=3, trees=12, local=150)
    sizes = [len(r["feature"]) // 4 for r in some.parts.collect()]
    assert len(some.upper.tree) < sum(sizes) / 10 and max(sizes) < 150 < len(some.upper.tree)
    want = preds(whole, test)
    assert preds(some, test.repartition(5)) == want and len(want) == 600
    assert preds(R.fit(train, label="label", columns=COLUMNS, seed=4, trees=12), test) != want


def test_one_layout_for_all_partitionings_and_any_number_of_tasks(spark):
    """Rows that come twice count twice wherever they lie, and tasks follow the session."""
    rows = clouds(spark, 500, 3)
    rows = rows.unionByName(rows.where("id % 3 = 0"))
    fits = [M.fit_forest(rows.repartition(n), label="label", columns=COLUMNS, seed=2, trees=6) for n in (1, 9)]
    assert preds(fits[0], rows) == preds(fits[1], rows)
    tasks = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        spark.conf.set("spark.sql.shuffle.partitions", "11")
        other = M.fit_forest(rows, label="label", columns=COLUMNS, seed=2, trees=30)
        assert len([f for f in other.parts.inputFiles()]) > 8
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", tasks)


def test_a_fit_takes_few_jobs(spark):
    """Not a job per level of the trees, of which cross-validation would pay for every fold."""
    rows, sc = clouds(spark), spark.sparkContext
    try:
        sc.setJobGroup("few-jobs", "")
        M.fit_forest(rows, label="label", columns=COLUMNS, seed=3, trees=8)
        assert 0 < len(sc.statusTracker().getJobIdsForGroup("few-jobs")) < 20
    finally:
        sc.setLocalProperty("spark.jobGroup.id", None)


def in_folds(spark):
    """Rows in two kinds of folds, some of them copies; one class is in one fold of the first kind alone."""
    rows = clouds(spark, 900, 5).selectExpr("id", "IF(id % 10 = 4, 'w', label) AS label", "ROUND(a, 1) AS a", "b", "c", "d",
                                            "IF(id % 10 = 4, 0, CAST(id % 7 % 3 AS INT)) AS one", "CAST(id % 4 AS INT) AS other")
    return rows.unionByName(rows.where("id % 5 = 0").selectExpr("id + 1000 AS id", "label", "a", "b", "c", "d", "one", "(other + 1) % 4 AS other"))


@pytest.mark.parametrize(("cut_rows", "local"), [(10_000, 16_384), (200, 120)])
def test_forests_grown_together_are_those_grown_alone(spark, tmp_path, monkeypatch, cut_rows, local):
    monkeypatch.setattr(R, "CUT_ROWS", cut_rows)
    rows = in_folds(spark).cache()
    specs = [R.Spec("one", 0), R.Spec(), R.Spec("one", 2), R.Spec("other", 3)]
    options = dict(label="label", columns=COLUMNS, seed=3, trees=6, local=local)
    forests = R.fit_many(rows, specs, **options)
    assert len(forests[0].labels) == 3 and len(forests[1].labels) == 4
    by_fold = {(r["split"], r["fold"], r["id"]): r["pred"] for r in forests.predict_folds(rows, keep=["id"]).collect()}
    want = {}
    for spec, forest in zip(specs, forests, strict=True):
        alone = R.fit(rows if spec.fold is None else rows.where(F.col(spec.fold) != spec.out), **options)
        expected = preds(alone, rows)
        assert (forest.cuts, forest.labels) == (alone.cuts, alone.labels) and preds(forest, rows) == expected
        if spec.fold is not None:
            want |= {(spec.fold, spec.out, r["id"]): expected[r["id"]] for r in rows.where(F.col(spec.fold) == spec.out).collect()}
    assert by_fold == want
    M.save_model(forests[2], str(tmp_path / "m"))
    assert preds(M.load_model(str(tmp_path / "m")), rows) == preds(forests[2], rows)
    rows.unpersist()


def test_a_missing_value_in_any_fold_is_an_error(spark):
    rows = in_folds(spark)
    for bad in (rows.withColumn("a", F.when(F.col("id") != 7, F.col("a"))), rows.withColumn("label", F.when(F.col("id") != 7, F.col("label"))),
                rows.withColumn("one", F.lit(0))):
        with pytest.raises(ValueError, match="a forest needs rows"):
            R.fit_many(bad, [R.Spec(), R.Spec("one", 0)], label="label", columns=COLUMNS, seed=3, trees=2)


def test_cross_validation_takes_as_many_jobs_for_more_folds(spark):
    """Forests of both kinds of folds are grown, and vote, together: jobs and tasks are not paid for every fold."""
    rows, tracker = clouds(spark, 600, 4).selectExpr("*", "id % 30 AS author"), spark.sparkContext.statusTracker()
    last = lambda: max(tracker.getJobIdsForGroup(None), default=-1)
    jobs_of = []
    for folds in (2, 6):
        ev = Evaluation(test_folds=3, cv_folds=folds, seed=1, repeats=1, trees=3)
        fits = {n: f for n, f in M.default_fits(COLUMNS, "label", ev).items() if n == E.FOREST}
        before = last()
        cv = jobs.all_cross_validation(rows, id_col="id", group="author", label="label", columns=COLUMNS, settings=ev, fits=fits).collect()
        jobs_of.append(last() - before)
        assert sorted((r["model"], r["split"]) for r in cv) == sorted((m, s) for m in (E.BASELINE, E.CENTROID, E.FOREST) for s in (E.GROUPED, E.RANDOM))
        assert all(r["macro_f1_mean"] > 0.5 for r in cv if r["model"] == E.FOREST)
    assert 0 < jobs_of[1] < 80 and jobs_of[1] <= jobs_of[0] + 10


def test_as_good_as_the_learner_of_spark(spark):
    rows = clouds(spark, 4000, 2)
    train, test = rows.where("id % 4 <> 0"), rows.where("id % 4 = 0")
    own = M.fit_forest(train, label="label", columns=COLUMNS, seed=1, trees=30)
    other = Pipeline(stages=[
        StringIndexer(inputCol="label", outputCol="y", stringOrderType="alphabetAsc"),
        VectorAssembler(inputCols=COLUMNS, outputCol="v"),
        RandomForestClassifier(labelCol="y", featuresCol="v", numTrees=30, minInstancesPerNode=2, maxDepth=30, seed=1,
                               featureSubsetStrategy="sqrt")]).fit(train)
    right = M.apply_model(own, test).where("label = pred").count(), other.transform(test).where("y = prediction").count()
    assert abs(right[0] - right[1]) < 40 and min(right) > 550
    nodes = sum(len(r["feature"]) // 4 for r in own.parts.collect())
    assert nodes == pytest.approx(other.stages[-1].totalNumNodes, rel=0.05)


def test_copies_one_class_and_missing_values(spark):
    """Copies are drawn as often as apart; a pure upper node, one class and rows of one value are leaves."""
    rows = spark.range(600).selectExpr("id", "IF(id % 2 = 0, 'p', 'q') AS label", "CAST(id % 2 AS DOUBLE) AS a", "7D AS b", "IF(id < 400, 1D, id) AS c")
    model = R.fit(rows, label="label", columns=["a", "b", "c"], seed=1, trees=9, local=3)
    assert preds(model, rows) == {i: "pq"[i % 2] for i in range(600)}
    one = M.fit_forest(rows.withColumn("label", F.lit("only")), label="label", columns=["a"], seed=1, trees=3)
    assert set(preds(one, rows).values()) == {"only"}
    flat = M.fit_forest(rows.where("id < 3"), label="label", columns=["b"], seed=1, trees=40)
    assert set(preds(flat, rows).values()) == {"p"}
    holes = rows.withColumn("a", F.when(F.col("id") != 5, F.col("a")))
    with pytest.raises(ValueError, match="missing"):
        M.fit_forest(holes, label="label", columns=["a"], seed=1, trees=3)
    with pytest.raises(Exception, match="no missing values"):
        preds(M.fit_forest(rows, label="label", columns=["a"], seed=1, trees=3), holes)


def test_saved_over_another_model_and_over_itself(spark, tmp_path):
    rows, path = clouds(spark, 400), str(tmp_path / "m")
    M.save_model(M.fit_logistic(rows, label="label", columns=COLUMNS), path)
    model = R.fit(rows, label="label", columns=COLUMNS, seed=1, trees=4, local=60)
    want = preds(model, rows)
    M.save_model(model, path)
    M.save_model(M.load_model(path), path)
    assert preds(M.load_model(path), rows) == want
    M.save_model(M.fit_logistic(rows, label="label", columns=COLUMNS), path)
    assert type(M.load_model(path)).__name__ == "PipelineModel"
