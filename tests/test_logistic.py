"""Regressions fitted together against Spark's own learner and plain numpy."""

import random

import numpy as np
import pytest

from corpusmill.operators import logistic as L
from corpusmill.operators import models as M

COLUMNS = ["a", "b", "c"]


def rows(spark, seed=1, n=200, classes=("x", "y", "z")):
    rng = random.Random(seed)
    data = []
    for i in range(n):
        label = rng.choice(classes)
        at = classes.index(label)
        data.append((i, i % 4, label, rng.gauss(at, 1), rng.gauss(-at, 2) * 100, rng.random()))
    return spark.createDataFrame(data, "id long, fold int, label string, a double, b double, c double")


def test_same_as_single_fits(spark):
    df = rows(spark)
    specs = [L.Spec("all", None, tuple(COLUMNS)), L.Spec("two", 1, ("a", "c")), L.Spec("one", 3, ("b",))]
    for m in L.fit_many(df, specs, label="label", columns=COLUMNS, fold="fold"):
        part = df if m.spec.fold is None else df.where(f"fold <> {m.spec.fold}")
        own = M.fit_logistic(part, label="label", columns=list(m.spec.columns)).stages[-2]
        used = [COLUMNS.index(c) for c in m.spec.columns]
        assert m.weights[:, used] == pytest.approx(own.coefficientMatrix.toArray(), abs=1e-5)
        free = m.weights[:, -1] - m.weights[:, -1].mean()
        assert free == pytest.approx(own.interceptVector.toArray(), abs=1e-5)
        assert not m.weights[:, [j for j in range(3) if j not in used]].any()
        assert m.slope <= 1e-10 and m.passes < 12


def test_folds_predict_their_own_rows(spark):
    df = rows(spark, 2)
    models = L.fit_many(df, [L.Spec("all", f, tuple(COLUMNS)) for f in range(4)], label="label", columns=COLUMNS, fold="fold")
    got = L.predict_folds(df, models, columns=COLUMNS, fold="fold", keep=["id"]).collect()
    assert sorted(r["id"] for r in got) == list(range(200))
    for f in range(4):
        single = M.apply_model(M.fit_logistic(df.where(f"fold <> {f}"), label="label", columns=COLUMNS), df.where(f"fold = {f}"))
        assert {r["id"]: r["pred"] for r in single.collect()} == {r["id"]: r["pred"] for r in got if r["fold"] == f}


def test_a_class_missing_from_a_fold_missing_values_and_constants(spark):
    data = [(i, int(i >= 12), "rare" if i >= 12 else "xy"[i % 2], float(i % 5), None if i == 3 else float(i % 2), 7.0) for i in range(16)]
    df = spark.createDataFrame(data, "id long, fold int, label string, a double, b double, c double")
    models = L.fit_many(df, [L.Spec("m", 1, tuple(COLUMNS)), L.Spec("m", 0, tuple(COLUMNS))], label="label", columns=COLUMNS, fold="fold")
    assert models[0].present.tolist() == [False, True, True] and models[1].present.tolist() == [True, False, False]
    got = {r["id"]: r["pred"] for r in L.predict_folds(df, models, columns=COLUMNS, fold="fold", keep=["id"]).collect()}
    assert got[3] is None and {got[i] for i in range(12, 16)} <= {"x", "y"} and {got[i] for i in range(12) if i != 3} == {"rare"}
    assert np.isfinite(models[0].weights).all()
    with pytest.raises(ValueError):
        L.fit_many(df.where("false"), [L.Spec("m", None, ("a",))], label="label", columns=COLUMNS, fold="fold")
    with pytest.raises(RuntimeError):
        L.fit_many(df, [L.Spec("m", None, ("a",))], label="label", columns=COLUMNS, fold="fold", passes=1)
