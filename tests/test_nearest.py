"""Nearest centroid among many classes against all pairs in plain Python."""

import math
import random

import pytest
from pyspark.sql import functions as F

from corpusmill.operators import centroid as N
from corpusmill.operators import nearest
from corpusmill.operators.nearest import predict_many

COLUMNS = ["x", "y", "w"]


def plain(train, rows):
    """Nearest class by the definition; rows and train are (model, label or id, x, y, w)."""
    out = {}
    for m in {r[0] for r in train}:
        own = [r for r in train if r[0] == m]
        values = [[r[2 + j] for r in own if r[2 + j] is not None] for j in range(3)]
        mean = [sum(v) / len(v) for v in values]
        scale = [math.sqrt(sum((x - a) ** 2 for x in v) / len(v)) or 1.0 for v, a in zip(values, mean, strict=True)]
        centroids = {}
        for label in {r[1] for r in own}:
            cols = [[r[2 + j] for r in own if r[1] == label and r[2 + j] is not None] for j in range(3)]
            if all(cols):
                centroids[label] = [(sum(c) / len(c) - a) / s for c, a, s in zip(cols, mean, scale, strict=True)]
        for r in rows:
            if r[0] == m:
                z = [None if v is None else (v - a) / s for v, a, s in zip(r[2:], mean, scale, strict=True)]
                out[r[:2]] = None if None in z else min((round(math.dist(z, c), 9), lab) for lab, c in centroids.items())[1]
    return out


def fixture(seed, classes, per):
    rng = random.Random(seed)
    train = []
    for m in ("a", "b"):
        for k in range(classes):
            at = [rng.gauss(0, 1) * 10 ** (rng.random() * 2) for _ in range(3)]
            for _ in range(per):
                train.append((m, f"c{k:04d}", *[None if rng.random() < 0.02 else a + rng.gauss(0, 0.1) for a in at]))
    rows = [(m, i, *[rng.gauss(0, 1) * 10 ** (rng.random() * 2) for _ in range(3)]) for m in ("a", "b") for i in range(150)]
    return train, [*rows, ("a", 900, None, 1.0, 1.0), ("b", 901, 1e6, -1e6, 0.0)]


@pytest.mark.parametrize("numbers", [0, 10**6])
def test_against_all_pairs_by_model(spark, numbers):
    train, rows = fixture(1, 90, 2)
    t = spark.createDataFrame(train, "m string, label string, x double, y double, w double")
    r = spark.createDataFrame([*rows, ("none", 1, 1.0, 1.0, 1.0)], "m string, id long, x double, y double, w double")
    stats = N.class_stats(t, label="label", columns=COLUMNS, by=["m"])
    got = predict_many(r, stats, columns=COLUMNS, key=["m", "id"], by=["m"], block=8, numbers=numbers)
    assert got.columns == ["m", "id", "x", "y", "w", "pred"]
    assert {(g["m"], g["id"]): g["pred"] for g in got.collect()} == {**plain(train, rows), ("none", 1): None}


def test_same_as_the_model_of_few_classes_and_ties(spark):
    train, rows = fixture(2, 40, 3)
    t = spark.createDataFrame(train, "m string, label string, x double, y double, w double").where("m = 'a'")
    # Classes of the same values: the first by name counts.
    t = t.unionByName(t.withColumn("label", F.concat(F.lit("z"), "label")))
    r = spark.createDataFrame([r[1:] for r in rows if r[0] == "a"], "id long, x double, y double, w double")
    few = N.predict(r, N.fit(t, label="label", columns=COLUMNS), columns=COLUMNS)
    stats = N.class_stats(t, label="label", columns=COLUMNS)
    for block in (None, 4):
        many = predict_many(r, stats, columns=COLUMNS, key=["id"], block=block)
        assert {g["id"]: g["pred"] for g in many.collect()} == {g["id"]: g["pred"] for g in few.collect()}


def test_a_row_meets_few_classes_and_none_without_classes(spark):
    train, rows = fixture(3, 60, 1)
    t = spark.createDataFrame(train, "m string, label string, x double, y double, w double")
    r = spark.createDataFrame([r[1:] for r in rows], "id long, x double, y double, w double").dropDuplicates(["id"])
    none = predict_many(r, N.class_stats(t.where("false"), label="label", columns=COLUMNS), columns=COLUMNS, key=["id"])
    assert {g["pred"] for g in none.collect()} == {None}
    assert predict_many(r.where("false"), N.class_stats(t, label="label", columns=COLUMNS), columns=COLUMNS, key=["id"]).collect() == []
    plan = predict_many(r, N.class_stats(t, label="label", columns=COLUMNS), columns=COLUMNS,
                        key=["id"])._jdf.queryExecution().executedPlan().toString()
    assert "collect_list" not in plan and "Python" not in plan


@pytest.mark.parametrize("numbers", [0, 10**6])
def test_boxes_within_boxes(spark, monkeypatch, numbers):
    """With many blocks a row meets a few boxes of every level, and its class is still the nearest of all."""
    monkeypatch.setattr(nearest, "FAN", 3)
    train, rows = fixture(5, 150, 1)
    t = spark.createDataFrame(train, "m string, label string, x double, y double, w double")
    r = spark.createDataFrame(rows, "m string, id long, x double, y double, w double")
    stats = N.class_stats(t, label="label", columns=COLUMNS, by=["m"])
    classes = nearest.class_blocks(stats, nearest.scales(stats, ["m"]), 3, ["m"], 2)
    levels = nearest.box_levels(classes, 3, ["m"])
    counts = [b.count() for b in levels]
    assert len(levels) >= 3 and counts[0] <= 2 * 4 * 3 and counts == sorted(counts) and counts[-1] > 60
    for outer, inner in zip(levels, levels[1:]):
        lost = inner.join(outer, (inner["m"] == outer["m"]) & (inner["box"] == outer["id"]) & (outer["low0"] <= inner["low0"])
                          & (inner["high2"] <= outer["high2"]), "left_anti")
        assert lost.count() == 0
    got = predict_many(r, stats, columns=COLUMNS, key=["m", "id"], by=["m"], block=2, numbers=numbers)
    assert {(g["m"], g["id"]): g["pred"] for g in got.collect()} == plain(train, rows)
