import math
import random
import re
import statistics
from collections import Counter

import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from corpusmill.functions.stats import chi_square_tail
from corpusmill.operators import centroid as N
from corpusmill.operators import evaluate as E
from corpusmill.operators import groups as G
from corpusmill.operators import models as M
from corpusmill.operators import orderstats as O
from corpusmill.operators.importance import permutation_importance, permuted
from corpusmill.operators.orderstats import average_ranks, long_form, quantiles


def test_distribution(spark):
    rows = spark.createDataFrame([("A", "Moderne"), ("A", "Moderne"), ("B", "Moderne"), ("C", "Goethezeit"), ("D", "x")],
                                 "author string, epoch string")
    got = [tuple(r) for r in G.distribution(rows, by="epoch", member="author",
                                            order=["Goethezeit", "Realismus", "Moderne"]).collect()]
    assert got == [(0, "Goethezeit", 1, 1), (1, "Realismus", 0, 0), (2, "Moderne", 3, 2)]


# Published quantiles of the distribution: x, degrees of freedom, upper tail.
@pytest.mark.parametrize("x, df, p", [
    (3.841459, 1, 0.05), (5.991465, 2, 0.05), (7.814728, 3, 0.05), (9.487729, 4, 0.05), (11.070498, 5, 0.05),
    (6.634897, 1, 0.01), (13.276704, 4, 0.01), (21.665994, 9, 0.01), (0.003932, 1, 0.95), (3.325113, 9, 0.95),
    (0.0, 3, 1.0), (0.0, 2, 1.0)])
def test_chi_square_tail(one, x, df, p):
    assert one(lambda v: chi_square_tail(v, df), x, schema="double") == pytest.approx(p, abs=1e-6)


def test_chi_square_tail_far_out(one):
    # One degree of freedom: the tail is the complementary error function.
    assert one(lambda v: chi_square_tail(v, 1), 80.0, schema="double") == pytest.approx(
        math.erfc(math.sqrt(40)), rel=1e-9)
    assert one(lambda v: chi_square_tail(v, 2), None, schema="double") is None


@pytest.fixture(scope="module")
def skewed(spark):
    """A third of the rows share one value; heavy tails; one group of one row."""
    rng = random.Random(8)
    rows = []
    for i in range(4000):
        x = 7.0 if rng.random() < 0.34 else round(math.exp(rng.gauss(0, 4)), 3) * rng.choice([-1, 1])
        rows.append((("g%d" % min(rng.randint(0, 5), 2)), x, float(rng.randint(0, 9))))
    rows.append(("solo", 1.5, 2.0))
    return rows


@pytest.fixture(scope="module")
def skewed_df(spark, skewed):
    return spark.createDataFrame(skewed, "g string, x double, y double")


def test_summary_and_quantiles(skewed, skewed_df):
    got = {(r["grp"], r["feature"]): r for r in G.summary(skewed_df, by="g", columns=["x", "y"]).collect()}
    for g in {r[0] for r in skewed}:
        for i, c in ((1, "x"), (2, "y")):
            values = [r[i] for r in skewed if r[0] == g]
            row = got[(g, c)]
            assert row["median"] == statistics.median(values)
            assert row["mean"] == pytest.approx(statistics.fmean(values))
            assert row["sd"] == (pytest.approx(statistics.stdev(values)) if len(values) > 1 else None)


def test_quantiles_between_ranks(spark):
    df = spark.createDataFrame([("g", float(v)) for v in (1, 2, 3, 10)], "g string, v double")
    got = {r["prob"]: r["value"] for r in quantiles(long_form(df, "g", ["v"]), [0.0, 0.25, 0.5, 1.0]).collect()}
    assert got == {0.0: 1.0, 0.25: 1.75, 0.5: 2.5, 1.0: 10.0}


def test_average_ranks(skewed, skewed_df):
    ordered = sorted(r[1] for r in skewed)
    first = {}
    for i, v in enumerate(ordered):
        first.setdefault(v, i)
    ties = Counter(ordered)
    for r in average_ranks(long_form(skewed_df, "g", ["x"])).collect():
        assert r["mid_rank"] == first[r["value"]] + (ties[r["value"]] + 1) / 2


def test_kruskal(skewed, skewed_df):
    """H from squared distances of mean ranks, over the variance of the ranks."""
    rows = [r for r in skewed if r[0] != "solo"]
    ordered = sorted(r[1] for r in rows)
    ranks = {v: statistics.fmean([i + 1 for i, w in enumerate(ordered) if w == v]) for v in set(ordered)}
    n, mean = len(rows), (len(rows) + 1) / 2
    between = sum(len(s) * (statistics.fmean(s) - mean) ** 2
                  for s in ([ranks[r[1]] for r in rows if r[0] == g] for g in ("g0", "g1", "g2")))
    spread = sum((ranks[r[1]] - mean) ** 2 for r in rows) / (n - 1)
    got = G.kruskal(skewed_df, by="g", columns=["x"], order=["g0", "g1", "g2"]).first()
    assert got["h"] == pytest.approx(between / spread, rel=1e-9)
    assert got["p_value"] == pytest.approx(math.exp(-got["h"] / 2))


def test_kruskal_of_equal_values_is_null(spark):
    df = spark.createDataFrame([("a", 1.0), ("b", 1.0)], "g string, x double")
    assert G.kruskal(df, by="g", columns=["x"], order=["a", "b"]).first()["h"] is None


def test_box_whiskers(skewed, skewed_df):
    for r in G.box_stats(skewed_df, by="g", columns=["x"]).collect():
        values = [v[1] for v in skewed if v[0] == r["grp"]]
        reach = 1.5 * (r["q3"] - r["q1"])
        assert r["whisker_low"] == min([v for v in values if v >= r["q1"] - reach] + [r["q1"]])
        assert r["whisker_high"] == max([v for v in values if v <= r["q3"] + reach] + [r["q3"]])


def points(spark, rows):
    return spark.createDataFrame(rows, "x double, y double, label string")


def test_centroid_by_hand(spark):
    # Means 3 and 2; squared deviations add up to 40 and 4 over five rows.
    train = points(spark, [(-1.0, 1.0, "low"), (1.0, 1.0, "low"), (3.0, 2.0, "mid"), (5.0, 3.0, "top"), (7.0, 3.0, "top")])
    rows = {(r["label"], r["dim"]): r for r in N.model_rows(N.class_stats(train, label="label", columns=["x", "y"])).collect()}
    assert rows[("low", 0)]["mean"] == 3.0 and rows[("low", 0)]["scale"] == pytest.approx(math.sqrt(8))
    assert rows[("top", 1)]["centroid"] == pytest.approx(1 / math.sqrt(0.8))
    model = N.fit(train, label="label", columns=["x", "y"])
    new = points(spark, [(0.5, 1.2, None), (3.1, 2.1, None), (9.0, 2.6, None)])
    assert [r["pred"] for r in N.predict(new, model, columns=["x", "y"]).orderBy("x").collect()] == ["low", "mid", "top"]


def test_centroid_scale(spark):
    """A column in the thousands does not drown one in tenths."""
    train = points(spark, [(0.1, 5000.0, "p"), (0.1, -5000.0, "p"), (0.4, 4000.0, "q"), (0.4, -4000.0, "q")])
    model = N.fit(train, label="label", columns=["x", "y"])
    got = N.predict(points(spark, [(0.15, -900.0, None), (0.33, 900.0, None)]), model, columns=["x", "y"])
    assert [r["pred"] for r in got.orderBy("x").collect()] == ["p", "q"]


def test_missing_values(spark):
    train = points(spark, [(None, 1.0, "a"), (6.0, 1.0, "a"), (4.0, 3.0, "a"), (0.0, 7.0, "b"), (2.0, None, "b"), (None, None, "c")])
    rows = {(r["label"], r["dim"]): r for r in N.model_rows(N.class_stats(train, label="label", columns=["x", "y"])).collect()}
    assert rows[("a", 0)]["mean"] == 3.0 and rows[("a", 0)]["n"] == 3 and rows[("c", 0)]["centroid"] is None
    model = N.fit(train, label="label", columns=["x", "y"])
    new = points(spark, [(5.0, 1.0, None), (None, 1.0, None), (1.0, 7.0, None), (5.0, None, None)])
    got = {(r["x"], r["y"]): r["pred"] for r in N.predict(new, model, columns=["x", "y"]).collect()}
    assert got == {(5.0, 1.0): "a", (1.0, 7.0): "b", (None, 1.0): None, (5.0, None): None}


def test_centroid_constant_column(spark):
    train = points(spark, [(-3.0, 8.0, "x"), (3.0, 8.0, "y")])
    model = N.fit(train, label="label", columns=["x", "y"])
    for r in N.with_distances(train, model, columns=["x", "y"]).collect():
        assert all(math.isfinite(d["dist"]) for d in r["distances"])
    tie = N.predict(points(spark, [(0.0, 8.0, None)]), model, columns=["x", "y"])
    assert tie.first()["pred"] == "x"


def test_statistics_of_many_columns_and_classes(spark):
    rng = random.Random(1)
    cols = [f"c{i}" for i in range(20)]
    data = [(f"l{rng.randint(0, 300)}", *[rng.gauss(0, 1) for _ in cols]) for _ in range(1500)]
    df = spark.createDataFrame(data, ["label", *cols])
    got = {(r["label"], r["dim"]): r for r in N.class_stats(df, label="label", columns=cols).collect()}
    for label in ("l0", "l7"):
        own = [r[1:] for r in data if r[0] == label]
        for d in range(20):
            values = [r[d] for r in own]
            assert got[(label, d)]["n"] == len(own)
            assert got[(label, d)]["mean"] == pytest.approx(statistics.fmean(values))
            assert got[(label, d)]["m2"] == pytest.approx(statistics.pvariance(values) * len(own), abs=1e-12)
    model = N.fit(df, label="label", columns=cols)
    assert model.first()["classes"][3]["label"] == sorted({r[0] for r in data})[3]


def test_tail_for_many_degrees(one):
    def exact(x, df):  # finite sums in logarithms
        h, half = x / 2, 0.5 * (df % 2)
        total = math.erfc(math.sqrt(h)) if df % 2 else 0.0
        for j in range(1, df // 2 + 1) if df % 2 else range(df // 2):
            total += math.exp(-h + (j - half) * math.log(h) - math.lgamma(j + 1 - half))
        return total

    for df in (1, 2, 3, 7, 60, 61, 999, 5000, 5001):
        for x in (0.3 * df, 1.1 * df, 2.0 * df):
            got = one(lambda v, n=df: chi_square_tail(v, n), float(x), schema="double")
            assert got == pytest.approx(exact(x, df), rel=1e-7, abs=1e-12)


def test_kruskal_with_many_classes(spark):
    rng = random.Random(2)
    data = [(f"k{i % 400}", rng.gauss(0, 1)) for i in range(2000)]
    df = spark.createDataFrame(data, "g string, x double")
    row = G.kruskal(df, by="g", columns=["x"]).first()
    assert row["n"] == 2000 and 0.001 < row["p_value"] < 0.999


PAIRS = [("a", "a", 5), ("a", "b", 1), ("b", "b", 2), ("b", "c", 2), ("c", "a", 1)]


def test_scores_and_report(spark):
    pairs = spark.createDataFrame([("m", *p) for p in PAIRS], "model string, truth string, pred string, n bigint")
    row = E.scores(pairs, ["model"]).first()
    f1 = {"a": 2 * 5 / 12, "b": 2 * 2 / 7, "c": 0.0}
    assert row["accuracy"] == pytest.approx(7 / 11) and row["macro_f1"] == pytest.approx(sum(f1.values()) / 3)
    rep = {r["label"]: r for r in E.class_report(pairs, ["c", "b", "a", "z"], ["model"]).collect()}
    assert rep["b"]["precision"] == pytest.approx(2 / 3) and rep["b"]["recall"] == 0.5 and rep["b"]["support"] == 4
    assert rep["z"]["f1"] == 0.0 and rep["z"]["support"] == 0
    assert rep["accuracy"]["f1"] == pytest.approx(7 / 11)
    assert rep["weighted avg"]["f1"] == pytest.approx((6 * f1["a"] + 4 * f1["b"]) / 11)
    grid = {(r["truth"], r["pred"]): r for r in E.confusion(pairs, ["a", "b", "c", "z"], ["model"]).collect()}
    assert len(grid) == 16 and grid["a", "a"]["share"] == pytest.approx(5 / 6) and grid["z", "a"]["share"] == 0.0


@pytest.fixture(scope="module")
def clouds(spark):
    rng = random.Random(6)
    rows = []
    for i in range(240):
        c = i % 3
        rows.append((i, f"a{c}_{i % 24}", f"E{c}", c + rng.gauss(0, 0.6), -2 * c + rng.gauss(0, 1.5), rng.gauss(0, 1)))
    return spark.createDataFrame(rows, "id int, author string, epoch string, f1 double, f2 double, f3 double")


COLS = ["f1", "f2", "f3"]


def test_permuted_columns_keep_their_values(clouds):
    rows = permuted(clouds, id_col="id", columns=COLS, repeats=2, seed=3).collect()
    base = {r["id"]: r for r in clouds.collect()}
    for c in COLS:
        for rep in (0, 1):
            cell = [r for r in rows if (r["feature"], r["repeat"]) == (c, rep)]
            assert len(cell) == 240 and sorted(r[c] for r in cell) == sorted(r[c] for r in base.values())
            assert any(r[c] != base[r["id"]][c] for r in cell)
            assert all(r[o] == base[r["id"]][o] for r in cell for o in COLS if o != c)


def test_importance_finds_the_signal(clouds):
    model = N.fit(clouds, label="epoch", columns=COLS)
    got = {r["feature"]: r["importance_mean"] for r in permutation_importance(
        clouds, lambda r: N.predict(r, model, columns=COLS), id_col="id", label="epoch", columns=COLS, repeats=4,
        seed=1).collect()}
    assert got["f1"] > got["f3"] and got["f1"] > 0.1 and abs(got["f3"]) < 0.1


def test_cross_validation_agrees_with_separate_fits(clouds):
    from corpusmill.operators.folds import with_group_folds
    kw = dict(group="author", label="epoch", folds=4, seed=1)
    marked = with_group_folds(clouds, **kw)
    got = {(r["truth"], r["fold"], r["model"], r["pred"]): r["n"] for r in E.pair_counts(
        E.fold_predictions(marked, label="epoch", columns=COLS, fold="fold", folds=4), truth="truth",
        by=["fold", "model"]).collect()}
    want = {}
    for f in range(4):
        model = N.fit(marked.where(F.col("fold") != f), label="epoch", columns=COLS)
        both = N.predict_both(marked.where(F.col("fold") == f), model, columns=COLS, baseline="b", nearest="n")
        for r in both.collect():
            for name, pred in ((E.BASELINE, r["b"]), (E.CENTROID, r["n"])):
                key = (r["epoch"], f, name, pred)
                want[key] = want.get(key, 0) + 1
    assert got == want


def test_logistic_is_the_stationary_point(clouds):
    """At the optimum the penalty balances the sum of the residuals."""
    model = M.fit_logistic(clouds, label="epoch", columns=COLS)
    rows = model.transform(clouds).select("epoch", vector_to_array("__prob").alias("p"), *[f"__z_{c}" for c in COLS]).collect()
    weights = {(r["label"], r["feature"]): r["coefficient"] for r in M.coefficients(model, COLS, ["E0", "E1", "E2"]).collect()}
    for k in range(3):
        for c in COLS:
            pull = sum(((r["epoch"] == f"E{k}") - r["p"][k]) * r[f"__z_{c}"] for r in rows)
            assert pull == pytest.approx(weights[f"E{k}", c], abs=5e-3)


def test_models_survive_a_round_trip(clouds, tmp_path):
    for fit in (lambda: M.fit_logistic(clouds, label="epoch", columns=COLS),
                lambda: M.fit_forest(clouds, label="epoch", columns=COLS, seed=1, trees=5)):
        model = fit()
        M.save_model(model, str(tmp_path / "m"))
        again = M.load_model(str(tmp_path / "m"))
        a, b = (sorted(tuple(r) for r in M.apply_model(m, clouds).select("id", "pred").collect()) for m in (model, again))
        assert a == b and sum(p == f"E{i % 3}" for i, p in a) > 150


def test_rank_sums_order_buckets_without_their_groups(spark):
    """The window over a feature's buckets meets a row per bucket, however many groups there are."""
    long = spark.range(3000).selectExpr("IF(id % 2 = 0, 'f', 'g') AS feature", "id % 300 AS grp", "CAST(id * 7919 % 1000 AS DOUBLE) AS value")
    sums = O.rank_sums(long)
    assert sums.agg(F.sum("n"), F.sum("rank_sum")).first()[:] == (3000, 1500 * 1501)
    plan = sums._jdf.queryExecution().optimizedPlan().toString()
    wide = [i for i, line in enumerate(plan.split("\n")) if re.search(r"Window .*\[feature#\d+\], \[bucket#\d+ ASC", line)]
    assert len(wide) == 1, plan
    below = next(line for line in plan.split("\n")[wide[0]:] if "Aggregate [" in line)
    assert "grp#" not in below.split("], [")[0], below
