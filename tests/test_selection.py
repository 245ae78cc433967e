import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from corpusmill.operators import folds as D
from corpusmill.operators.ordering import order_key, with_rank
from corpusmill.operators.quota import quota_select, quota_select_general


def walk(rows, per_author, per_group):
    """The rule as stated: take a row while neither side is full."""
    authors, groups, taken = Counter(), Counter(), set()
    for place, author, group in sorted(rows):
        if authors[author] < per_author and groups[group] < per_group:
            authors[author] += 1
            groups[group] += 1
            taken.add(place)
    return taken


RULE = dict(author="author", group="epoch", order=["place"])


def test_quotas_equal_the_walk(spark):
    rng = random.Random(11)
    for trial in range(8):
        n = rng.randint(0, 120)
        rows = [(i, f"a{rng.randint(0, 12)}", f"e{rng.randint(0, 3)}") for i in range(n)]
        limits = rng.randint(1, 5), rng.randint(1, 25)
        df = spark.createDataFrame(rows, "place int, author string, epoch string")
        got = quota_select_general(df, per_author=limits[0], per_group=limits[1], **RULE)
        assert {r["place"] for r in got.collect()} == walk(rows, *limits)
        # One class per author: two row limits are enough.
        fixed = [(i, a, f"e{hash(a) % 3}") for i, a, _ in rows]
        df = spark.createDataFrame(fixed, "place int, author string, epoch string")
        for fn in (quota_select, quota_select_general):
            got = fn(df, per_author=limits[0], per_group=limits[1], **RULE)
            assert {r["place"] for r in got.collect()} == walk(fixed, *limits)


def test_quotas_with_one_author_holding_a_third(spark):
    rng = random.Random(2)
    rows = [(i, "hot" if rng.random() < 0.4 else f"a{rng.randint(0, 60)}", "E" if rng.random() < 0.6 else f"e{i % 4}")
            for i in range(1500)]
    df = spark.createDataFrame(rows, "place int, author string, epoch string")
    got = quota_select_general(df, per_author=3, per_group=40, **RULE)
    assert {r["place"] for r in got.collect()} == walk(rows, 3, 40)


def test_quotas_of_many_classes_take_few_rounds_and_keep_missing_values(spark, monkeypatch):
    from corpusmill.operators import quota as Q
    rounds = []
    keep = Q.materialise
    monkeypatch.setattr(Q, "materialise", lambda df, name: rounds.append(name) or keep(df, name))
    rng = random.Random(5)
    rows = [(i, rng.choice([None, *(f"a{k}" for k in range(200))]), rng.choice([None, *(f"e{k}" for k in range(150))]))
            for i in range(2500)]
    df = spark.createDataFrame(rows, "place int, author string, epoch string")
    got = {r["place"] for r in quota_select_general(df, per_author=6, per_group=7, **RULE).collect()}
    assert got == walk([(i, a or "", g or "") for i, a, g in rows], 6, 7)
    assert {i for i in got if rows[i][2] is None}
    assert rounds.count("quota-limits") < 30


def test_rank_equals_a_sort(spark):
    rows = spark.range(3000).select("id", (F.col("id") % 3).alias("g"), (F.col("id") % 7 % 4).alias("s")).withColumn(
        "k", order_key(F.col("id"), 5))
    got = with_rank(rows, by=["g"], leading=["s"], key="k", ties=["id"], out="r").collect()
    for g in range(3):
        want = sorted((r["s"], r["k"], r["id"]) for r in got if r["g"] == g)
        assert [x[2] for x in want] == [r["id"] for r in sorted((r for r in got if r["g"] == g), key=lambda r: r["r"])]
        assert sorted(r["r"] for r in got if r["g"] == g) == list(range(1, len(want) + 1))


@pytest.fixture
def labelled(spark):
    rng = random.Random(4)
    rows = [(i, f"a{min(rng.randint(0, 80), rng.randint(0, 80))}") for i in range(600)]
    return spark.createDataFrame([(i, a, f"c{len(a) * int(a[1:]) % 3}") for i, a in rows],
                                 "id int, author string, epoch string")


def test_group_folds(labelled):
    rows = D.with_group_folds(labelled, group="author", label="epoch", folds=5, seed=1).collect()
    per_author = {}
    for r in rows:
        per_author.setdefault(r["author"], set()).add(r["fold"])
    assert all(len(f) == 1 for f in per_author.values())
    sizes = Counter(r["fold"] for r in rows)
    assert set(sizes) == set(range(5)) and max(sizes.values()) - min(sizes.values()) < 40
    other = D.with_group_folds(labelled, group="author", label="epoch", folds=5, seed=2).collect()
    assert {(r["id"], r["fold"]) for r in rows} != {(r["id"], r["fold"]) for r in other}


def test_random_folds_are_stratified(labelled):
    rows = D.with_random_folds(labelled, id_col="id", label="epoch", folds=4, seed=1).collect()
    for label in ("c0", "c1", "c2"):
        sizes = Counter(r["fold"] for r in rows if r["epoch"] == label)
        assert max(sizes.values()) - min(sizes.values()) <= 1


def test_split_does_not_leak(spark, labelled):
    train, test = D.split(labelled, group="author", label="epoch", folds=5, seed=1)
    D.assert_no_leak(train, test, group="author")
    assert train.count() + test.count() == 600
    with pytest.raises(ValueError, match="both train and test"):
        D.assert_no_leak(labelled, labelled, group="author")


def test_ranks_keep_rows_without_a_key(spark):
    """Null groups and null leading values are groups of their own, and every rank occurs once."""
    rng = random.Random(3)
    rows = [(i, rng.choice([None, "a", "b"]), rng.choice([None, 1, 2, 3])) for i in range(300)]
    df = spark.createDataFrame(rows, "id int, g string, s int").withColumn("k", order_key(F.col("id"), 1))
    got = with_rank(df, key="k", ties=["id"], by=["g"], leading=["s"], out="r", prefix=1).collect()
    assert len(got) == 300
    for g in (None, "a", "b"):
        own = sorted((r for r in got if r["g"] == g), key=lambda r: (r["s"] is not None, r["s"] or 0, r["k"], r["id"]))
        assert [r["r"] for r in own] == list(range(1, len(own) + 1))


def test_folds_keep_rows_without_group_or_label(spark):
    rng = random.Random(4)
    rows = [(i, rng.choice([None, "x", "y"]), rng.choice([None, *"abcdefgh"])) for i in range(100)] + [(None, None, None)]
    df = spark.createDataFrame(rows, "id int, label string, author string")
    for fold in (D.with_random_folds(df, id_col="id", label="label", folds=5, seed=1),
                 D.with_group_folds(df, group="author", label="label", folds=5, seed=1)):
        got = fold.collect()
        assert len(got) == 101 and all(0 <= r["fold"] < 5 for r in got)
    assert len({r["fold"] for r in got if r["author"] is None}) == 1
