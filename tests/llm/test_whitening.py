import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from corpusmill.llm import whitening as W

SCHEMA = "vec_id long, embedding array<float>, label int"


def table(spark, vectors, schema=SCHEMA):
    rows = [(i, v, 0) for i, v in enumerate(vectors)]
    return spark.createDataFrame(rows, schema).repartition(3).withColumns({c: F.lit("clash") for c in ("v", "x", "size", "n", "a")})


def plain(vectors):
    """Whitening by numpy's own covariance over the distinct integer vectors."""
    x = [[math.floor(64 * float(np.float32(c))) + 1_000_000 for c in v] for v in vectors]
    fit = np.array(sorted(set(map(tuple, x))), dtype=float)
    cov = np.cov(fit.T, bias=True).reshape(fit.shape[1], -1)
    values, axes = np.linalg.eigh(cov)
    n, sums = len(fit), [sum(c) for c in zip(*set(map(tuple, x)), strict=True)]
    deviation = [sum((n * c - s) ** 2 for c, s in zip(v, sums, strict=True)) for v in x]
    return n, (np.array(x) - fit.mean(axis=0)) @ axes[:, ::-1] / np.sqrt(np.abs(values[::-1])), values[::-1], deviation


def test_against_numpy(spark):
    rng = np.random.default_rng(1)
    base = rng.normal(0, 0.3, (300, 20)) @ rng.normal(0, 1, (20, 20))
    vectors = [v.tolist() for v in base] + [base[5].tolist()] * 200 + [base[7].tolist()] * 3
    got = W.whiten(table(spark, vectors)).collect()
    n, white, values, deviation = plain(vectors)
    assert len(got) == len(vectors) * 16 and {r["n"] for r in got} == {n} and n == 300
    k = {(r["vec_id"], r["component"]): r for r in got}
    signs = [np.sign(k[0, c + 1]["whitened"] * white[0][c]) for c in range(16)]
    for (i, c), r in k.items():
        assert r["deviation"] == deviation[i]
        assert r["whitened"] * signs[c - 1] == pytest.approx(white[i][c - 1], abs=1e-8)
        assert r["explained"] == pytest.approx(values[c - 1] / values.sum(), rel=1e-9)
        assert r["identity_error"] < 1e-10
    assert len({r["identity_error"] for r in got}) == 1


def test_cross_products_are_exact():
    rng = np.random.default_rng(2)
    for high, rows in ((2, 1), (200, 63), (1 << 20, 130), (1 << 33, 65), (1 << 60, 64)):
        y = rng.integers(0, high, (rows, 7), dtype=np.uint64)
        o = y.astype(object)
        assert (W.cross_products(y) == o.T @ o).all()
        z = y.astype(np.int64) - high // 2
        s = W.Sums.of(z[:rows // 2 + 1]) + W.Sums.of(z) if rows > 1 else W.Sums.of(z)
        o = np.concatenate([z[:rows // 2 + 1], z]).astype(object) if rows > 1 else z.astype(object)
        assert (s.two == o.T @ o).all() and (s.one == o.sum(axis=0)).all() and s.n == len(o)
    dims, bits, words = W.planes(np.array([[5, 0], [1, 0]], dtype=np.uint64))
    assert dims.tolist() == [0, 0] and bits.tolist() == [0, 2]
    assert np.bitwise_count(words).sum(axis=1).tolist() == [2, 1]


def test_sums_do_not_follow_the_layout(spark):
    rng = np.random.default_rng(3)
    vectors = rng.normal(0, 2, (500, 5)).tolist()
    rows = W.on_grid(table(spark, vectors))
    sums = [W.scatter(rows.select("x").repartition(p), W.Grid(block=64)) for p in (1, 4, 23)]
    for s in sums[1:]:
        assert s.n == sums[0].n and (s.one == sums[0].one).all() and (s.two == sums[0].two).all()


def test_rows_that_are_left_out_and_ties(spark):
    good = [[0.5, 1.0], [0.25, -1.0], [3.0, 0.0], [0.5, 1.0]]
    bad = [None, [None, 1.0], [float("nan"), 1.0], [float("inf"), 1.0], [1.0, float("-inf")], [], [1.0], [1.0, 2.0, 3.0], [3.4e38, 1.0]]
    got = W.whiten(table(spark, good + bad)).collect()
    assert sorted((r["vec_id"], r["component"]) for r in got) == [(i, c) for i in range(4) for c in (1, 2)]
    same = {r["component"]: r["whitened"] for r in got if r["vec_id"] == 0}
    assert same == {r["component"]: r["whitened"] for r in got if r["vec_id"] == 3}
    assert {r["n"] for r in got} == {3}


def test_lower_rank_one_vector_none_and_large_numbers(spark):
    line = [[float(i), 2.0 * i, 0.0] for i in range(10)]
    got = W.whiten(table(spark, line)).collect()
    assert {r["component"] for r in got} == {1} and got[0]["explained"] == pytest.approx(1.0)
    assert W.whiten(table(spark, [[1.0, 2.0]] * 5)).collect() == []
    assert W.whiten(table(spark, [])).collect() == [] and W.whiten(table(spark, [None])).collect() == []
    large = [[1e15, 0.0], [-1e15, 1e13], [0.0, 5e14]]
    got = W.whiten(table(spark, large, "vec_id long, embedding array<double>, label int")).collect()
    assert {r["deviation"] for r in got if r["vec_id"] < 2} == {None} and len(got) == 6
    # A component far below the first one is a rounding error.
    assert W.whiten(table(spark, [[1e9, 0.0], [-1e9, 1.0], [0.0, 5.0]])).count() == 3
    assert max(r["identity_error"] for r in got) < 1e-4


def test_whole_given_table_has_unit_covariance(spark):
    rows = spark.read.parquet("/root/testdata/sf0.001/embeddings.parquet")
    got = W.whiten(rows)
    assert got.count() == rows.count() * 16
    assert got.agg(F.max("identity_error")).first()[0] < 1e-9
