import random
import zlib
from hashlib import sha256

import pytest
from pyspark.sql import functions as F

from corpusmill.llm import merkle as M


def fifth():
    return F.crc32(F.col("doc_id").cast("string")) % 5 == 0


def h(parts):
    return sha256("".join(parts).encode()).hexdigest()


def plain_leaf(row):
    return h("-" if v is None else f"{len(str(v).encode())}:{v}" for v in row)


def plain_tree(leaves, arity):
    """The top of a tree and for every leaf its runs, level by level."""
    paths, at, nodes = [[] for _ in leaves], list(range(len(leaves))), list(leaves)
    while len(nodes) > 1:
        runs = [nodes[i:i + arity] for i in range(0, len(nodes), arity)]
        for k, place in enumerate(at):
            paths[k].append((runs[place // arity], place % arity))
        at, nodes = [p // arity for p in at], [h(r) for r in runs]
    return nodes[0], paths


def plain(rows, arity=16):
    """rows: (doc_id, text, lang, source); all results by position, sorted."""
    full = [(i, s, g, None if t is None else len(t), t) for i, t, g, s in rows]
    trees = {}
    for r in full:
        trees.setdefault(r[1], []).append(r)
    order = sorted(trees, key=lambda s: (s is not None, (s or "").encode()))
    subs, below = [], []
    for s in order:
        own = sorted(trees[s], key=lambda r: (r[0] is not None, r[0] or 0, plain_leaf(r)))
        top, paths = plain_tree([plain_leaf(r) for r in own], arity)
        subs.append(top)
        below.append(list(zip(own, paths, strict=True)))
    root, upper = plain_tree(subs, arity)
    out = []
    for sub, tree, above in zip(subs, below, upper, strict=True):
        for r, path in tree:
            whole = path + above
            now = r
            if r[0] is not None and zlib.crc32(str(r[0]).encode()) % 5 == 0 and r[4] is not None:
                now = (*r[:4], r[4].translate({i: i + 32 for i in range(65, 91)}))
            cur = plain_leaf(now)
            for run, at in whole:
                cur = h([*run[:at], cur, *run[at + 1:]])
            sibs = [d for run, at in whole for d in (*run[:at], *run[at + 1:])]
            out.append((r[0], r[1], plain_leaf(r), sub, root, h(sibs), cur, cur == root))
    return sorted(out, key=repr)


def results(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def make(rng, n, sources):
    rows = []
    for i in range(n):
        source = sources[0] if rng.random() < 0.4 else rng.choice(sources)
        rows.append((rng.randrange(10**6), rng.choice(["Text É \U0001F600", "plain", "", None, "UPPER", "x" * 100]),
                     rng.choice(["en", None, ""]), source))
    return rows


@pytest.mark.parametrize("n, arity, levels", [(1, 2, 1), (17, 16, 3), (257, 16, 1), (300, 2, 3), (700, 3, 2)])
def test_against_a_plain_tree(docs, n, arity, levels):
    rows = make(random.Random(n), n, [None, "", "b", "a", "é", "=", "\U0001F600", "ﬀ"])
    got = M.manifest(docs(rows, extra=True), M.Shape(arity, levels), tamper=fifth())
    assert results(got) == plain(rows, arity)


def test_many_sources_and_shape_of_blocks_does_not_matter(docs):
    rows = make(random.Random(5), 400, [f"s{i}" for i in range(150)])
    want = plain(rows)
    for levels in (1, 3):
        assert results(M.manifest(docs(rows), M.Shape(16, levels), tamper=fifth())) == want


def test_nulls_ties_repeated_rows_and_none(docs):
    rows = [(None, None, None, None)] * 3 + [(7, "A", "en", "s")] * 20 + [(7, "B", "en", "s"), (None, "C", None, "s")]
    assert results(M.manifest(docs(rows), tamper=fifth())) == plain(rows)
    assert M.manifest(docs([]), tamper=fifth()).collect() == []


def test_sweeps_of_one_block():
    rng = random.Random(6)
    for arity, levels in ((2, 3), (3, 2), (16, 1)):
        for n in range(1, arity ** levels + 1):
            digests = [h([str(rng.random())]) for _ in range(n)]
            made = M.rise(digests, levels, arity, True)
            top, paths = plain_tree(digests, arity)
            assert made[-1] == [top]
            proofs = M.fall(made, arity, None)
            assert [[(q["run"], q["at"]) for q in M.listed(p)] for p in proofs] == paths
            assert all(M.folded(d, p) == top and M.listed(M.linked(M.listed(p))) == M.listed(p)
                       for d, p in zip(digests, proofs, strict=True))
    # A block of a larger tree rises all its levels, also from a single node.
    assert M.rise(["a"], 2, 16, False) == [["a"], [h("a")], [h([h("a")])]]


def test_proofs_fold_to_the_root_and_long_texts_count_whole(docs):
    rows = [(i, "Q" * (4_000_000 if i == 2 else i), None, "s") for i in range(20)]
    out = M.manifest(docs(rows), tamper=fifth(), keep_proof=True).collect()
    for r in out:
        assert M.folded(r["leaf"], M.linked([q.asDict() for q in r["proof"]])) == r["root"]
        changed = zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0 and r["doc_id"] > 0
        assert r["verified"] == (not changed)
