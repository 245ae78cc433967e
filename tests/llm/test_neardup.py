import random
from collections import defaultdict

import pytest

from corpusmill.llm.components import components
from corpusmill.llm.neardup import NearDup, drop_near_duplicates, near_duplicates
from tests.llm.conftest import plain_words


def shingle_set(text):
    w = plain_words(text)
    return {tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def brute(rows):
    """Component of every row by its place in the list."""
    sets = [shingle_set(t) for _, t in rows]
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, a in enumerate(sets):
        for j, b in enumerate(sets[:i]):
            if a and b and 100 * len(a & b) >= 75 * len(a | b):
                parent[max(find(i), find(j))] = min(find(i), find(j))
    groups = defaultdict(list)
    for i in range(len(rows)):
        groups[find(i)].append(rows[i][0])
    return [min((x for x in groups[find(i)] if x is not None), default=None) for i in range(len(rows))], sets


def family(rng, base, copies, edits):
    """Texts that differ from one base in some words each."""
    out = []
    for _ in range(copies):
        w = base[:]
        for _ in range(edits):
            w[rng.randrange(len(w))] = f"new{rng.randrange(10**6)}"
        out.append(" ".join(w))
    return out


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(7)
    words = lambda n: [f"w{rng.randrange(5000)}" for _ in range(n)]
    texts = [" ".join(words(rng.randrange(1, 120))) for _ in range(40)]
    texts += family(rng, words(200), 25, 2)     # all near each other
    texts += family(rng, words(200), 25, 5)     # near their base, mostly not each other
    hub = words(200)
    texts += family(rng, hub, 12, 4) + [" ".join(hub)]
    chain = words(100)
    for _ in range(8):                           # each near the next only
        texts.append(" ".join(chain))
        chain = chain[6:] + words(6)
    shared = words(60)                           # a passage that many share
    texts += [" ".join(words(60) + shared) for _ in range(20)]
    texts += ["Same five words or more", "same FIVE words  or\nmore", "two words", "Two words", "one", None, "", "  \n"]
    texts += [texts[0]] * 6
    ids = list(range(len(texts)))
    rng.shuffle(ids)
    return list(zip(ids, texts, strict=True))


def test_components_match_all_pairs(docs, rows):
    expected, sets = brute(rows)
    got = {r["doc_id"]: r for r in near_duplicates(docs(rows, extra=True)).collect()}
    assert len(got) == len(rows)
    for (i, _), component, s in zip(rows, expected, sets, strict=True):
        assert got[i]["component_id"] == component, i
        assert got[i]["n_shingles"] == len(s)
        assert got[i]["kept"] == (i == component)


def test_one_row_of_each_component_stays(docs, rows):
    expected, _ = brute(rows)
    df = docs(rows, extra=True)
    left = drop_near_duplicates(df)
    assert left.columns == df.columns
    assert sorted(r["doc_id"] for r in left.collect()) == sorted(set(expected))


def test_links_that_no_centre_has(docs):
    """Texts around a hidden base: few links lead to the smallest member of a bucket, the others have to be found."""
    rng = random.Random(12)
    base = [f"w{rng.randrange(10**6)}" for _ in range(300)]
    texts = []
    for _ in range(60):
        w = base[:]
        for k in sorted(rng.sample(range(10), 3)):  # three of ten blocks changed in eight words
            at = 30 * k + rng.randrange(20)
            w[at:at + 8] = [f"n{rng.randrange(10**6)}" for _ in range(8)]
        texts.append(" ".join(w))
    rows = list(enumerate(texts))
    expected, _ = brute(rows)
    got = {r["doc_id"]: r["component_id"] for r in near_duplicates(docs(rows)).collect()}
    assert got == dict(enumerate(expected))


def test_nulls_repeats_and_empty_tables(docs):
    text = "a b c d e f g h"
    rows = [(None, text), (None, text), (5, text), (5, text), (9, None), (9, None), (None, "alone with no id at all"), (3, "")]
    got = near_duplicates(docs(rows)).collect()
    assert len(got) == len(rows)
    assert {r["component_id"] for r in got if r["n_shingles"] == 4} == {5}
    assert sum(r["kept"] for r in got if r["n_shingles"] == 4) == 2  # both rows with id 5
    assert [r["kept"] for r in got if r["doc_id"] is None and r["n_shingles"] == 2] == [False]
    left = drop_near_duplicates(docs(rows)).collect()
    assert sorted((r["doc_id"] is None, r["doc_id"]) for r in left if r["doc_id"] is not None) == [
        (False, 3), (False, 5), (False, 9)]
    assert sum(r["doc_id"] is None for r in left) == 1
    assert drop_near_duplicates(docs([])).collect() == []


def test_a_loose_estimate_changes_nothing(docs, rows):
    """Pairs are confirmed on full sets, so the cut of the estimate only saves work."""
    expected, _ = brute(rows)
    got = {r["doc_id"]: r["component_id"] for r in near_duplicates(docs(rows), NearDup(cut=0.0, fine_cut=0.0, seed=9, block=8)).collect()}
    assert got == {i: c for (i, _), c in zip(rows, expected, strict=True)}


def test_components_of_paths_and_stars(spark):
    links = [(i, i + 1) for i in range(0, 40)] + [(100, x) for x in range(101, 140)] + [(7, 7), (200, 201), (201, 200)]
    got = dict(map(tuple, components(spark.createDataFrame(links, "a long, b long")).select("node", "comp").collect()))
    assert {got[i] for i in range(41)} == {0} and {got[i] for i in range(100, 140)} == {100}
    assert got[200] == got[201] == 200 and len(got) == 41 + 40 + 2
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_long_text_meets_its_copy(docs):
    rng = random.Random(1)
    base = [f"w{rng.randrange(10**6)}" for _ in range(60_000)]
    got = near_duplicates(docs([(1, " ".join(base)), (2, " ".join(base[:59_000])), (3, " ".join(base[:1000]))])).select(
        "doc_id", "component_id").orderBy("doc_id").collect()
    assert [tuple(r) for r in got] == [(1, 1), (2, 1), (3, 3)]
