import random
from collections import Counter

import numpy as np
import pytest

from corpusmill.llm import linededup as L


def plain_key(line):
    return line.strip(" \t\n\x0b\x0c\r").translate({i: i + 32 for i in range(65, 91)})


def plain(rows, rule):
    """Kept text per row, by counting keys in a dictionary."""
    split = [(i, (t or "").split("\n")) for i, t in rows]
    often = Counter(k for _, ls in split for k in {plain_key(x) for x in ls} if len(k) >= rule.least_chars)
    order = sorted(range(len(rows)), key=lambda r: (rows[r][0] is not None, rows[r][0] or 0))
    seen, out = set(), [None] * len(rows)
    for r in order:
        kept = []
        for line in split[r][1]:
            k = plain_key(line)
            gone = len(k) >= rule.least_chars and often[k] >= rule.least_docs
            if gone and rule.keep_first and k not in seen:
                seen.add(k)
                gone = False
            if not gone:
                kept.append(line)
        out[r] = (rows[r][0], len(split[r][1]), len(split[r][1]) - len(kept), "\n".join(kept))
    return out


def results(df):
    return sorted(((r["doc_id"], r["n_lines"], r["n_dropped"], r["kept"]) for r in df.collect()), key=repr)


def fixture(rng, n=150):
    common = ["Share this page", "  share THIS page\r", "É accent", " share this page", "x", "", "\t", "ÀB ab", "all rights reserved"]
    rows = []
    for i in range(n):
        lines = [rng.choice(common) if rng.random() < 0.5 else f"line {rng.randrange(60)}" for _ in range(rng.randrange(1, 30))]
        if rng.random() < 0.7:
            lines += ["hot line"] * rng.randrange(1, 4)
        rng.shuffle(lines)
        rows.append((i * 7 - 300, "\n".join(lines)))
    return rows + [(9000, None), (9001, ""), (9002, "\n\n"), (9003, "only here"), (9004, "hot line")]


@pytest.mark.parametrize("rule", [L.Rule(), L.Rule(least_docs=1), L.Rule(least_docs=2, keep_first=True),
                                  L.Rule(least_chars=6, least_docs=12), L.Rule(least_chars=0, least_docs=3)])
def test_against_counting(docs, rule):
    rows = fixture(random.Random(3))
    assert results(L.dedup_lines(docs(rows, extra=True), rule)) == sorted(plain(rows, rule), key=repr)


@pytest.mark.parametrize("parts", [1, 23])
@pytest.mark.parametrize("first", [False, True])
def test_a_hash_over_many_ranges(spark, docs, parts, first):
    rows = [(i, "hot\n" * (1 + i % 3) + f"own {i}\npair {i // 2}") for i in range(400)]
    rule = L.Rule(least_docs=3, keep_first=first)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", str(parts))
    try:
        assert results(L.dedup_lines(docs(rows), rule)) == sorted(plain(rows, rule), key=repr)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_small_batches_decide_the_same(spark, docs):
    rows = fixture(random.Random(4), 60)
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, "3")
    try:
        for rule in (L.Rule(least_docs=4), L.Rule(least_docs=4, keep_first=True)):
            assert results(L.dedup_lines(docs(rows), rule)) == sorted(plain(rows, rule), key=repr)
    finally:
        spark.conf.set(name, before)


def test_repeated_rows_null_ids_and_none(docs):
    rows = [(5, "a\nb")] * 6 + [(None, "a\nc")] * 6 + [(None, None)]
    got = results(L.dedup_lines(docs(rows)))
    assert got == sorted([(5, 2, 1, "b")] * 6 + [(None, 2, 1, "c")] * 6 + [(None, 1, 0, "")], key=repr)
    # Equal rows are one document for the first place: all of them keep it.
    first = results(L.dedup_lines(docs(rows), L.Rule(keep_first=True)))
    assert first == sorted([(5, 2, 1, "b")] * 6 + [(None, 2, 0, "a\nc")] * 6 + [(None, 1, 0, "")], key=repr)
    assert L.dedup_lines(docs([])).collect() == []
    assert L.keep_bitmaps(docs([])).collect() == []


def test_bitmaps_tell_the_lines_and_long_texts_stay_whole(docs):
    long = "z" * 3_000_000
    rows = [(i, f"{long if i == 3 else i}\nfooter\n" + "\n" * 50_000 + "footer") for i in range(12)]
    maps = {r["doc_id"]: r for r in L.keep_bitmaps(docs(rows)).collect()}
    keep = L.unpacked(maps[3]["keep"], maps[3]["n_lines"])
    assert np.flatnonzero(~keep).tolist() == [1, 50_002] and maps[3]["n_lines"] == 50_003 and len(maps[3]["keep"]) < 200
    kept = {r["doc_id"]: r for r in L.apply_bitmaps(docs(rows), L.keep_bitmaps(docs(rows))).collect()}
    assert kept[3]["kept"] == long + "\n" + "\n" * 49_999 + "" and kept[3]["n_dropped"] == 2
