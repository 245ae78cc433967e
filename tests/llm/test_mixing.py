import hashlib
import math
import random
import re

import pytest

from corpusmill.llm import mixing as M


def brute(rows):
    """``(size, source_size, target, taken)`` of every row, in plain Python."""
    size = [len(re.findall(r"[^\x20\x09-\x0D]+", t or "")) for _, t, _ in rows]
    names = sorted({s for *_, s in rows}, key=lambda s: (s is None, (s or "").encode()))
    total = {s: sum(n for n, r in zip(size, rows, strict=True) if r[2] == s) for s in names}
    weight = {s: (3, 1, 2)[i % 3] for i, s in enumerate(names)}
    target, free = {}, list(names)
    while True:  # cap what is above, share the rest out again
        left = 1.5 * sum(total.values()) - sum(target.values())
        share = {s: left * weight[s] / sum(weight[x] for x in free) for s in free}
        above = [s for s in free if share[s] > 2 * total[s]]
        if not above:
            target |= share
            break
        target |= {s: 2.0 * total[s] for s in above}
        free = [s for s in free if s not in above]
        if not free:
            break

    def key(i):
        doc_id, text, _ = rows[i]
        bits = int(hashlib.md5(("mix" + ("" if doc_id is None else str(doc_id))).encode()).hexdigest()[:13], 16)
        mean = len(text or "") / max(1, size[i])
        quality = 1 / (1 + abs(math.log(max(mean, 0.5) / 6)))
        return -math.log((bits + 0.5) / 2**52) / quality

    out = [None] * len(rows)
    for s in names:
        goal, before = math.floor(target[s] + 0.5), 0
        own = sorted((i for i in range(len(rows)) if rows[i][2] == s), key=lambda i: (
            key(i), (rows[i][0] is not None, rows[i][0] or 0), hashlib.md5((rows[i][1] or "").encode()).hexdigest()))
        epochs = goal // total[s] if total[s] else 0
        for i in own:
            part = max(0, min(size[i], goal - epochs * total[s] - before))
            out[i] = (size[i], total[s], target[s], epochs * size[i] + part)
            before += size[i]
    return out


def make(rng, sources):
    return [(i, " ".join("x" * rng.randrange(1, 12) for _ in range(rng.randrange(0, 60))), s)
            for i, s in enumerate(rng.choice(sources) for _ in range(150))]


@pytest.mark.parametrize("sources", [["a", "a", "a", "a", "b", "Z", "é", None], ["only"],
                                     ["s1", *["s2"] * 30, *["s3"] * 3, "s4", "s10"]])
def test_results_match_a_plain_walk(docs, sources):
    rows = make(random.Random(len(sources)), sources)
    rows += [(900, None, sources[0]), (901, "", sources[0]), (902, "one", "empty?"), (903, None, "void"), (3, rows[3][1], rows[3][2]),
             (None, "no id here", sources[0])]
    df = docs([(i, t, None, s) for i, t, s in rows], extra=True)
    got = sorted((r["doc_id"] is None, r["doc_id"] or 0, r["size"], r["source_size"], round(r["target"], 6), r["taken"])
                 for r in M.mix(df).collect())
    want = sorted((i is None, i or 0, a, b, round(c, 6), d) for (i, _, _), (a, b, c, d) in zip(rows, brute(rows), strict=True))
    assert got == want
    assert all(r[5] <= 2 * r[2] for r in got)


def test_budgets_are_met(docs):
    rows = make(random.Random(9), ["a", "b", "c", "c", "c"])
    got = M.mix(docs([(i, t, None, s) for i, t, s in rows])).collect()
    for s in "abc":
        own = [r for r in got if r["source"] == s]
        assert abs(sum(r["taken"] for r in own) - own[0]["target"]) <= 0.5


def test_better_documents_come_first_more_often(spark):
    from pyspark.sql import functions as F
    keys = spark.range(4000).select("id", M.exponential_key(F.col("id"), F.when(F.col("id") % 2 == 0, 1.0).otherwise(0.25), "s").alias("k"))
    first = keys.orderBy("k").limit(500).where("id % 2 = 0").count()
    assert 350 < first < 450  # four to one


def test_mixed_rows_keep_their_columns(docs):
    rows = make(random.Random(5), ["a", "b"])
    rows += [rows[0], (None, "x y", "a")]
    df = docs([(i, t, None, s) for i, t, s in rows], extra=False)
    left = M.mixed(df)
    assert left.columns == [*df.columns, "size", "source_size", "target", "taken"]
    want = {}
    for (i, t, _), r in zip(rows, brute(rows), strict=True):
        want[(i, t)] = want.get((i, t), 0) + r[3]
    assert {(r["doc_id"], r["text"]): r["taken"] for r in left.collect()} == {k: v for k, v in want.items() if v}


def test_empty_table(docs):
    assert M.mix(docs([])).collect() == [] and M.mixed(docs([])).collect() == []
