import base64
import hashlib
import random

import numpy as np

from corpusmill.llm import fingerprint as P
from tests.llm.conftest import plain_words


def shingle_set(text):
    w = plain_words(text)
    return {tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def jaccard(a, b):
    return len(a & b) / len(a | b) if a | b else 1.0


def rows(rng, n=60):
    out = [(i * 3, " ".join(f"w{rng.randrange(3000)}" for _ in range(rng.randrange(0, 900)))) for i in range(n)]
    return out + [(1000, "short é\U0001F600 text"), (1001, ""), (1002, None), (1003, out[5][1]), (1004, out[5][1])]


def test_edits_order_and_likeness(docs):
    data = rows(random.Random(2))
    ordered = sorted(data, key=lambda r: -r[0])
    got = {r["doc_id"]: r for r in P.fingerprints(docs(data, extra=True)).collect()}
    assert len(got) == len(data)
    errors = []
    for k, (i, text) in enumerate(ordered):
        text, after = text or "", ordered[(k + 1) % len(ordered)][1] or ""
        cut = len(text) // 3
        changed = text[:len(text) - cut] + after[:cut]
        r = got[i]
        assert r["n_chars"] == len(text)
        assert r["edited_sha256"] == hashlib.sha256(changed.encode()).hexdigest()
        errors.append(abs(r["near_edited"] - jaccard(shingle_set(text), shingle_set(changed))))
        errors.append(abs(r["near_next"] - jaccard(shingle_set(text), shingle_set(after))))
        assert (r["fingerprint"] == "") == (not plain_words(text))
    assert max(errors) < 0.3 and sum(errors) / len(errors) < 0.04
    assert got[1003]["fingerprint"] == got[1004]["fingerprint"] == got[15]["fingerprint"]
    assert got[1004]["near_next"] == 1.0


def test_sketches_keep_all_hashes_below_the_threshold_and_merge():
    rng = random.Random(3)
    p = P.Sketch(scale=4, least=8)
    texts = [" ".join(f"w{rng.randrange(10**6)}" for _ in range(n)) for n in (3, 10, 500, 4000)]
    every = P.sketches(texts, P.Sketch(scale=1, least=8))
    for all_, kept in zip(every, P.sketches(texts, p), strict=True):
        below = all_[all_ <= np.uint64(2**62 - 1)]
        assert kept.tolist() == (below if len(below) >= 8 else all_[:8]).tolist()
    a, b = P.sketches(texts[2:], p)
    joint = np.union1d(every[2], every[3])
    assert P.merged(a, b, p).tolist() == joint[joint <= np.uint64(2**62 - 1)].tolist()
    assert np.frombuffer(base64.b64decode(P.written(a)), ">u8").tolist() == a.tolist()


def test_containment_between_unequal_texts():
    rng = random.Random(4)
    p = P.Sketch()
    large = [f"w{rng.randrange(10**6)}" for _ in range(60_000)]
    a, b = P.sketches([" ".join(large[:3000]), " ".join(large)], p)
    near, inside = P.likeness(a, b, p)
    assert inside == 1.0 and abs(near - 0.05) < 0.01


def test_ties_nulls_one_row_and_none(docs):
    got = P.fingerprints(docs([(None, "a b c d e f"), (None, "z y"), (4, "k l m"), (4, "k l m"), (4, None)])).collect()
    assert len(got) == 5 and sorted(r["n_chars"] for r in got) == [0, 3, 5, 5, 11]
    assert P.fingerprints(docs([])).collect() == []
    only = P.fingerprints(docs([(1, "abcdef")])).collect()
    assert [r["near_next"] for r in only] == [1.0]
    assert only[0]["edited_sha256"] == hashlib.sha256(b"abcdab").hexdigest()


def test_every_document_once_without_exchange_reuse_and_with_empty_ranges(spark, docs):
    rng = random.Random(9)
    data = [(i, " ".join(f"w{rng.randrange(500)}" for _ in range(30))) for i in range(3000)] + [(7, None), (7, "x")]
    before = [spark.conf.get(k) for k in ("spark.sql.exchange.reuse", "spark.sql.shuffle.partitions")]
    found = []
    try:
        for reuse, parts in (("true", "3"), ("false", "3"), ("false", "41")):
            spark.conf.set("spark.sql.exchange.reuse", reuse)
            spark.conf.set("spark.sql.shuffle.partitions", parts)
            found.append(sorted(tuple(r) for r in P.fingerprints(docs(data)).collect()))
    finally:
        spark.conf.set("spark.sql.exchange.reuse", before[0])
        spark.conf.set("spark.sql.shuffle.partitions", before[1])
    assert [r[0] for r in found[0]] == sorted(i for i, _ in data)
    assert found[0] == found[1] == found[2]
