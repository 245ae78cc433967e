import math
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa

from corpusmill.llm import langid as L
from corpusmill.llm.queries import QUERIES

SF = "/root/testdata/sf0.01"


def grams(text, bits):
    """The buckets of a text, one letter at a time."""
    low = [c.lower() if c.isalpha() and len(c.lower()) == 1 else c if c.isalpha() else "" for c in text or ""]
    out = []
    for i, c in enumerate(low):
        if not c:
            continue
        a = ord(low[i - 1]) if i and low[i - 1] else 0
        d = ord(low[i + 1]) if i + 1 < len(low) and low[i + 1] else 0
        for x, m in ((ord(c), 0xD6E8FEB86659FD93), (ord(c) + (a << 21) + (1 << 60), 0xD6E8FEB86659FD93),
                     (ord(c) + (a << 21) + (d << 42) + (1 << 63), 0xA0761D6478BD642F)):
            out.append((x * m % 2**64) >> (64 - bits))
    return out


def test_features_match_a_plain_loop():
    texts = ["Ab c", None, "", "é1漢x", "nd.", "z"]
    one, two, three, bounds = L.features(pa.array(texts), 12)
    for i, t in enumerate(texts):
        got = np.stack([one, two, three], axis=1)[bounds[i]:bounds[i + 1]].reshape(-1).tolist()
        assert got == grams(t, 12)


def test_model_and_scores_match_plain_naive_bayes(docs):
    rows = [(i, t, g) for i, (t, g) in enumerate([
        ("the cat and the dog", "en"), ("der hund und die katze", "de"), ("le chat et le chien", "fr"),
        ("that is a thing of the house", "en"), ("das ist ein haus", "de"), ("c'est une maison", "fr"),
        ("mystery", None), (None, "en"), ("", "de"), ("123 456", "fr")] * 3)]
    p = L.LangId(bits=12)
    got = {r["doc_id"]: r for r in L.identify(docs(rows, extra=True), p).collect()}
    held = {i: zlib.crc32(str(i).encode()) % 4 == 2 for i, _, _ in rows}
    counts, prior = {}, Counter()
    for i, t, g in rows:
        if g and not held[i]:
            prior[g] += 1
            counts.setdefault(g, Counter()).update(grams(t, 12))
    for i, t, _ in rows:
        assert got[i]["held_out"] == held[i]
        if not grams(t, 12):
            assert (got[i]["lang_pred"], got[i]["score"]) == ("und", 0.0)
            continue
        logs = {g: math.log(prior[g] / sum(prior.values())) + sum(
            math.log((c[b] + 0.5) / (sum(c.values()) + 0.5 * 4096)) for b in grams(t, 12)) for g, c in counts.items()}
        best = max(sorted(logs), key=logs.get)
        assert got[i]["lang_pred"] == best
        assert abs(got[i]["score"] - 1 / sum(math.exp(x - logs[best]) for x in logs.values())) < 1e-4


def test_held_out_accuracy_and_whole_table(spark):
    truth = {r["doc_id"]: r["lang"] for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    got = QUERIES["op4_language_id"](spark, SF).collect()
    assert {r["doc_id"] for r in got} == set(truth) and len(got) == len(truth)
    held = [r for r in got if r["held_out"]]
    assert held and sum(truth[r["doc_id"]] == r["lang_pred"] for r in held) >= 0.97 * len(held)
    assert all(0 <= r["score"] <= 1 for r in got)


def test_nothing_to_learn_from_and_long_texts(docs):
    got = L.identify(docs([(1, "text without a language"), (None, None)])).collect()
    assert [(r["lang_pred"], r["score"]) for r in got] == [("und", 0.0)] * 2
    assert L.identify(docs([])).collect() == []
    rows = [(i, "und der die das " * 5, "de") for i in range(8)] + [(i, "and the of that " * 5, "en") for i in range(8, 16)]
    got = L.identify(docs([*rows, (99, "the and of " * 200_000), (99, "the and of " * 200_000)])).collect()
    assert [r["lang_pred"] for r in got if r["doc_id"] == 99] == ["en", "en"]


def test_sample_is_bounded_per_language(docs):
    rows = [(i, "der die das", "de") for i in range(400)] + [(1000 + i, "and the of", "en") for i in range(20)]
    model = L.train(docs(rows), L.LangId(per_language=50))
    assert model.languages == ["de", "en"]
    assert np.allclose(np.exp(model.prior), [400 / 420, 20 / 420])


def test_filter_drops_rows_without_language_only(docs):
    rows = [(i, "der die das und", "de") for i in range(12)] + [(50, "..."), (51, None), (52, "und das")]
    df = docs(rows, extra=True)
    left = L.keep_identified(df)
    assert left.columns == df.columns
    assert sorted(r["doc_id"] for r in left.collect()) == [*range(12), 52]


def test_two_thousand_languages_by_plain_naive_bayes(docs):
    """Parts of a few languages, against the same model in dictionaries."""
    import random
    rng = random.Random(9)
    words = ["".join(rng.choice("abcdefghijklmnop") for _ in range(rng.randrange(2, 7))) for _ in range(400)]
    rows = []
    for i in range(4000):
        rows.append((i, " ".join(rng.choice(words) for _ in range(rng.randrange(1, 6))), f"l{i % 2000:04d}" if i % 50 else None))
    rows += [(5000, None, "l0001"), (5001, "...", "l0002"), (5002, "abc", "l0003")]
    p = L.LangId(bits=10, max_bytes=200_000)
    df = docs(rows, extra=True)
    got = {r["doc_id"]: r for r in L.identify(df, p).collect()}
    assert len(got) == len(rows) and len(list(L.parts_of(df, p))) > 1
    held = {i: zlib.crc32(str(i).encode()) % 4 == 2 for i, _, _ in rows}
    counts, prior = {}, Counter()
    for i, t, g in rows:
        if g and not held[i]:
            prior[g] += 1
            counts.setdefault(g, Counter()).update(grams(t, 10))
    total = sum(prior.values())
    sums = {g: sum(c.values()) + 0.5 * 1024 for g, c in counts.items()}
    for i, t, _ in rows[::97] + rows[-3:]:
        own = grams(t, 10)
        if not own:
            assert (got[i]["lang_pred"], got[i]["score"]) == ("und", 0.0)
            continue
        logs = {g: math.log(prior[g] / total) + sum(math.log((c[b] + 0.5) / sums[g]) for b in own) for g, c in counts.items()}
        best = max(logs.values())
        assert logs[got[i]["lang_pred"]] > best - 1e-9
        assert abs(got[i]["score"] - 1 / sum(math.exp(x - best) for x in logs.values())) < 1e-9


def test_parts_and_the_whole_matrix_agree(docs):
    rows = [(i, t, g) for i, (t, g) in enumerate([("the cat and the dog", "en"), ("der hund und die katze", "de"),
                                                  ("le chat et le chien", "fr"), ("mystery", None), ("", "de")] * 6)]
    df = docs(rows)
    whole, parts = (sorted((tuple(r) for r in L.identify(df, p).collect()), key=repr)
                    for p in (L.LangId(bits=12), L.LangId(bits=12, dense=0, max_bytes=1)))
    for a, b in zip(whole, parts, strict=True):
        assert a[:3] == b[:3] and abs(a[3] - b[3]) < 1e-4


def test_filter_keeps_columns_of_any_name(docs):
    from pyspark.sql import functions as F
    rows = [(i, "der die das und", "de") for i in range(12)]
    names = ["_lang_pred", "_lang_score", "lang_pred", "_LANG_SCORE_top", "b", "l"]
    df = docs(rows).withColumns({n: F.concat(F.lit(n), F.col("doc_id").cast("string")) for n in names})
    out = L.keep_identified(df).collect()
    assert len(out) == 12 and all(r[n] == f"{n}{r['doc_id']}" for r in out for n in names)
