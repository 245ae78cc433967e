import hashlib
import random
import re

import numpy as np
import pyarrow as pa

from corpusmill.llm import decontaminate as D
from corpusmill.llm.fmindex import FmIndex, WaveletMatrix, suffix_order
from corpusmill.llm.wordcodes import ALNUM, words

LOW = {i: i + 32 for i in range(65, 91)}
RESULT = ("n_words", "n_hit", "n_items", "items_sha256", "contaminated")


def split(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LOW))


def brute(text, items, size=13):
    w, hit, named = split(text), set(), set()
    for name, item in items:
        own = split(item)
        for k in range(len(own) - min(size, len(own)) + 1 if own else 0):
            window = own[k:k + size]
            for i in range(len(w) - len(window) + 1):
                if w[i:i + len(window)] == window:
                    hit |= set(range(i, i + len(window)))
                    if name is not None:
                        named.add(str(name))
    digest = hashlib.sha256(",".join(sorted(named)).encode()).hexdigest()
    return len(w), len(hit), len(named), digest, bool(hit) and 20 * len(hit) >= len(w)


def test_wavelet_ranks():
    rng = np.random.default_rng(1)
    values = rng.integers(0, 37, 500)
    c, i = rng.integers(0, 38, 300), rng.integers(0, 501, 300)
    assert WaveletMatrix(values, 37).rank(c, i).tolist() == [int((values[:b] == a).sum()) for a, b in zip(c, i, strict=True)]


def test_index_finds_every_occurrence():
    rng = np.random.default_rng(2)
    for n in (1, 5, 300):
        text = np.append(rng.integers(0, 4, n), 0)
        index = FmIndex(text, 3, sample=4)
        assert sorted(suffix_order(text)) == list(range(n + 1))
        patterns = np.zeros((60, 5), dtype=np.int64)
        length = rng.integers(1, 6, 60)
        for k, m in enumerate(length):
            patterns[k, 5 - m:] = rng.integers(1, 4, m)
        low, high = index.search(patterns, length)
        for k, m in enumerate(length):
            want = [i for i in range(n + 2 - m) if (text[i:i + m] == patterns[k, 5 - m:]).all()]
            assert sorted(index.locate(np.arange(low[k], high[k]))) == want if high[k] > low[k] else not want


def make(rng):
    vocabulary = [f"v{i}" for i in range(30)]
    say = lambda n: " ".join(rng.choice(vocabulary) for _ in range(n))
    items = [(i, say(rng.randrange(10, 40))) for i in range(12)]
    items += [(20, "Short item, here!"), (21, "short ITEM here"), (22, None), (23, " . "), (None, say(15)), (3, items[0][1]),
              (24, "é漢 ünï")]
    texts = [say(rng.randrange(0, 200)) for _ in range(20)]
    texts += [f"{say(30)} {t}, {say(rng.randrange(400))}" for _, t in items if t]
    texts += [f"{items[1][1]} {items[1][1]} {items[2][1]}", None, "", "...", "one SHORT item  here", "short item", "É漢 ÜNÏ é漢 ünï"]
    texts += [texts[-3]] * 2
    return items, list(enumerate(texts))


def test_results_match_brute_force_for_any_blocks(spark, docs):
    items, rows = make(random.Random(5))
    bench = spark.createDataFrame(items, "item_id long, text string")
    for p in (D.Decontaminate(), D.Decontaminate(block_chars=300)):
        got = {r["doc_id"]: r for r in D.report(docs(rows, extra=True), bench, p).collect()}
        assert len(got) == len(rows)
        for i, text in rows:
            assert tuple(got[i][c] for c in RESULT) == brute(text, items), (i, text)
            cut = sum(len(split(text[s["start"]:s["end"]])) for s in got[i]["spans"])
            assert cut == got[i]["n_hit"]


def test_filter_keeps_clean_rows_and_columns(spark, docs):
    items, rows = make(random.Random(6))
    bench = spark.createDataFrame(items, "item_id long, text string")
    df = docs(rows, extra=True)
    left = D.drop_contaminated(df, bench)
    assert left.columns == df.columns
    assert sorted(r["doc_id"] for r in left.collect()) == [i for i, t in rows if not brute(t, items)[4]]


def test_empty_sides_and_null_ids(spark, docs):
    none = spark.createDataFrame([], "item_id long, text string")
    some = spark.createDataFrame([(1, "a b c")], "item_id long, text string")
    assert [tuple(r)[1:6] for r in D.report(docs([(1, "a b c")]), none).collect()] == [brute("a b c", [])]
    assert D.report(docs([]), some).collect() == []
    got = D.report(docs([(None, "x a b c"), (None, "x a b c")]), some).collect()
    assert [(r["doc_id"], r["n_hit"], r["contaminated"]) for r in got] == [(None, 3, True)] * 2


def test_a_long_text_of_known_words_only():
    rng = random.Random(1)
    vocabulary = [f"v{i}" for i in range(50)]
    item = " ".join(rng.choice(vocabulary) for _ in range(400))
    text = " ".join(rng.choice(vocabulary) for _ in range(50_000)) + " " + item
    b = D.windows([item], ["1"], 13)
    w, hit, pairs = D.find(pa.array([text, "v1 v2", text]), b, 8)
    assert hit[w.bounds[0]:w.bounds[1]].sum() == 400 and hit[w.bounds[2]:].sum() == 400
    assert sorted(set(pairs[0])) == [0, 2] and len(words(pa.array([text]), ALNUM).code) == 50_400
