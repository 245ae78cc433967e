import base64
import random
from collections import Counter

import pytest

from corpusmill.llm import tokencounts as T


@pytest.fixture(scope="module")
def encode():
    import tiktoken

    with open(T.Tokenizer().path, "rb") as file:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}
    return tiktoken.Encoding("t", pat_str=T.PATTERN, mergeable_ranks=ranks, special_tokens={}).encode_ordinary


def check(hist, lengths):
    rows = {r["n_tokens"]: r for r in hist.collect()}
    count = Counter(lengths)
    assert set(rows) == set(count)
    for n, r in rows.items():
        assert r["n_docs"] == count[n]
        assert r["docs_at_least"] == sum(x >= n for x in lengths)
        assert r["tokens_at_least"] == sum(x for x in lengths if x >= n)
        assert r["truncated_total"] == sum(min(x, n) for x in lengths)
        assert r["quantile"] == pytest.approx(sum(x <= n for x in lengths) / len(lengths))


def test_counts_and_sums_of_texts(docs, encode):
    texts = ["hello world", "hello world", "", None, "<|endoftext|> é漢", "a" * 5000, "word " * 40_000, "it's\n\n  9.5"]
    df = docs(list(enumerate(texts)), extra=True)
    counted = T.lengths(df)
    assert counted.columns == [*df.columns, "_n_tokens"]
    want = {i: len(encode(t)) if t else 0 for i, t in enumerate(texts)}
    assert {r["doc_id"]: r["_n_tokens"] for r in counted.collect()} == want
    check(T.histogram(counted), list(want.values()))


def test_suffix_sums_limits_and_quantiles(spark):
    rng = random.Random(1)
    lengths = [int(2 ** rng.uniform(0, 40)) for _ in range(800)] + [0, 0, 2047, 2048, 2049] * 3
    hist = T.histogram(spark.createDataFrame([(x,) for x in lengths], "_n_tokens long"))
    check(hist, lengths)
    limits = [0, 1, 2048, 10**6, 2**41]
    got = {r["limit"]: (r["docs_longer"], r["truncated_total"]) for r in T.at_limits(hist, limits).collect()}
    assert got == {x: (sum(n > x for n in lengths), sum(min(n, x) for n in lengths)) for x in limits}
    ordered = sorted(lengths)
    for q in (0.01, 0.5, 0.99, 1.0):
        want = min(x for x in ordered if sum(n <= x for n in lengths) / len(lengths) >= q)
        assert T.quantile(hist, q).first()[0] == want


def test_long_white_space_is_cut_as_the_pattern_would(encode):
    rng = random.Random(4)
    with open(T.Tokenizer().path, "rb") as file:
        encoding = T._encoder(file.read(), T.PATTERN)
    for _ in range(300):
        parts = []
        for _ in range(rng.randrange(1, 6)):
            space = "".join(rng.choice(" \n\t\r\u00a0\u3000\x85") if rng.random() < 0.1 else " " for _ in range(
                rng.choice([1, 2, T.LONG_SPACE - 1, T.LONG_SPACE, T.LONG_SPACE + 1, 700])))
            parts += [rng.choice(["word", "it's", "9", "!?", "é漢", "'s", ""]), space]
        text = "".join(parts[rng.randrange(2):])
        assert T.counted(encoding, text) == len(encode(text)), repr(text)


def test_two_megabytes_of_every_class(docs):
    n = 2_000_000
    rows = [(i, c * n + end) for i, (c, end) in enumerate([(" ", ""), (" ", "x"), ("\n", "x"), ("\u3000", ""), ("a", ""), ("7", " "),
                                                          ("!", ""), ("é", ""), (" \n", "."), ("'s", ""), ("a ", "")])]
    got = {r["doc_id"]: r["_n_tokens"] for r in T.lengths(docs(rows)).collect()}
    assert len(got) == len(rows) and all(v > n // 100 for v in got.values())
    assert got[1] in (got[0], got[0] + 1) and got[10] == 2 * n or got[10] > n


def test_empty_table(docs):
    assert T.histogram(T.lengths(docs([]))).collect() == []
