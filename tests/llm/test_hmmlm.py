import itertools
import math
import random
import tracemalloc
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
import pytest

from corpusmill.llm import hmmlm as H
from corpusmill.llm.hmm import LOW, Hmm, cluster_sums, expected, expected_sums, log10_forward, maximise
from corpusmill.llm.wordcodes import words
from tests.llm.conftest import plain_words

END = object()


def model(rng, states=3, symbols=5):
    row = lambda *s: (lambda x: x / x.sum(axis=-1, keepdims=True))(rng.random(s) + 0.1)
    emit = rng.random((symbols, states)) + 0.1
    return Hmm(row(states), row(states, states), emit / emit.sum(axis=0))


def by_paths(m, begin, seq):
    """Probability and expected counts by listing every path of states."""
    k, total = len(m.begin), 0.0
    counts = [np.zeros(k), np.zeros((k, k)), np.zeros_like(m.emit)]
    for path in itertools.product(range(k), repeat=len(seq)):
        p = begin[path[0]]
        for t, s in enumerate(path):
            p *= m.emit[seq[t], s] * (m.move[path[t - 1], s] if t else 1)
        total += p
        counts[0][path[0]] += p
        for t, s in enumerate(path):
            counts[2][seq[t], s] += p
            if t:
                counts[1][path[t - 1], s] += p
    return total, [c / total for c in counts]


def test_forward_and_counts_match_all_paths():
    rng = np.random.default_rng(1)
    m = model(rng)
    seqs = [rng.integers(0, 5, n) for n in (1, 6, 3, 1, 5)]
    bounds = np.concatenate([[0], np.cumsum([len(s) for s in seqs])])
    flat = np.concatenate(seqs)
    got = log10_forward(m, flat, bounds)
    want = [by_paths(m, m.begin, s) for s in seqs]
    assert np.allclose(got, [math.log10(p) for p, _ in want])
    begin, move, emit, log = expected(m, flat, bounds)
    assert np.allclose(begin, sum(c[0] for _, c in want), rtol=1e-4)
    assert np.allclose(move, sum(c[1] for _, c in want), rtol=1e-4)
    assert np.allclose(emit, sum(c[2] for _, c in want), rtol=1e-4)
    assert abs(log - got.sum()) < 1e-3
    assert log10_forward(m, flat[:0], np.array([0, 0])).tolist() == [0.0]


def test_each_round_raises_the_likelihood():
    rng = np.random.default_rng(2)
    m, plain = model(rng, 2, 4), np.full(4, 0.25)
    seqs = [np.repeat(rng.integers(0, 4, 8), 4) for _ in range(30)]
    bounds, flat = np.concatenate([[0], np.cumsum([32] * 30)]), np.concatenate(seqs)
    before = -np.inf
    for _ in range(6):
        *counts, log = expected(m, flat, bounds)
        assert log > before - 0.5
        before, m = log, maximise(*counts, plain, 1e-6)


def test_sequences_do_not_depend_on_their_company():
    rng = np.random.default_rng(3)
    m = model(rng, 8, 50)
    seqs = [rng.integers(0, 50, n) for n in [1, 2, 3000, 40, 40, 7, 900, *rng.integers(1, 60, 200)]]
    flat, bounds = np.concatenate(seqs), np.concatenate([[0], np.cumsum([len(s) for s in seqs])])
    alone = [log10_forward(m, s, np.array([0, len(s)]))[0] for s in seqs]
    assert log10_forward(m, flat, bounds).tolist() == alone
    apart = sum(expected_sums(m, s, np.array([0, len(s)])) for s in seqs)
    k = len(m.begin)
    high, low = apart[2:2 + k], apart[2 + k:2 + 2 * k]
    apart[2:2 + k], apart[2 + k:2 + 2 * k] = high + (low >> LOW), low & ((1 << LOW) - 1)
    assert (expected_sums(m, flat, bounds) == apart).all()
    assert (cluster_sums(m.emit, flat, bounds) == sum(cluster_sums(m.emit, s, np.array([0, len(s)])) for s in seqs)).all()


def test_word_classes_look_at_the_last_bytes_only():
    w = words(pa.array(["singing ringing é a xa"]))
    c = H.word_class(w, 2048)
    assert c[0] == c[1] and (c >= 0).all() and (c < 2048).all()


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(4)
    common = {"en": "the of and to in".split(), "de": "der die und das in".split()}
    out = []
    for i in range(120):
        lang = ("en", "de")[i % 2]
        text = " ".join(rng.choice(common[lang]) if rng.random() < 0.7 else f"{lang}{rng.randrange(400)}"
                        for _ in range(rng.randrange(1, 200)))
        out.append((i, text))
    return out + [(500, None), (501, ""), (502, "THE  \n the"), (None, "the of"), (503, "never seen before"), (0, out[0][1])]


def test_base_score_and_counts_are_exact(docs, rows):
    p = H.HmmLm(states=2, share=1 / 200, classes=16, iterations=3, part_words=50)
    df = docs(rows, extra=True)
    got = H.score(df, p).collect()
    assert len(got) == len(rows)
    held = {i: i is not None and zlib.crc32(str(i).encode()) % 5 == 1 for i, _ in rows}
    count = Counter()
    for i, t in rows:
        if not held[i]:
            count.update([*plain_words(t), END])
    n, v = sum(count.values()), len(count)
    texts = {i: [*plain_words(t), END] for i, t in rows}
    for r in got:
        own = texts[r["doc_id"]]
        base = sum(math.log10((count[w] + 0.5) / (n + 0.5 * (v + 1))) for w in own)
        assert r["base_score"] == pytest.approx(base, rel=1e-9)
        assert (r["n_tokens"], r["n_known"], r["train_tokens"]) == (len(own), sum(count[w] > 0 for w in own), n)
        assert r["held_out"] == held[r["doc_id"]]
    out = [r for r in got if r["held_out"]]
    assert sum(r["score"] for r in out) > sum(r["base_score"] for r in out) + 0.1 * sum(r["n_tokens"] for r in out)


def test_reruns_agree(docs, rows):
    p = H.HmmLm(states=3, share=1 / 200, classes=16, iterations=2)
    df = docs(rows)
    one, two = ({(r["doc_id"], r["base_score"], r["score"]) for r in H.score(df, p).collect()} for _ in range(2))
    assert one == two


def test_scores_do_not_depend_on_the_layout(docs, small_docs):
    p = H.HmmLm(states=4, share=1 / 2000, classes=64, part_words=500)
    df = small_docs.select("doc_id", "text")
    found = [sorted((r["doc_id"], r["base_score"], r["score"]) for r in H.score(df.repartition(n), p).collect())
             for n in (1, 4, 23)]
    assert found[0] == found[1] == found[2]


def test_a_single_state_is_the_unigram_model(docs, rows):
    """With one state and no smoothing to speak of, the model's own unigram is left."""
    p = H.HmmLm(states=1, share=1 / 200, classes=1, iterations=1, strength=1e9)
    got = {r["doc_id"]: r for r in H.score(docs(rows), p).collect()}
    for r in got.values():
        assert r["score"] == pytest.approx(r["base_score"], rel=1e-3, abs=1e-2)


def test_nothing_to_learn_from(docs):
    assert H.score(docs([])).collect() == []
    only = next(i for i in range(100) if zlib.crc32(str(i).encode()) % 5 == 1)
    got = H.score(docs([(only, "a b"), (only, None)]), H.HmmLm(classes=16)).collect()
    assert [r["base_score"] for r in got] == [0.0, 0.0] and {r["train_tokens"] for r in got} == {0}
    assert all(math.isfinite(r["score"]) for r in got)


def test_a_task_learns_from_few_blocks_at_once():
    """Memory of forward-backward follows the symbols taken together, not the blocks of the task."""
    rng = np.random.default_rng(3)
    bounds = np.arange(0, 200_001, 100)
    block = rng.integers(0, 50, bounds[-1]).astype(np.uint16).tobytes()
    batch = pa.RecordBatch.from_arrays(
        [pa.array([[False] * (len(bounds) - 1)] * 8), pa.array([block] * 8, pa.binary()),
         pa.array([bounds.astype(np.int64).tobytes()] * 8, pa.binary())], names=["held", "what", "whose"])
    m = model(rng, 8, 50)
    tracemalloc.start()
    try:
        found = [expected_sums(m, s, b) for s, b in H._learning([batch])]
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert (sum(f[2 + 2 * 8:].sum() for f in found) / 2 ** 20) == pytest.approx(8 * 200_000, rel=1e-3)
    assert peak < 120e6


def test_learning_reads_no_codes_and_holds_few_blocks(spark):
    """A reader holds a row group's column at once, so row groups stay small and the codes have columns of their own."""
    p = H.HmmLm(part_words=1000)
    rows = spark.range(0, 20, 1, 1).selectExpr(
        "id AS doc_id", "id % 3 = 0 AS held_out",
        "array_join(transform(sequence(1, 100000), x -> concat(hex(x), if(x % 2 = 0, '', hex(id)))), ' ') AS text")
    words = H.count_words(rows, p)
    blocks = H.encode(rows, H.vocabulary(words, 20, p), p)
    assert blocks.where("(part = -1) != (codes IS NULL) OR (part = -1) != (what IS NOT NULL)").count() == 0
    assert blocks.where("part >= 0").selectExpr("sum(length(codes))").first()[0] == 20 * 100000 * 8
    largest = 0
    for file in blocks.inputFiles():
        groups = pq.ParquetFile(file.removeprefix("file://")).metadata
        largest = max(largest, *(groups.row_group(i).total_byte_size for i in range(groups.num_row_groups)))
    assert 0 < largest < 10e6
