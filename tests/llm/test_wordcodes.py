import re

import numpy as np
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st

from corpusmill.llm import wordcodes as W
from corpusmill.llm.letters import lower_letters

LOW = {i: i + 32 for i in range(65, 91)}
TEXTS = st.lists(st.one_of(st.none(), st.text(alphabet="aAbZ zé\t\n.9-漢\U0001F600", max_size=40)), max_size=8)


@settings(max_examples=60, deadline=None)
@given(TEXTS)
def test_words_match_the_patterns(texts):
    for table, pattern in ((W.UNSPACED, r"[^\x20\x09-\x0D]+"), (W.ALNUM, r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")):
        w = W.words(pa.array(texts, pa.string()), table)
        expected = [re.findall(pattern, (t or "").translate(LOW)) for t in texts]
        raw = w.data.tobytes()
        found = [[raw[w.start[i]:w.end[i]].decode() for i in range(a, b)]
                 for a, b in zip(w.bounds[:-1], w.bounds[1:], strict=True)]
        assert found == expected
        flat = [x for e in expected for x in e]
        assert len(set(flat)) == len(set(w.code.tolist()))
        assert len({*zip(flat, w.code.tolist(), strict=True)}) == len(set(flat))


def test_codes_do_not_depend_on_position_or_block(monkeypatch):
    texts = ["alpha beta " * 50 + "x" * 300, "beta alpha"]
    whole = W.words(pa.array(texts)).code
    monkeypatch.setattr(W, "BLOCK", 64)
    assert (W.words(pa.array(texts)).code == whole).all()
    assert whole[0] == whole[-1] and whole[1] == whole[-2]


@settings(max_examples=60, deadline=None)
@given(TEXTS, st.integers(1, 5))
def test_shingles_and_distinct(texts, size):
    w = W.words(pa.array(texts, pa.string()))
    codes, bounds = W.distinct(*W.shingles(w, size))
    for i, t in enumerate(texts):
        own = re.findall(r"[^\x20\x09-\x0D]+", (t or "").translate(LOW))
        expected = {tuple(own[k:k + size]) for k in range(max(1, len(own) - size + 1))} if own else set()
        got = codes[bounds[i]:bounds[i + 1]]
        assert len(got) == len(expected) and (np.diff(got.astype(object)) > 0).all()


def test_slices_and_chunks_keep_rows():
    batch = pa.record_batch([pa.array(["a b", None, "", "c" * 50, "d e f"]), pa.array([1, 2, 3, 4, 5])],
                            names=["text", "id"]).slice(1)
    parts = list(W.chunks([batch], "text", size=10))
    assert [x for p in parts for x in p.column(1).to_pylist()] == [2, 3, 4, 5]
    assert [W.words(p.column(0)).counts.tolist() for p in parts] == [[0, 0], [1], [3]]


def test_letters_by_code_point():
    points, at = lower_letters(pa.array(["Äb1", None, "\U0001F600ß"]))
    assert at.tolist() == [0, 3, 3, 5]
    assert [chr(p) if p else "" for p in points] == ["ä", "b", "", "", "ß"]
