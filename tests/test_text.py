import random
import re

import pytest
from pyspark.sql import functions as F

from corpusmill.functions import text as X
from corpusmill.operators import tokens as W
from corpusmill.sources.texts import read_text_files

RAW = """Catalogue page of a shop, with prices
***START OF THIS PROJECT GUTENBERG E-BOOK Two Walks***

=Morning=

The gate [it was
painted green] stood open, and _nobody_
had come
through.
----- *** -----
At noon it rained.
  So we turned back [twice].


*** end of the project gutenberg ebook Two Walks
Prices may change.
"""


def test_strip_and_clean(one):
    body = one(X.strip_boilerplate, RAW)
    assert body.startswith("\n\n=Morning=") and body.endswith("[twice].\n\n\n")
    assert one(X.clean_text, body) == ("Morning\n\nThe gate stood open, and nobody had come through.\n\n"
                                       "At noon it rained. So we turned back .")


@pytest.mark.parametrize("raw, body", [
    ("Nur Text.", "Nur Text."), ("", ""),
    ("a *** START OF THIS PROJECT GUTENBERG E-BOOK X***\nb", "\nb"),
    ("*** END OF THE PROJECT GUTENBERG EBOOK\n*** START OF THE PROJECT GUTENBERG EBOOK\nb", ""),
    ("*** START OF THE PROJECT GUTENBERG EBOOK X ***\nEND OF THE PROJECT GUTENBERG EBOOK", ""),
    ("\U0001f600\U0001f600 *** start of the project gutenberg ebook\nä\U0001f600b***END OF THIS PROJECT GUTENBERG EBOOK",
     "\nä\U0001f600b"),
])
def test_markers(one, raw, body):
    assert one(X.strip_boilerplate, raw) == body


@pytest.mark.parametrize("text, clean", [
    ("a\r\nb\r\n\r\nc", "a b\n\nc"), ("a [n [x] y] b", "a [n y] b"), ("[" + "x" * 1001 + "]", "[" + "x" * 1001 + "]"),
    ("a\n-----\nb", "a\n\nb"), ("a  b \x1c c", "a b c"), ("a\n \t\n\n\x0bb", "a\n\nb"), ("\n\n a \n\n", "a"),
    ("=a= _b_", "a b"), ("...", ""), ("a ... b", "a ... b"), ("a \n \nb", "a\n\nb"), ("a\x1eb", "a b"),
])
def test_clean(one, text, clean):
    assert one(X.clean_text, text) == clean


def test_counts(one):
    assert one(X.count_words, "ein  zwei\ndrei") == 3
    assert one(X.count_words, "") == 0
    assert one(X.count_clean_words, "ein zwei\n\ndrei") == 3
    assert one(X.count_clean_words, "") == 0


def tidy_model(text):
    """Cleaning as a walk over lines, for texts without brackets."""
    paragraphs, current = [], []
    for line in text.split("\n"):
        if line.strip() and not line.strip(" \t*-.=_~ \x1c"):
            line = ""
        words = [w for w in line.replace("_", "").replace("=", "").split()]
        if not line.strip():
            paragraphs.append(current)
            current = []
        current.extend(words)
    return "\n\n".join(" ".join(p) for p in paragraphs + [current] if p)


def test_clean_agrees_with_a_line_walk(spark):
    rng = random.Random(3)
    pieces = ["wort", "Ä\U0001f600", " ", "  ", "\n", "\n\n", "\n \n", "\t", "_", " ", "\x1c", ".", "x-y"]
    texts = ["".join(rng.choice(pieces) for _ in range(rng.randint(0, 40))) for _ in range(600)]
    rows = spark.createDataFrame(list(enumerate(texts)), "id int, t string")
    got = {r["id"]: r for r in rows.select("id", X.clean_text(F.col("t")).alias("c")).select(
        "id", "c", X.count_words(F.col("c")).alias("n"), X.count_clean_words(F.col("c")).alias("m")).collect()}
    for i, t in enumerate(texts):
        # Markup alone on a line leaves an empty line behind, as a separator does.
        assert got[i]["c"] == tidy_model(t), repr(t)
        assert got[i]["n"] == got[i]["m"] == len(got[i]["c"].split())


def sample_model(pars, skip, size):
    """The passage by flat word positions."""
    flat = [(i, w) for i, p in enumerate(pars) for w in p]
    target = int(len(flat) * skip)
    first = next((i for i in range(len(pars)) if sum(map(len, pars[:i])) >= target), len(pars))
    taken = [(i, w) for i, w in flat if i >= first][:size]
    if len(taken) < size:
        return None
    return "\n\n".join(" ".join(w for j, w in taken if j == i) for i in sorted({i for i, _ in taken}))


def test_sample_golden(spark):
    text = "\n\n".join(f"p{i} " + " ".join(["wort"] * 9) for i in range(10))
    rows = spark.createDataFrame([(text,), ("zu kurz",)], "c string")
    first = X.with_sample(rows, "c", skip_fraction=0.2, sample_words=25).collect()[0]["sample"]
    assert len(first.split()) == 25 and first.startswith("p2 ")
    assert X.with_sample(rows, "c", skip_fraction=0.0, sample_words=100).collect()[1]["sample"] is None


def test_sample_agrees_with_word_positions(spark):
    rng = random.Random(5)
    texts = [[[f"w{rng.randint(0, 99)}" for _ in range(rng.randint(1, 7))] for _ in range(rng.randint(0, 9))]
             for _ in range(300)]
    rows = spark.createDataFrame([(i, "\n\n".join(" ".join(p) for p in t)) for i, t in enumerate(texts)],
                                 "id int, raw string")
    for skip, size in ((0.0, 1), (0.1, 5), (0.35, 10), (0.9, 3)):
        got = {r["id"]: r["sample"] for r in X.with_sample(rows, "raw", skip_fraction=skip, sample_words=size).collect()}
        assert got == {i: sample_model(t, skip, size) for i, t in enumerate(texts)}
        pars = W.sample_paragraphs(W.paragraph_table(rows, doc_id="id", raw="raw"), skip_fraction=skip, sample_words=size)
        joined = {}
        for r in sorted(pars.collect()):
            joined.setdefault(r["doc_id"], []).append(r["text"])
        assert {i: "\n\n".join(p) for i, p in joined.items()} == {i: s for i, s in got.items() if s is not None}


def test_text_files(spark, tmp_path, one):
    (tmp_path / "12.txt").write_bytes("ä\r\nb".encode())
    (tmp_path / "7.txt").write_bytes(b"")
    (tmp_path / "note.txt").write_bytes(b"x")
    (tmp_path / "3.html").write_bytes(b"x")
    got = {r["id"]: r["raw"] for r in read_text_files(spark, str(tmp_path)).collect()}
    assert got == {12: "ä\nb", 7: ""} or got == {12: "ä\nb"}


def test_patterns_are_linear_enough():
    assert not re.search(r"\.\*\?", X.START_MARK + X.END_MARK)


def test_paragraph_samples_clean_a_text_once(spark):
    """The totals of a sample read written paragraphs, and no text is cleaned again for them."""
    rows = spark.createDataFrame([(1, "eins zwei\n\ndrei vier fünf\n\nsechs")], "id long, raw string")
    found = W.sample_paragraphs(W.paragraph_table(rows, doc_id="id", raw="raw"), skip_fraction=0.2, sample_words=3)
    assert [tuple(r) for r in found.orderBy("par").collect()] == [(1, 1, "drei vier fünf")]
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert "regexp" not in plan
