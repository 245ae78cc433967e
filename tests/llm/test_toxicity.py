import random
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from corpusmill.llm import automaton as A
from corpusmill.llm import toxicity as T
from corpusmill.llm.langid import held_out
from corpusmill.llm.queries import QUERIES

SF = "/root/testdata/sf0.01"


def levenshtein(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def verdicts(a, words):
    symbols = np.array([a.symbols.find(c) + 1 for w in words for c in w], dtype=np.int64)
    ends = np.cumsum([len(w) for w in words])
    verdict, term = A.judge(a, symbols, ends - [len(w) for w in words], ends)
    return list(zip(verdict.tolist(), term.tolist(), strict=True))


def expected(word, words, stems, harmless):
    if word in words:
        return A.WORD
    if any(word.startswith(s) for s in stems):
        return A.STEM
    if word in harmless:
        return A.NOTHING
    found = [9]
    for w in words:
        d = levenshtein(word, w)
        if 0 < d <= A.edits_allowed(w):
            found.append((0, A.WORD_1, A.WORD_2)[d])
    for s in stems:
        if min(1, A.edits_allowed(s)) and min(levenshtein(word[:k], s) for k in range(len(word) + 1)) <= 1:
            found.append(A.STEM_1)
    return min(found) if min(found) < 9 else A.NOTHING


def test_automaton_matches_edit_distances():
    rng = random.Random(3)
    words, stems, harmless = ["abcde", "bacabaca", "cab", "deabc"], ["ebcad", "dd"], ["abcdd", "acabaca"]
    a = A.build(words, stems, (), harmless)
    tried = set(words + harmless)
    for w in words + stems:
        for _ in range(300):
            x = list(w)
            for _ in range(rng.randrange(4)):
                at = rng.randrange(len(x) + 1)
                x[at:at + rng.randrange(2)] = rng.choice(["", *"abcdex"])
            tried.add("".join(x))
    tried = sorted(t for t in tried if t)
    for word, (verdict, _) in zip(tried, verdicts(a, tried), strict=True):
        assert verdict == expected(word, words, stems, harmless), word


def test_terms_and_strict_terms():
    a = A.build(["idiot", "clown"], ["lowei"], strict=["lowei", "clown"])
    assert verdicts(a, ["idiot", "idot", "clown", "clwn", "loweixyz", "lowe", "fine"]) == [
        (A.WORD, 0), (A.WORD_1, 0), (A.WORD, 1), (0, -1), (A.STEM, 2), (0, -1), (0, -1)]
    assert verdicts(A.build([], []), ["any", "x"]) == [(0, -1)] * 2


def corpus(rng, n=400):
    clean = [f"{a}{b}" for a in "ba de fi go lu".split() for b in "ran tel mos kip vun".split()]
    bad = ["gristle", "numpty", "slackjaw"]
    rows, labels = [], []
    for i in range(n):
        words = [rng.choice(clean) for _ in range(rng.randrange(5, 60))]
        toxic = i % 5 == 0
        for _ in range(rng.randrange(2, 5) if toxic else 0):
            words.insert(rng.randrange(len(words)), rng.choice(bad))
        rows.append((i, " ".join(words)))
        labels.append((i, 1, int(toxic)))
    return rows, labels


def test_learns_words_and_catches_misspellings(spark, docs):
    rows, labels = corpus(random.Random(1))
    rows += [(9000, "batel the numppty and gristel ran"), (9001, "deran batel fimos"), (9002, ""), (9003, None),
             (None, "gristle numpty"), (9004, "numpty " * 100_000)]
    lab = spark.createDataFrame([*labels, (3, 1, None), (4, 1, 0), (4, 1, 0), (None, 0, 1)],
                                "doc_id long, quality int, toxic int")
    df = docs(rows, extra=True)
    model = T.train(df, lab.where(~held_out(F.col("doc_id"))).select("doc_id", "toxic"))
    known = [t for t in ("gristle", "numpty", "slackjaw") if t in model.words or t.startswith(tuple(model.stems))]
    assert len(known) == 3
    got = {r["doc_id"]: r for r in T.toxicity(df, lab).collect()}
    assert len(got) == len(rows)
    truth = {i: t for i, _, t in labels}
    for i, t in truth.items():
        assert got[i]["predicted"] == t, (i, got[i])
        assert got[i]["held_out"] == (zlib.crc32(str(i).encode()) % 4 == 2)
    assert got[9001]["score"] == got[9002]["score"] == got[9003]["score"] < 0.3
    assert got[None]["predicted"] == 1 and not got[None]["held_out"]
    assert got[9004]["predicted"] == 1
    assert got[9000]["score"] > got[9001]["score"]


def test_harmless_words_are_looked_up_as_the_automaton_would():
    rng = random.Random(6)
    words, stems, harmless = ["abcde", "bacabaca"], ["ebcad"], ["abcdd", "acabaca", "ebcabxy"]
    tried = [*words, *harmless, "ebcadxx", *("".join(rng.choice("abcde") for _ in range(rng.randrange(3, 9))) for _ in range(3000))]
    column = pa.array([w.upper() for w in tried])
    whole = T.hits(column, A.build(words, stems, (), harmless))
    apart = T.hits(column, A.build(words, stems), frozenset(harmless))
    assert [x.tolist() for x in whole] == [x.tolist() for x in apart] and len(whole[2]) > 10


def test_scores_do_not_depend_on_the_layout(spark):
    df = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    found = [sorted(map(tuple, T.toxicity(df.repartition(n), labels).collect())) for n in (1, 4, 23)]
    assert found[0] == found[1] == found[2]


def test_quotation_is_told_from_abuse():
    a = A.build(["numpty"], [])
    m = T.Model(a, np.array([1e-6]), 1e-6, np.array([False]), np.zeros(T.FEATURES + 1), ["numpty"], [])
    x = T.features(pa.array(["you numpty", 'he said "numpty" once', "numpty numpty", None, "“numpty”"]), m, T.Toxicity())
    assert x[0, 1] > 0 and x[0, 7] == 0
    assert x[1, 1] == 0 and x[1, 7] > 0
    assert x[2, 8] > 0 and not x[3].any()


def test_apostrophes_and_other_kinds_of_marks_quote_nothing():
    m = T.Model(A.build(["numpty"], []), np.array([1e-6]), 1e-6, np.array([False]), np.zeros(T.FEATURES + 1), ["numpty"], [])
    abuse = ["You’re a numpty and that’s final", "the dogs’ numpty of the cats’ owner", "get ’em numpty, the boys’ own", "a 5\" numpty 6\" b",
             "“so” numpty “so”", "so” numpty’s “so x", "\"a\" numpty \"b\"", "x “ a numpty", "He’s “so so” a numpty, isn’t he", "‘a’ numpty ‘b’",
             "«a» numpty «b»", "„a“ numpty „b“", "»a« numpty »b«", "“" + "x" * 50 + " numpty”"]
    quoted = ["he said “you’re a numpty, aren’t you”", "‘Don’t be a numpty,’ he’d say", "„numpty“ x", "»numpty« x", "« numpty »", "‹numpty›",
              "”numpty” x", "said,\"numpty\"", "“‘numpty’”", "(\"numpty\")", "it’s \"a numpty\", isn’t it", "“numpty”", "\" numpty \""]
    x = T.features(pa.array(abuse + quoted), m, T.Toxicity())
    for i, t in enumerate(abuse):
        assert x[i, 1] > 0 and x[i, 7] == 0, t
    for i, t in enumerate(quoted, len(abuse)):
        assert x[i, 1] == 0 and x[i, 7] > 0, t
    # The neighbours of a text are no neighbours of its marks.
    x = T.features(pa.array(["“a", "numpty", "b”", "", None, "\""]), m, T.Toxicity())
    assert x[1, 1] > 0 and not x[:, 7].any()


def test_held_out_scores_on_the_given_labels(spark):
    got = {r["doc_id"]: r for r in QUERIES["op2_toxicity"](spark, SF).collect()}
    assert len(got) == spark.read.parquet(f"{SF}/documents.parquet").count()
    rows = spark.read.parquet(f"{SF}/labels.parquet").collect()
    held = [(got[r["doc_id"]]["score"], r["toxic"]) for r in rows if got[r["doc_id"]]["held_out"]]
    hits = [(a > b) + 0.5 * (a == b) for a, t in held for b, u in held if t > u]
    assert sum(hits) >= 0.8 * len(hits)


def test_without_labels_or_rows(spark, docs):
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    got = T.toxicity(docs([(1, "any text"), (2, None)]), none).collect()
    assert len({r["score"] for r in got}) == 1 and got[0]["score"] < 0.3
    assert T.toxicity(docs([]), none).collect() == []
