import random
from collections import Counter

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from corpusmill.functions import names as P
from corpusmill.functions import tokens as K
from corpusmill.operators import characters as H
from corpusmill.operators import tokens as W
from corpusmill.params import PERSON_TITLES, Style, lexicon

TITLES = ("herr", "frau", "von")
# Words per sentence, punctuation apart: 3, 6, 1, 1, 4. A person is named four times, two of them as Ole.
SENTENCES = [[("Morgens", "ADV", None), ("rief", "VERB", None), ("Ole", "PROPN", 7), ("!", "PUNCT", None)],
             [("Mit", "ADP", None), ("dem", "DET", None), ("Boot", "NOUN", None), ("fuhr", "VERB", None),
              ("Frau", "NOUN", 8), ("Krogh", "PROPN", 8), (",", "PUNCT", None)],
             [("Still", "ADV", None)],
             [("Regen", "NOUN", None), (".", "PUNCT", None)],
             [("Ole", "PROPN", 9), ("und", "CCONJ", None), ("Krogh", "PROPN", 10), ("schwiegen", "VERB", None)]]
SCHEMA = "doc_id bigint, pos bigint, sent_id int, token string, is_word boolean, upos string, ent_id int, ent_label string"


@pytest.fixture
def annotated(spark):
    rows, pos = [], 0
    for s, sentence in enumerate(SENTENCES):
        for token, tag, ent in sentence:
            rows.append((1, pos, s, token, tag != "PUNCT", tag, ent, "PER" if ent else None))
            pos += 1
    return spark.createDataFrame(rows, SCHEMA)


def words_table(spark, words):
    return spark.createDataFrame([(1, i, 0, w, True, None, None, None) for i, w in enumerate(words)], SCHEMA)


def test_token_measures(annotated):
    assert W.median_sentence_length(annotated).first()["median_sentence_length"] == 3.0
    assert W.function_word_ratio(annotated, ["DET", "ADP"]).first()["function_word_ratio"] == pytest.approx(2 / 15)
    for least, people in ((1, 2), (2, 2), (3, 0)):
        style = Style(window=5, pos=("DET", "ADP", "CCONJ"), titles=TITLES, min_mentions=least)
        density = people / 15 * 1000
        assert W.character_density(annotated, style).first()["character_density"] == pytest.approx(density)
        row = W.token_features(annotated, style).first()
        assert row.asDict() == pytest.approx({"doc_id": 1, "median_sentence_length": 3.0, "sttr": 1.0,
                                              "function_word_ratio": 0.2, "character_density": density})


@pytest.mark.parametrize("words, window, value", [
    ("u v u w w w u v x".split(), 3, 2 / 3), ("Ein EIN Boot boot".split(), 2, 0.5), (["eins", "zwei"], 3, None)])
def test_sttr(spark, one, words, window, value):
    assert W.standardised_ttr(words_table(spark, words), window).first()["sttr"] == pytest.approx(value)
    assert one(lambda t: K.standardised_ttr(K.words(F.lower(t)), window), " ".join(words)) == pytest.approx(value)


def test_strict_sttr_raises(spark):
    rows = spark.createDataFrame([("kurz", "de")], "t string, lang string")
    with pytest.raises(PySparkException, match="shorter than one window"):
        K.with_style(rows, "t", window=10, lexicon=lexicon(), strict=True).collect()


def test_windows_cross_blocks(spark):
    from corpusmill.operators.ordering import block_rank, block_sum
    rng = random.Random(1)
    places = sorted(rng.sample(range(500), 200))
    rows = spark.createDataFrame([(1, p, rng.randint(0, 5)) for p in places], "d int, p int, n int")
    ranks = {r["p"]: r["r"] for r in block_rank(rows, by="d", pos="p", out="r", block=16).collect()}
    assert ranks == {p: i + 1 for i, p in enumerate(places)}
    data, total = sorted((r["p"], r["n"]) for r in rows.collect()), 0
    sums = {r["p"]: r["s"] for r in block_sum(rows, by="d", pos="p", amount="n", out="s", block=16).collect()}
    for p, n in data:
        assert sums[p] == total
        total += n


def test_text_measures(spark):
    rows = spark.createDataFrame([("Der Mann kam. Er ging in das Haus! Ende", "de"), ("", "de")], "t string, lang string")
    first, empty = K.with_style(rows, "t", window=4, lexicon=lexicon()).collect()
    assert (first["n_words"], first["median_sentence_length"]) == (9, 3.0)
    assert first["function_word_ratio"] == pytest.approx(3 / 9)
    assert empty["n_words"] == 0 and empty["median_sentence_length"] is None and empty["function_word_ratio"] is None


def test_words_and_sentences(one):
    assert one(K.words, "Geht's, »Nord-Süd« 3.5 – ja…") == ["Geht's", "Nord-Süd", "3", "5", "ja"]
    assert one(K.sentences, "A b. »C!« d?! ... e 3.5 f") == ["A b", "»C", "d", "e 3.5 f"]
    assert one(K.sentence_lengths, "A b. C! ... d e f") == [2, 1, 3]


def test_cue_mentions(one):
    text = "Im Boot saßen Herr von Holm, Frau Krogh und Dr. Nils Ahrens."
    assert one(lambda t: K.cue_mentions(t, PERSON_TITLES), text) == ["Herr von Holm", "Frau Krogh", "Dr. Nils Ahrens"]


def test_person_name(one):
    assert one(lambda n: P.person_name(n, TITLES), "Frau von Holm;") == "holm"
    assert one(lambda n: P.person_name(n, TITLES), "Von Frau") == ""
    assert one(lambda n: P.person_name(n, ()), " »Lene«  Krogh ") == "lene krogh"


# The last words krogh and holm make two groups, ole joins holm by the name that contains it, nils stands alone.
NAMES = {"lene krogh": 2, "kroghs": 1, "krogh": 1, "ole holm": 1, "ole": 6, "oles": 2, "nils": 1}


def table(spark, docs):
    return spark.createDataFrame([(d, n, c) for d, names in docs.items() for n, c in names.items()],
                                 "doc_id int, name string, mentions bigint")


def test_characters_golden(spark):
    rows = table(spark, {1: NAMES})
    groups = {r["character"]: r["mentions"] for r in H.character_groups(rows).collect()}
    assert groups == {"krogh": 4, "holm": 9, "nils": 1}
    assert H.character_counts(rows, 2).first()["characters"] == 2
    assert H.character_counts(rows, 9).first()["characters"] == 1


def cast_model(names, least):
    """Each mention finds its group on its own."""
    def base(n):
        return n[:-1] if n[-1:] == "s" and n[:-1] in names else n
    known = {base(n) for n in names if base(n) or n == "s"}
    tally = Counter()
    for n, c in names.items():
        if n == "":
            continue
        b = base(n)
        if " " not in b:
            owner = min((k for k in known if " " in k and b in k.split(" ")), default=None)
            b = owner or b
        tally[b.split(" ")[-1]] += c
    return sum(c >= least for c in tally.values())


def test_characters_agree_with_single_lookups(spark):
    rng = random.Random(9)
    parts = ["ole", "oles", "holm", "holms", "s", "ss", "lene", "as", "a"]
    docs = {}
    for d in range(120):
        names = {" ".join(rng.choice(parts) for _ in range(rng.randint(1, 3))) for _ in range(rng.randint(1, 9))}
        docs[d] = {n: rng.randint(1, 4) for n in names | ({""} if rng.random() < 0.3 else set())}
    for least in (1, 2, 3):
        got = {r["doc_id"]: r["characters"] for r in H.character_counts(table(spark, docs), least).collect()}
        assert {d: got.get(d, 0) for d in docs} == {d: cast_model(n, least) for d, n in docs.items()}


def test_gazetteer_takes_the_longest(spark):
    texts = spark.createDataFrame([(1, "Lene Krogh sah Anna Maria\nKrogh, dann Lene."),
                                   (2, "Es kam Baron Ole Erik von und zu Holm mit Erik."), (3, None), (4, "")], "id int, t string")
    names = spark.createDataFrame([("lene",), ("Lene Krogh",), ("krogh",), ("anna maria krogh",), ("Ole Erik von und zu Holm",),
                                   ("erik",), ("Ole Erik von Holm",), (None,), ("...",)], "name string")
    got = sorted((r["doc_id"], r["pos"], r["name"]) for r in W.gazetteer_mentions(texts, names, doc_id="id", text="t").collect())
    assert got == [(1, 0, "Lene Krogh"), (1, 3, "Anna Maria Krogh"), (1, 7, "Lene"), (2, 3, "Ole Erik von und zu Holm"),
                   (2, 10, "Erik")]


@pytest.mark.parametrize("filtered", [True, False])
def test_gazetteer_of_very_long_names(spark, monkeypatch, filtered):
    if not filtered:
        monkeypatch.setattr(W, "BEGINNINGS", 0)
    rng = random.Random(8)
    words = ["a", "b", "l'eau", "d’or", "x"]
    names = {" ".join(rng.choice(words) for _ in range(rng.choice([1, 2, 3, 8, 9, 12, 20]))) for _ in range(60)}
    names |= {" ".join(["a", "b"] * 200), " ".join(["x"] * 9), " ".join(["x"] * 30)}
    texts = []
    for d in range(30):
        parts = [rng.choice([*names, *words]) for _ in range(12)]
        texts.append((d, " ".join(parts).upper() if d % 3 == 0 else ", ".join(parts)))
    want = []
    keys = {n.lower() for n in names}
    for d, t in texts:
        w = [x for x in t.replace(",", " ").split()]
        i = 0
        found = {}
        for i in range(len(w)):
            fits = [n for n in range(1, len(w) - i + 1) if " ".join(w[i:i + n]).lower() in keys]
            if fits:
                found[i] = max(fits)
        reach = -1
        for i, n in sorted(found.items()):
            if i > reach:
                want.append((d, i, " ".join(w[i:i + n])))
            reach = max(reach, i + n - 1)
    df = spark.createDataFrame(texts, "id int, t string")
    listed = spark.createDataFrame([(n,) for n in names], "name string")
    got = sorted((r["doc_id"], r["pos"], r["name"]) for r in W.gazetteer_mentions(df, listed, doc_id="id", text="t").collect())
    assert got == sorted(want)


def test_gazetteer_reads_texts_once(spark):
    texts = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    names = spark.createDataFrame([("Anna Maria",), ("the",)], "name string")
    plan = W.gazetteer_mentions(texts, names, doc_id="doc_id", text="text")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan parquet") == 1


def test_only_marks_and_blank_lines_end_a_sentence(one):
    text = "Am 3. Mai kam\nHr. Dr. Holm\nmit J. R. Krogh. Es war 1832. Dann\n\nRuhe"
    assert one(K.sentences, text) == ["Am 3. Mai kam\nHr. Dr. Holm\nmit J. R. Krogh", "Es war 1832", "Dann", "Ruhe"]
    assert one(K.sentence_lengths, text) == [11, 3, 1, 1]


def test_token_table(spark):
    rows = spark.createDataFrame([(1, "Der Mann. Er und ich!", "de")], "id int, t string, lang string")
    got = [(r["pos"], r["sent_id"], r["token"], r["upos"]) for r in
           W.token_table(rows, doc_id="id", text="t", lang="lang").orderBy("pos").collect()]
    assert got == [(0, 0, "Der", "DET"), (1, 0, "Mann", None), (2, 1, "Er", None), (3, 1, "und", "CCONJ"), (4, 1, "ich", None)]


def test_windows_without_a_shuffle_of_words(spark):
    """Where the text says when a word was last met, windows are the same and no word leaves its task."""
    rng = random.Random(4)
    texts = [(i, " ".join(rng.choice(["Haus", "haus", "See", "am", "Ort", "x", "y."]) for _ in range(rng.randrange(0, 60))), "de")
             for i in range(30)] + [(None, "Haus am See. am", "de")]
    found = {}
    for twice in (False, True):
        df = spark.createDataFrame(texts * (1 + twice), "doc_id long, text string, lang string")
        plain, marked = (W.token_table(df, doc_id="doc_id", text="text", lang="lang", repeats=r) for r in (False, True))
        assert ("last_pos" in marked.columns) != twice
        assert sorted(map(str, plain.collect())) == sorted(map(str, marked.select(*plain.columns).collect()))
        found[twice] = [sorted(map(str, W.windows(t, 7).collect())) for t in (plain, marked)]
        assert found[twice][0] == found[twice][1] and len(found[twice][0]) > 50
        if not twice:
            exchanged = [line for line in W.windows(marked, 7)._jdf.queryExecution().toString().split("Physical Plan")[1].split("\n")
                         if "Exchange hashpartitioning" in line]
            assert len(exchanged) == 1 and "lower" not in exchanged[0]


def test_inner_dots_are_those_of_two_rounds(spark):
    """Dots found by themselves are those that the pattern finds in two rounds."""
    rng = random.Random(5)
    parts = ["J", "S", ".", ".", "Hr", "dr", " ", "12", "3", "x", "É", "-", "\n", "😀"]
    texts = [("".join(rng.choice(parts) for _ in range(rng.randrange(1, 14))),) for _ in range(3000)]
    two = F.col("t")
    for _ in range(2):
        two = F.regexp_replace(two, K.INNER_DOT, f"$1$2{K.NO_END}")
    df = spark.createDataFrame(texts, "t string").withColumns({"a": two, "b": F.regexp_replace("t", K._DOT_INSIDE, K.NO_END)})
    assert df.where("a <> b").collect() == [] and df.where(F.col("a") != F.col("t")).count() > 500


def _written_words(spark, folder, texts, monkeypatch):
    """What ``token_features`` returns over these texts, and how many rows it wrote of texts or their words."""
    from corpusmill.plans import registry as R
    spark.createDataFrame(texts, "doc_id long, text string, lang string").write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame([("Anna Maria Krogh sah den Ort",), ("Ole",)], "text string").write.parquet(f"{folder}/benchmark.parquet")
    written = []

    def kept(df, name="stage", options=None, write=R.materialise):
        out = write(df, name, options)
        written.extend([out.count()] * (name == "tokens"))
        return out

    for module in (R, W):
        monkeypatch.setattr(module, "materialise", kept)
    return sorted(map(str, R.token_features(spark, str(folder)).collect())), written


def test_token_features_write_no_row_per_word(spark, tmp_path, monkeypatch):
    """Texts leave their task as one row each; only those that share an id have a row per word, with the same results."""
    rng = random.Random(6)
    words = ["Anna Maria", "Anna", "maria", "Krogh", "Kroghs", "Ole", "See.", "am", "der", "und", "!?", "Hr.", "\n\n", "the"]
    texts = [(i, " ".join(rng.choice(words) for _ in range(rng.randrange(0, 90))), rng.choice(["de", "en", "xx", None]))
             for i in range(40)] + [(50, None, "de"), (51, "... !", "de"), (None, "Ole am See. Anna", "de"), (None, "Ole", "de")]
    once, written = _written_words(spark, tmp_path / "once", texts, monkeypatch)
    assert written == [42] and 30 < len(once) < 42
    # The words of these two share an id, so the other texts must come out as before.
    twice, written = _written_words(spark, tmp_path / "twice", [*texts, (60, "Ole am See. Ole", "de"), (60, "Anna Maria am See", "de")], monkeypatch)
    assert written[0] == 42 and written[1] == 8
    assert [r for r in twice if "doc_id=60," not in r] == once and len(twice) == len(once) + 1


@pytest.mark.parametrize("window", [1, 7, 20])
def test_whole_texts_measure_as_token_tables_do(spark, window):
    rng = random.Random(7)
    words = ["Haus", "haus", "See.", "am", "Ort", "und", "J.", "3.", "d'Or", "l’eau!", "\n\n", "\ue000", "É"]
    texts = spark.createDataFrame([(i, " ".join(rng.choice(words) for _ in range(rng.randrange(0, 80))), rng.choice(["de", "en", None]))
                                   for i in range(60)], "id long, t string, lang string")
    spans = spark.createDataFrame([(i, p, n) for i in range(0, 60, 2) for p, n in ((0, 1), (3, 2), (5, 1), (7, 3))],
                                  "doc_id long, pos long, size int")
    style = Style(window=window, titles=TITLES, min_mentions=2)
    columns = dict(doc_id="id", text="t", lang="lang")
    marks = spans.select("doc_id", F.col("pos").alias("ent_id"), F.explode(F.expr("sequence(pos, pos + size - 1)")).alias("pos"),
                         F.lit("PER").alias("ent_label"))
    rows = W.token_features(W.token_table(texts, **columns).join(marks, ["doc_id", "pos"], "left"), style)
    whole = W.token_features(W.token_table(W.with_spans(texts, spans, doc_id="id"), **columns, whole=True), style)
    want, got = ({r["doc_id"]: r.asDict() for r in t.collect()} for t in (rows, whole))
    assert want.keys() == got.keys() and any(r["character_density"] for r in want.values())
    for d in want:
        assert got[d] == pytest.approx(want[d])


def test_gazetteer_looks_at_first_words_first(spark):
    """Only places of a word that begins a name are looked at closer, with and without the list."""
    texts = spark.createDataFrame([(1, "Anna maria Krogh sah d'Or. Krogh"), (2, ""), (3, None), (4, "Anna")], "id int, t string")
    split = texts.select("id", K.words(F.col("t")).alias("__words"))
    begins = ["anna maria", "krogh", "l'eau", "d'or"]
    near, every = (split.withColumn("__places", W._places(b)).select("id", "__places", F.transform(
        W._starts(b), lambda s: F.struct("__places", s["pos"], s["begin"])).alias("s")) for b in (begins, None))
    assert [r["__places"] for r in near.orderBy("id").collect()] == [[0, 2, 4, 5], [], None, [0]]
    assert [[s["begin"] for s in r["s"] or ()] for r in near.orderBy("id").collect()] == [["krogh", "d'or", "krogh", "anna maria"], [], [], []]
    assert [len(r["s"] or ()) for r in every.orderBy("id").collect()] == [6 + 5, 0, 0, 1]
