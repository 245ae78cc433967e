import pytest
from pyspark.sql import functions as F

from corpusmill.functions import catalog as C
from corpusmill.operators import catalog as cat
from corpusmill.params import Epochs, Selection, epoch_table, keyword_table, order_table
from corpusmill.sources.catalog import read_catalog, require_columns, write_catalog

EPOCHS = Epochs()
SELECTION = Selection(language="de", keywords=("drama", "gedicht", "briefe"), seed=1)
COLUMNS = "text_no string, type string, language string, title string, authors string, subjects string, " \
          "bookshelves string, locc string"


def book(no, title, authors, language="de", locc="PT"):
    return (str(no), "Text", language, title, authors, "", "", locc)


# Made-up people. Ids 14 and 19 hold one work twice, 23 is of the wrong class, 27 has no usable year.
BOOKS = [
    book(11, "Nebel am Wehr", "Aldorf, Mina, 1801-1859"), book(12, "Das Wehr. Ein Drama", "Aldorf, Mina, 1801-1859"),
    book(14, "Die Fähre!", "Brandis, Otto, 1840-1909; Zweiter, Karl, 1700-1750"), book(17, "Fog", "Cole, Ann, 1830-1899", "en"),
    book(19, "Die  Fähre", "Brandis, Otto, 1840-1909"), book(20, "Alte Briefe", "Brandis, Otto, 1840-1909"),
    book(23, "Kohle", "Dorn, Ida, 1880-1930", "de", "QE"), book(25, "Licht", "Dorn, Ida, 1880-1930", "de", "QE; PT"),
    book(27, "Ohne Jahr", "Ebner, Jo, 1850-"), book(28, "Später", "Falk, Ute, 1900-1999"),
]


@pytest.mark.parametrize("entry, name, role, birth, death", [
    ("Goethe, Johann Wolfgang von, 1749-1832", "Goethe, Johann Wolfgang von", None, 1749, 1832),
    ("Heine, Heinrich, 1797?-1856", "Heine, Heinrich", None, 1797, 1856),
    ("Wolff, Julius, 1834-", "Wolff, Julius", None, 1834, None),
    ("Anonymous", "Anonymous", None, None, None),
    ("Doré, Gustave, 1832-1883 [Illustrator]", "Doré, Gustave", "Illustrator", 1832, 1883),
    ("Homer, -700?", "Homer", None, None, 700),
])
def test_parse_author(one, entry, name, role, birth, death):
    for fn in (C.parse_author, C.first_author):
        assert tuple(one(fn, entry)) == (name, role, birth, death)


def test_split_authors(one):
    people = one(C.split_authors, " ; Storm, Theodor, 1817-1888; ;Meyer, Hans, 1850-1920 [Editor];")
    assert [(p["name"], p["role"]) for p in people] == [("Storm, Theodor", None), ("Meyer, Hans", "Editor")]
    assert one(C.first_author, " ; Storm, Theodor, 1817-1888; x")["name"] == "Storm, Theodor"


@pytest.mark.parametrize("text, keywords, hit", [
    ("Ausgewählte Gedichte", ["gedicht"], True), ("Die Preise", ["reise"], False), ("äreise", ["reise"], False),
    ("Zur Reise", ["reise"], True), ("x", [], False), ("a.b", [".b"], True), ("a .b", [".b"], False),
    ("History and Criticism", ["history and criticism"], True),
])
def test_contains_keyword(one, text, keywords, hit):
    assert one(lambda t: C.contains_keyword(t, keywords), text) is hit


def test_titles(one):
    assert one(C.title_key, "Die  Fähre: 2. Band") == "die fähre 2 band"
    assert one(C.title_text, " Am \n \u00a0Wehr ") == "Am Wehr"


@pytest.mark.parametrize("year, name", [(1832, "Goethezeit"), (1898, "Realismus"), (1924, "Moderne"),
                                        (1860, "Goethezeit"), (1861, "Realismus"), (1720, "Goethezeit"),
                                        (1719, None), (1600, None), (1960, "Moderne"), (1961, None), (None, None)])
def test_epoch(spark, one, year, name):
    assert one(lambda y: C.epoch_label(y, EPOCHS), year, schema="int") == name
    rows = spark.createDataFrame([(year,)], "y int")
    assert cat.label_by_range(rows, epoch_table(spark, EPOCHS), year="y").first()["epoch"] == name


def test_shadowed_bin_stays_empty(one):
    epochs = Epochs(floor=1700, bins=(("a", 1800), ("b", 1750), ("c", 1900)))
    assert one(lambda y: C.epoch_label(y, epochs), 1740, schema="int") == "a"
    assert one(lambda y: C.epoch_label(y, epochs), 1850, schema="int") == "c"


def test_candidates(spark):
    rows = cat.candidates(spark.createDataFrame(BOOKS, COLUMNS), SELECTION, EPOCHS).collect()
    assert {r["id"]: r["epoch"] for r in rows} == {11: "Goethezeit", 14: "Realismus", 25: "Moderne"}
    steps = [(r["step"], r["rows"]) for r in cat.filter_funnel(
        spark.createDataFrame(BOOKS, COLUMNS), SELECTION, EPOCHS).orderBy("ord").collect()]
    assert [n for _, n in steps] == [10, 9, 8, 8, 6, 4, 3]


def test_translations_are_dropped(spark):
    rows = [book(1, "Oliver Twist", "Dickens, Charles, 1812-1870; Scheibe, Anon, 1800-1870 [Translator]")]
    assert cat.candidates(spark.createDataFrame(rows, COLUMNS), SELECTION, EPOCHS).count() == 0


def test_first_edition_by_given_order(spark):
    rows = spark.createDataFrame([(*b, 10 - i) for i, b in enumerate(BOOKS)], COLUMNS + ", pos int")
    kept = {r["id"] for r in cat.candidates(rows, SELECTION, EPOCHS, pos="pos").collect()}
    assert kept == {11, 19, 25}


def test_keyword_table_agrees_with_pattern(spark):
    words = ["drama", "reise", "history and the whole of it", "-drama", "reisende", ". end"]
    texts = ["Drama", "Die Preise, Reise", "Preise", "a history and the whole of it", "history and the whole", "dram", "",
             "x-drama-y", "der Reisende", "stop. End", " -dram", "- drama", "\n-drama"]
    rows = spark.createDataFrame(list(enumerate(texts)), "id int, t string")
    hits = cat.keyword_hits(rows, keyword_table(spark, words), id_col="id", text=F.col("t"))
    plain = rows.where(C.contains_keyword(F.col("t"), words))
    assert {r["id"] for r in hits.collect()} == {r["id"] for r in plain.collect()} == {0, 1, 3, 7, 8, 9, 11, 12}
    few = cat.keyword_hits(rows, keyword_table(spark, ["-drama"]), id_col="id", text=F.col("t"))
    assert {r["id"] for r in few.collect()} == {7}


def test_csv_round_trip(spark, tmp_path):
    rows = [("1", "Text", "Ein \"Titel\"\nzweite Zeile, mit Komma", "de", "NA", "", "PT", " x ")]
    names = "text_no type title language authors subjects locc bookshelves".split()
    df = spark.createDataFrame(rows, names)
    write_catalog(df, str(tmp_path / "c"))
    assert [tuple(r) for r in read_catalog(spark, str(tmp_path / "c")).collect()] == rows


def test_missing_columns_are_named(spark, tmp_path):
    (tmp_path / "c.csv").write_text("Text#,Type\n1,Text\n", encoding="utf-8")
    with pytest.raises(ValueError, match="LoCC"):
        read_catalog(spark, str(tmp_path / "c.csv"))
    with pytest.raises(ValueError, match="b"):
        require_columns(spark.range(1), ["id", "b"])


def test_order_is_chronological(spark):
    assert [r["name"] for r in order_table(spark, EPOCHS.order).orderBy("ord").collect()] == \
        ["Goethezeit", "Realismus", "Moderne"]
