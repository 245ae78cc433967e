"""From a library catalog to candidate texts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpusmill.functions import catalog as C
from corpusmill.operators.ordering import seeded_order

CANDIDATE_COLUMNS = ["id", "title", "author", "birth_year", "death_year", "epoch"]


def null_to_empty(catalog: DataFrame) -> DataFrame:
    """Every missing text cell becomes the empty string."""
    return catalog.na.fill("")


def is_prose_type(selection) -> Column:
    """The entry is a text in exactly the wanted language."""
    return (F.col("type") == "Text") & (F.col("language") == selection.language)


def in_class(selection) -> Column:
    """The class field contains the class mark, case-sensitive, anywhere."""
    return F.col("locc").contains(selection.locc)


def not_translated() -> Column:
    return ~F.col("authors").contains("Translator")


def searchable() -> Column:
    return F.concat_ws(" ", "title", "subjects", "bookshelves")


def without_keywords(selection) -> Column:
    return ~C.contains_keyword(searchable(), list(selection.keywords))


def keyword_hits(df: DataFrame, keywords: DataFrame, *, id_col: str, text: Column) -> DataFrame:
    """Ids of rows where a word starts with a keyword of a large table.

    Each word start contributes its prefixes, one for every keyword length,
    and the prefixes meet the keywords in an equality join; the plan picks the
    join by size. A keyword that begins with another kind of character has to
    follow a word, as in ``functions.catalog``. Lengths come from the table.
    """
    longest = keywords.agg(F.coalesce(F.max(F.length("keyword")), F.lit(1))).first()[0]
    rest = rf"[\s\S]{{0,{max(1, longest) - 1}}}"
    starts = [rf"(?<!{C.IN_WORD})(?=({C.IN_WORD}{rest}))", rf"(?<={C.IN_WORD})(?=({C.NOT_WORD}{rest}))"]
    lengths = keywords.select(F.length("keyword").alias("size")).distinct().agg(
        F.collect_set("size").alias("sizes"))
    tails = df.select(id_col, F.explode(F.array_distinct(F.concat(*[F.regexp_extract_all(
        F.lower(text), F.lit(s), F.lit(1)) for s in starts]))).alias("tail"))
    # As many different sizes as the longest keyword has letters, at most.
    prefixes = (tails.crossJoin(F.broadcast(lengths)).select(id_col, "tail", F.explode("sizes").alias("size"))
                .where(F.length("tail") >= F.col("size"))
                .select(id_col, F.substr("tail", F.lit(1), F.col("size")).alias("keyword")))
    return prefixes.join(keywords.select("keyword").distinct(), "keyword", "left_semi").select(id_col).distinct()


def label_first_author(books: DataFrame, epochs) -> DataFrame:
    """Rows whose first listed person died inside an epoch, with its label."""
    parsed = books.withColumn("__a", C.first_author(F.col("authors")))
    labelled = parsed.withColumn("epoch", C.epoch_label(F.col("__a.death_year"), epochs))
    return (labelled.where(F.col("epoch").isNotNull())
            .withColumns({"author": F.col("__a.name"), "birth_year": F.col("__a.birth_year"),
                          "death_year": F.col("__a.death_year")}).drop("__a"))


def label_by_range(df: DataFrame, bins: DataFrame, *, year: str) -> DataFrame:
    """The same label from a bin table: a range join against a few rows."""
    hit = (F.col(year) >= F.col("lo")) & (F.col(year) <= F.col("hi"))
    return df.join(F.broadcast(bins), hit, "left").drop("ord", "lo", "hi").withColumnRenamed("name", "epoch")


def keep_first(df: DataFrame, *, keys: list[str], order: list[str]) -> DataFrame:
    """The first row of every key in the given order.

    The row limit of the window is applied before the shuffle, so a key with
    very many rows sends one row per input partition.
    """
    first = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("__rn", F.row_number().over(first)).where(F.col("__rn") == 1).drop("__rn")


def candidate_rows(catalog: DataFrame, selection, epochs, pos: str | None = None) -> DataFrame:
    """Filtered and labelled books, before duplicates are removed."""
    books = (null_to_empty(catalog)
             .where(is_prose_type(selection)).where(in_class(selection))
             .where(not_translated()).where(without_keywords(selection)))
    labelled = label_first_author(books, epochs)
    return labelled.select(
        F.col("text_no").cast("long").alias("id"), C.title_text(F.col("title")).alias("title"),
        "author", "birth_year", "death_year", "epoch", *([pos] if pos else []))


def candidates(catalog: DataFrame, selection, epochs, pos: str | None = None) -> DataFrame:
    """Candidate texts with the key of their random order.

    Of several editions with one author and title key the first is kept: by
    ``pos`` where the catalog has an ordinal, else the one with the lowest id.
    """
    rows = candidate_rows(catalog, selection, epochs, pos).withColumn("title_key", C.title_key(F.col("title")))
    kept = keep_first(rows, keys=["author", "title_key"], order=[pos, "id"] if pos else ["id"])
    return seeded_order(kept.select(*CANDIDATE_COLUMNS), "id", selection.seed)


def filter_funnel(catalog: DataFrame, selection, epochs) -> DataFrame:
    """``(ord, step, rows)``: rows that survive each step, from one pass."""
    # A row that a step drops is not looked at by the later, dearer ones.
    rows = null_to_empty(catalog).withColumn("c1", is_prose_type(selection))
    steps_ = [in_class(selection), not_translated(), without_keywords(selection)]
    for i, condition in enumerate(steps_, 2):
        rows = rows.withColumn(f"c{i}", F.when(F.col(f"c{i - 1}"), condition).otherwise(False))
    rows = rows.withColumn("person", F.when(F.col("c4"), C.first_author(F.col("authors"))))
    rows = rows.withColumn("c5", C.epoch_label(F.col("person.death_year"), epochs).isNotNull())
    rows = rows.select("c1", "c2", "c3", "c4", "c5", F.col("person.name").alias("author"),
                       F.when(F.col("c5"), C.title_key(C.title_text(F.col("title")))).alias("title_key"))
    conditions = [F.lit(True), *[F.col(f"c{i}") for i in range(1, 6)]]
    last = conditions[-1]
    counted = rows.agg(
        *[F.count_if(c).alias(f"n{i}") for i, c in enumerate(conditions)],
        F.count_distinct(F.when(last, F.struct("author", "title_key"))).alias("n6"))
    steps = ["all", "type and language", "class", "not translated", "no keyword", "labelled", "first edition"]
    return counted.select(F.explode(F.array(*[
        F.struct(F.lit(i).alias("ord"), F.lit(s).alias("step"), F.col(f"n{i}").alias("rows"))
        for i, s in enumerate(steps)])).alias("r")).select("r.*")
