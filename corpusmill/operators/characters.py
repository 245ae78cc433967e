"""Distinct characters of a text from the mentions of person names."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusmill.functions.names import last_word, person_name


def mention_counts(mentions: DataFrame, titles, *, name: str = "name") -> DataFrame:
    """``(doc_id, name, mentions)`` by normalised name, the empty one included."""
    return (mentions.select("doc_id", person_name(F.col(name), titles).alias("name"))
            .groupBy("doc_id", "name").agg(F.count("*").alias("mentions")))


def merge_genitives(counts: DataFrame) -> DataFrame:
    """A name with a final s joins the name without it, if that occurs too.

    The lookup is among the names as counted, so it goes one step only; the
    empty name serves as a base but is dropped itself.
    """
    base = counts.select("doc_id", F.col("name").alias("base"), F.lit(True).alias("known"))
    stem = F.when(F.endswith(F.col("name"), F.lit("s")), F.substr("name", F.lit(1), F.length("name") - 1))
    merged = counts.withColumn("base", stem).join(base, ["doc_id", "base"], "left")
    target = F.when(F.col("known"), F.col("base")).when(F.col("name") != "", F.col("name"))
    return (merged.select("doc_id", target.alias("name"), "mentions").where(F.col("name").isNotNull())
            .groupBy("doc_id", "name").agg(F.sum("mentions").alias("mentions")))


def character_groups(counts: DataFrame) -> DataFrame:
    """``(doc_id, character, mentions)`` after merging name variants.

    Names of several words go by the last word. A single word goes with the
    first name, in text order, that contains it: the containing names are
    exploded into words, which turns the search into an equality join.
    """
    names = merge_genitives(counts)
    several = F.col("name").contains(" ")
    owners = (names.where(several)
              .select("doc_id", "name", F.explode(F.array_distinct(F.split("name", " "))).alias("word"))
              .groupBy("doc_id", "word").agg(F.min("name").alias("owner"))
              .withColumnRenamed("word", "name"))
    own = F.when(several, last_word(F.col("name"))).otherwise(F.coalesce(last_word(F.col("owner")), F.col("name")))
    return (names.join(owners, ["doc_id", "name"], "left")
            .groupBy("doc_id", own.alias("character")).agg(F.sum("mentions").alias("mentions")))


def character_counts(counts: DataFrame, min_mentions: int) -> DataFrame:
    """``(doc_id, characters)``: groups with at least ``min_mentions``."""
    return (character_groups(counts).where(F.col("mentions") >= min_mentions)
            .groupBy("doc_id").agg(F.count("*").alias("characters")))
