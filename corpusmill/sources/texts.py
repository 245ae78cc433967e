"""Scans of raw texts keyed by id."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

FILE_ID = r"([0-9]+)\.txt$"


def _unix_lines(raw: Column) -> Column:
    """Every kind of line end as one line feed."""
    return F.replace(F.replace(raw, F.lit("\r\n"), F.lit("\n")), F.lit("\r"), F.lit("\n"))


def read_text_files(spark: SparkSession, folder: str) -> DataFrame:
    """``(id, raw)`` from a folder of files ``<id>.txt``; others are left out."""
    files = spark.read.option("pathGlobFilter", "*.txt").text(folder, wholetext=True)
    named = files.select(F.regexp_extract(F.col("_metadata.file_name"), FILE_ID, 1).alias("name"), "value")
    return named.where(F.col("name") != "").select(
        F.col("name").cast("long").alias("id"), _unix_lines(F.col("value")).alias("raw"))


def read_text_table(spark: SparkSession, path: str, *, id_col: str = "id", text: str = "raw") -> DataFrame:
    """``(id, raw)`` from a table; the layout for very many texts, since a
    file per text costs a request each."""
    table = spark.read.parquet(path)
    return table.select(F.col(id_col).cast("long").alias("id"), _unix_lines(F.col(text)).alias("raw"))
