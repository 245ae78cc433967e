"""Scan of a library catalog in CSV."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

# The columns a catalog file must have, and their names here.
CATALOG_COLUMNS = {
    "Text#": "text_no", "Type": "type", "Title": "title", "Language": "language", "Authors": "authors",
    "Subjects": "subjects", "LoCC": "locc", "Bookshelves": "bookshelves",
}

_FORMAT = {"header": True, "quote": '"', "escape": '"', "ignoreLeadingWhiteSpace": False,
           "ignoreTrailingWhiteSpace": False}


def require_columns(df: DataFrame, wanted) -> DataFrame:
    """``df``, or an error that names the missing columns."""
    missing = [name for name in wanted if name not in df.columns]
    if missing:
        raise ValueError(f"missing columns: {', '.join(missing)}")
    return df


def read_catalog(spark: SparkSession, path: str) -> DataFrame:
    """All catalog columns as text, empty cells as empty strings.

    Cells may span lines and contain doubled quotes. Nothing is inferred, so
    the literal ``NA`` stays a text; columns are found by name.
    """
    raw = spark.read.options(**_FORMAT, inferSchema=False, multiLine=True).csv(path)
    require_columns(raw, CATALOG_COLUMNS)
    return raw.select(*[raw[f"`{name}`"].alias(alias) for name, alias in CATALOG_COLUMNS.items()]).na.fill("")


def write_catalog(df: DataFrame, path: str) -> None:
    """The reverse of ``read_catalog``."""
    named = df.select(*[df[alias].alias(name) for name, alias in CATALOG_COLUMNS.items()])
    named.write.options(**_FORMAT).csv(path)
