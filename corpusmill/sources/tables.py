"""Tables between the steps, and the sinks for results."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

CANDIDATE_SCHEMA = T.StructType([
    T.StructField("id", T.LongType()), T.StructField("title", T.StringType()),
    T.StructField("author", T.StringType()), T.StructField("birth_year", T.IntegerType()),
    T.StructField("death_year", T.IntegerType()), T.StructField("epoch", T.StringType()),
    T.StructField("shuffle_key", T.StringType()),
])
CORPUS_SCHEMA = T.StructType([*CANDIDATE_SCHEMA.fields, T.StructField("n_words", T.LongType())])
FEATURE_COLUMNS = ["median_sentence_length", "sttr", "function_word_ratio", "character_density"]
METADATA_COLUMNS = ["id", "author", "title", "birth_year", "death_year", "epoch"]
FEATURE_SCHEMA = T.StructType(
    [next(f for f in CANDIDATE_SCHEMA.fields if f.name == c) for c in METADATA_COLUMNS]
    + [T.StructField(c, T.DoubleType()) for c in FEATURE_COLUMNS])


def read_table(spark: SparkSession, path: str, schema: T.StructType, fmt: str = "parquet") -> DataFrame:
    """A table with a stated schema: nothing is inferred again on the way."""
    reader = spark.read.schema(schema)
    return reader.option("header", True).csv(path) if fmt == "csv" else reader.format(fmt).load(path)


def table_exists(spark: SparkSession, path: str) -> bool:
    """Whether a table was written at ``path``, on any file system Spark knows."""
    jvm_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return jvm_path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(jvm_path)


def rounded(df: DataFrame, digits: int) -> DataFrame:
    """Every double column rounded half to even."""
    doubles = {f.name for f in df.schema.fields if isinstance(f.dataType, T.DoubleType)}
    return df.select(*[F.bround(c, digits).alias(c) if c in doubles else F.col(c) for c in df.columns])


def write_table(df: DataFrame, path: str, *, fmt: str = "parquet", digits: int | None = None,
                mode: str = "overwrite") -> None:
    out = df if digits is None else rounded(df, digits)
    writer = out.write.mode(mode)
    writer.option("header", True).csv(path) if fmt == "csv" else writer.format(fmt).save(path)


def write_record(df: DataFrame, path: str, digits: int = 4) -> None:
    """One row of headline numbers as a JSON line."""
    rounded(df, digits).coalesce(1).write.mode("overwrite").json(path)
