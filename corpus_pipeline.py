"""Raw documents to a mixed training corpus: five stages, each written before the next reads it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from corpusmill.llm.decontaminate import drop_contaminated
from corpusmill.llm.langid import keep_identified
from corpusmill.llm.mixing import mixed
from corpusmill.llm.neardup import drop_near_duplicates
from corpusmill.llm.secrets import redact
from corpusmill.runtime import materialise


#: The columns that the stages work on. All others go through them under names that no operator uses.
COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def _others_aside(docs: DataFrame, stage) -> DataFrame:
    """``stage(docs)`` with every column of ``docs`` under its own name, whatever names the operator uses inside.

    A column that the stage adds under a name ``docs`` already has gets ``mix_`` before it.
    """
    others = {c: f"other_{i}__" for i, c in enumerate(c for c in docs.columns if c not in COLUMNS)}
    out = stage(docs.toDF(*[others.get(c, c) for c in docs.columns]))
    back = {renamed: c for c, renamed in others.items()}
    taken, names = {c.lower() for c in docs.columns}, []
    for c in out.columns:
        name = back.get(c, c)
        while c not in back and c not in COLUMNS and name.lower() in taken:
            name = f"mix_{name}"
        names.append(name)
        taken.add(name.lower())
    return out.toDF(*names)


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is recognised; of equal scores the first language counts. Repeated rows stay."""
    return _others_aside(docs, keep_identified)


def drop_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates, the smallest doc_id. A row that repeats doc_id and text stays once."""
    return _others_aside(docs, drop_near_duplicates)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that do not hold too much of the benchmark. Repeated rows are judged alike; long texts count whole."""
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return _others_aside(docs, lambda d: drop_contaminated(d, benchmark))


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with secrets replaced by a mark."""
    return _others_aside(docs, redact)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the mix takes words from, and how many; rows that repeat doc_id and text are one row."""
    return _others_aside(docs, mixed)


STAGES = [
    ("language ID", identify_language),
    ("near-duplicates", drop_duplicates),
    ("decontamination", decontaminate),
    ("secrets", redact_secrets),
    ("mixing", mix_sources),
]

#: The stages learn a model and sketch texts, which SQL cannot express; the tests hold them against plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages one after the other over ``documents``, each result written as Parquet and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir), f"pipeline-{name.replace(' ', '-')}")
    return STAGES[-1][1](spark, docs, sf_dir)
