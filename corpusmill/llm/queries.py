"""The registered queries of this subpackage: thin forms of its operators with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusmill.llm import decontaminate, hmmlm, licenses, merkle, secrets, tokencounts
from corpusmill.llm.fingerprint import fingerprints
from corpusmill.llm.langid import identify
from corpusmill.llm.linededup import dedup_lines
from corpusmill.llm.mixing import mix
from corpusmill.llm.neardup import near_duplicates
from corpusmill.llm.toxicity import toxicity
from corpusmill.llm.whitening import whiten

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


@query
def op8_near_duplicates(spark, sf):
    """Every document with its set size and component of near-duplicates."""
    return near_duplicates(table(spark, sf, "documents")).select("doc_id", "n_shingles", "component_id", "kept")


@query
def op4_language_id(spark, sf):
    """The language of every document, learned from the labelled ones that are not held out."""
    return identify(table(spark, sf, "documents"))


@query
def op2_toxicity(spark, sf):
    """A toxicity score for every document, learned from the labels that are not held out."""
    return toxicity(table(spark, sf, "documents"), table(spark, sf, "labels"))


@query
def op9_language_model(spark, sf):
    """Unigram and hidden Markov scores of every document."""
    return hmmlm.score(table(spark, sf, "documents"))


@query
def op10_decontamination(spark, sf):
    """Hit words and items of every document against all benchmark items."""
    found = decontaminate.report(table(spark, sf, "documents"), table(spark, sf, "benchmark"))
    return found.select("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")


@query
def op7_fingerprints(spark, sf):
    """Sketches of every document and its edited text, and how alike they are."""
    return fingerprints(table(spark, sf, "documents"))


@query
def op1_token_counts(spark, sf):
    """Histogram of the documents' token counts with suffix sums."""
    return tokencounts.histogram(tokencounts.lengths(table(spark, sf, "documents").select("text")))


@query
def op3_mixing(spark, sf):
    """Words that a weighted mix of the sources takes of every document."""
    return mix(table(spark, sf, "documents")).select("doc_id", "size", "source_size", "target", "taken")


@query
def op6_secrets(spark, sf):
    """Spans of secrets in every document."""
    return secrets.scan(table(spark, sf, "documents"))


@query
def op5_licenses(spark, sf):
    """Licence notices in every document."""
    return licenses.scan(table(spark, sf, "documents"))


@query
def op12_line_dedup(spark, sf):
    """Every document without the lines that ten or more documents have."""
    rows = dedup_lines(table(spark, sf, "documents"))
    return rows.select("doc_id", "n_lines", "n_dropped", F.sha2("kept", 256).alias("kept_sha256"))


@query
def op11_embedding_whitening(spark, sf):
    """Every embedding on the leading components of the distinct ones' covariance."""
    return whiten(table(spark, sf, "embeddings")).drop("eigenvalue")


@query
def op13_merkle_manifest(spark, sf):
    """Every document's leaf and proof, tried on rows of which some were tampered with."""
    tamper = F.crc32(F.col("doc_id").cast("string")) % 5 == 0
    return merkle.manifest(table(spark, sf, "documents"), tamper=tamper).drop("source")
