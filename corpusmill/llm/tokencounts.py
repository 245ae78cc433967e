"""Token counts: an exact histogram of encoded lengths with suffix sums for every context limit."""

from __future__ import annotations

import base64
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from corpusmill.llm.batches import small_batches
from corpusmill.llm.wordcodes import chunks
from corpusmill.runtime import materialise

#: Fixed value: how the vocabulary's tokenizer splits a text.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


#: Fixed value: all that ``\s`` matches in the pattern.
SPACES = "\t\n\x0b\x0c\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
#: White space of this length is not given to the pattern, which would go through it by recursion.
LONG_SPACE = 256
_LONG = re.compile(f"(?<![{SPACES}])[{SPACES}]{{{LONG_SPACE},}}")


@dataclass(frozen=True)
class Tokenizer:
    """A file of byte-pair ranks (``base64 rank`` lines) that the driver can read."""

    path: str = "/opt/tokenizers/byte_bpe_50k.tiktoken"
    pattern: str = PATTERN
    max_bytes: int = 64 << 20




def lengths(docs: DataFrame, p: Tokenizer = Tokenizer(), out: str = "_n_tokens") -> DataFrame:
    """``docs`` with the number of tokens of each text behind its columns; a null text has none.

    White space, letters or marks of any length are encoded as the tokenizer
    would without bounds of its own, see ``counted``.
    """
    with open(p.path, "rb") as file:
        data = file.read(p.max_bytes + 1)
    if len(data) > p.max_bytes:
        raise ValueError(f"{p.path} is larger than {p.max_bytes} bytes")
    small_batches(docs.sparkSession)
    sent = docs.sparkSession.sparkContext.broadcast(data)

    def run(batches) -> Iterator[pa.RecordBatch]:
        encode = _encoder(sent.value, p.pattern)
        for batch in chunks(batches, "text"):
            column = batch.column(batch.schema.get_field_index("text"))
            spaced = pc.match_substring_regex(pc.fill_null(column, ""), f"[{SPACES}]{{{LONG_SPACE}}}")
            texts = column.to_pylist()
            n = np.fromiter(((counted(encode, t) if long else len(encode.encode_ordinary(t))) if t else 0
                             for t, long in zip(texts, spaced.to_pylist(), strict=True)), np.int64, len(texts))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(n)], names=[*batch.schema.names, out])

    return docs.mapInArrow(run, StructType([*docs.schema.fields, StructField(out, LongType())]))


_encoders: dict = {}


def _encoder(data: bytes, pattern: str):
    import tiktoken

    key = hash((data, pattern))
    if key not in _encoders:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, data.splitlines())}
        _encoders[key] = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
    return _encoders[key]


def counted(encoding, text: str) -> int:
    """Tokens of a text, long white space cut off before the pattern sees it.

    The pattern takes white space before other characters without its last
    one, which goes with what follows, and white space at the end whole. Such a
    piece is one for the byte pairs, and nothing else crosses its ends.
    """
    total, done = 0, 0
    for run in _LONG.finditer(text):
        end = run.end() if run.end() == len(text) else run.end() - 1
        total += len(encoding.encode_ordinary(text[done:run.start()]))
        total += len(encoding._encode_single_piece(text[run.start():end]))
        done = end
    return total + len(encoding.encode_ordinary(text[done:]))


def _bucket(length: str) -> Column:
    """A rising number of at most 2048 values per power of two."""
    e = F.greatest(F.lit(0), F.floor(F.log2(F.col(length) + 1)).cast("int") - 10)
    return e * 2048 + F.floor(F.col(length) / F.pow(F.lit(2.0), e))


def histogram(lengths_: DataFrame, length: str = "_n_tokens") -> DataFrame:
    """One row per length: documents of it, and sums over all documents of at least that length.

    ``n_docs``, ``docs_at_least``, ``tokens_at_least``; ``truncated_total`` is
    what is left of all documents under that limit, ``quantile`` the share of
    documents that are not longer. Sums run inside buckets of neighbouring
    lengths and then over the buckets, whose number is fixed. An empty table
    gives no rows.
    """
    rows = lengths_.groupBy(F.col(length).alias("n_tokens")).agg(F.count("*").alias("n_docs"))
    rows = materialise(rows.withColumn("bucket", _bucket("n_tokens")), "lengths")  # or texts would be encoded twice
    tokens = F.col("n_tokens") * F.col("n_docs")
    sums = rows.groupBy("bucket").agg(F.sum("n_docs").alias("d"), F.sum(tokens).alias("t"))
    above = Window.orderBy(F.desc("bucket")).rowsBetween(Window.unboundedPreceding, -1)
    every = Window.orderBy(F.desc("bucket")).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    sums = sums.select(
        "bucket", F.coalesce(F.sum("d").over(above), F.lit(0)).alias("d_above"),
        F.coalesce(F.sum("t").over(above), F.lit(0)).alias("t_above"),
        F.sum("d").over(every).alias("docs"), F.sum("t").over(every).alias("tokens"))
    own = Window.partitionBy("bucket").orderBy(F.desc("n_tokens"))
    out = rows.join(sums, "bucket").select(
        "n_tokens", "n_docs", (F.sum("n_docs").over(own) + F.col("d_above")).alias("docs_at_least"),
        (F.sum(tokens).over(own) + F.col("t_above")).alias("tokens_at_least"), "docs", "tokens")
    return out.select(
        "n_tokens", "n_docs", "docs_at_least", "tokens_at_least",
        (F.col("tokens") - F.col("tokens_at_least") + F.col("n_tokens") * F.col("docs_at_least")).alias("truncated_total"),
        ((F.col("docs") - F.col("docs_at_least") + F.col("n_docs")) / F.col("docs")).alias("quantile"))


def at_limits(hist: DataFrame, limits: list[int]) -> DataFrame:
    """``limit, docs_longer, truncated_total`` for given context limits, from the histogram."""
    given = hist.sparkSession.createDataFrame([(int(x),) for x in limits], "limit long")
    beyond = F.when(F.col("n_tokens") > F.col("limit"), F.col("n_docs"))
    return hist.crossJoin(F.broadcast(given)).groupBy("limit").agg(
        F.coalesce(F.sum(beyond), F.lit(0)).alias("docs_longer"),
        F.sum(F.least("n_tokens", "limit") * F.col("n_docs")).alias("truncated_total"))


def quantile(hist: DataFrame, share: float) -> DataFrame:
    """``n_tokens``: the least length that at least this share of the documents do not exceed."""
    return hist.where(F.col("quantile") >= share).agg(F.min("n_tokens").alias("n_tokens"))
