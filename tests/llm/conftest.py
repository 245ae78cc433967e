import pytest
from pyspark.sql import functions as F

COLUMNS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture
def docs(spark):
    """A table like ``documents`` from (doc_id, text[, lang[, source]]) rows, in a few partitions."""
    def make(rows, extra=False):
        full = [(*r, *(None,) * (4 - len(r))) for r in rows]
        full = [(*r, None if r[1] is None else len(r[1])) for r in full]
        df = spark.createDataFrame(full, COLUMNS).repartition(3)
        if extra:  # names that operators might use themselves
            for name in ("row", "key", "node", "code", "n", "score", "size", "digest", "term", "toxic", "block", "part"):
                df = df.withColumn(name, F.lit("clash"))
        return df
    return make


@pytest.fixture
def small_docs(spark):
    return spark.read.parquet("/root/testdata/sf0.001/documents.parquet")


def plain_words(text):
    import re
    return re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate({i: i + 32 for i in range(65, 91)}))
