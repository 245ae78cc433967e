"""Features of texts as they arrive in a folder."""

from __future__ import annotations

import zlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusmill.params import Settings
from corpusmill.plans.jobs import new_rows, samples, style_features
from corpusmill.runtime import materialise, scratch
from corpusmill.sources.tables import table_exists

TEXT_SCHEMA = T.StructType([T.StructField("id", T.LongType()), T.StructField("lang", T.StringType()),
                            T.StructField("raw", T.StringType())])


def stream_features(spark: SparkSession, source: str, out: str, checkpoint: str, settings: Settings, *,
                    names: DataFrame | None = None, files_per_batch: int = 1000):
    """Process every file that is new since the last run, then stop.

    Each batch writes its own folder ``batch=<run>-<n>``, where the run is that
    of the checkpoint folder, and replaces it when the batch is tried again
    after a failure. An id that another batch has is left out, and of several
    rows of a batch with one id the first by language and text is kept, so no
    text appears twice, and a new checkpoint overwrites nothing.
    """
    run = f"{zlib.crc32(checkpoint.encode()):08x}"
    arriving = spark.readStream.schema(TEXT_SCHEMA).option("maxFilesPerTrigger", files_per_batch).parquet(source)

    def write(batch: DataFrame, number: int) -> None:
        with scratch(batch.sparkSession):
            fresh = batch
            if table_exists(spark, out):
                done = spark.read.schema("id bigint, batch string").parquet(out).where(F.col("batch") != f"{run}-{number}")
                fresh = new_rows(fresh, done)
            cut = samples(fresh, settings.sampling, keep=["lang"])
            once = cut.groupBy("id").agg(F.min(F.struct("lang", "sample")).alias("s")).select("id", "s.*")
            passages = materialise(once, "stream-samples")
            rows = style_features(passages, settings.style, names=names)
            rows.write.mode("overwrite").parquet(f"{out}/batch={run}-{number}")

    return (arriving.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
            .trigger(availableNow=True).start())
