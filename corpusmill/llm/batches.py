"""How much text reaches a Python worker at once."""

from __future__ import annotations

from pyspark.sql import SparkSession

SETTING = "spark.sql.execution.arrow.maxBytesPerBatch"
BYTES = 4 << 20


def small_batches(spark: SparkSession) -> None:
    """Bound the session's Arrow batches, which by default only end after 10,000 rows, however long.

    A lower bound that the session already has stays.
    """
    now = spark.conf.get(SETTING).lower().removesuffix("b")
    if not now.isdigit() or int(now) > BYTES or int(now) <= 0:
        spark.conf.set(SETTING, str(BYTES))
