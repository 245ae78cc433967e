import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from corpusmill.runtime import session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    s = session("tests", master="local[8]", partitions=4, **{
        "spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false", "spark.driver.memory": "8g",
        "spark.checkpoint.dir": str(tmp_path_factory.mktemp("shared"))})
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()


@pytest.fixture
def one(spark):
    """Evaluate a column function on single values."""
    from pyspark.sql import functions as F

    def run(fn, *values, schema="string"):
        cols = ", ".join(f"c{i} {schema}" for i in range(len(values)))
        return spark.createDataFrame([tuple(values)], cols).select(
            fn(*[F.col(f"c{i}") for i in range(len(values))]).alias("r")).first()["r"]
    return run
