"""Session helpers: shared work folder, written stages, spreading of small files."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager
from contextvars import ContextVar, copy_context

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_local_dirs: dict[str, str] = {}
_scratch: ContextVar[list[str] | None] = ContextVar("scratch", default=None)


def session(app: str = "corpusmill", master: str | None = None, partitions: int | None = None,
            **extra: str) -> SparkSession:
    """A session with the settings every job relies on."""
    builder = (SparkSession.builder.appName(app)
               .config("spark.sql.session.timeZone", "UTC")
               .config("spark.sql.adaptive.enabled", "true")
               .config("spark.sql.adaptive.skewJoin.enabled", "true"))
    if master:
        builder = builder.master(master)
    if partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(partitions))
    for key, value in extra.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors can reach, as the cluster names it in ``spark.checkpoint.dir``.

    Only a session whose driver is its one executor may leave it out, as tests
    do; it then works in a folder of its own. Any other has to name it.
    """
    named = spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
        raise ValueError("set spark.checkpoint.dir to a folder that every executor can reach")
    app = spark.sparkContext.applicationId
    if app not in _local_dirs:
        _local_dirs[app] = tempfile.mkdtemp(prefix="corpusmill-")
    return _local_dirs[app]


def fresh_path(spark: SparkSession, name: str) -> str:
    """A path below the shared folder that no other run uses."""
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


#: Parquet writers look at sizes only every hundred rows; a hundred long rows would be one page, held whole to be
#: compressed and read. With these they look every few rows and end pages at 1 MB and row groups at 4 MB.
LONG_ROWS = {"parquet.block.size": str(4 << 20), "parquet.block.size.row.check.min": "4",
             "parquet.page.size.row.check.min": "4", "parquet.page.size.check.estimate": "false"}


def materialise(df: DataFrame, name: str = "stage", options: dict[str, str] | None = None) -> DataFrame:
    """Write ``df`` to the shared folder as Parquet, with these options of the writer, and read it back.

    Used where several branches read one expensive result. Unlike a cached
    table the written one survives the loss of executors, and unlike a plain
    checkpoint it keeps column pruning and filter push-down. It is deleted at
    the end of ``scratch``, and anyway when the driver ends.
    """
    spark = df.sparkSession
    path = fresh_path(spark, name)
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(target)
    df.write.options(**(options or {})).parquet(path)
    kept = _scratch.get()
    if kept is not None:
        kept.append(path)
    return spark.read.schema(df.schema).parquet(path)


@contextmanager
def scratch(spark: SparkSession):
    """Delete the tables that were materialised inside, once results are written."""
    paths: list[str] = []
    token = _scratch.set(paths)
    try:
        yield
    finally:
        _scratch.reset(token)
        for path in paths:
            target = spark._jvm.org.apache.hadoop.fs.Path(path)
            target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def at_once(*jobs: Callable) -> list:
    """The results of jobs that do not need each other, run side by side.

    Each runs in a copy of the context, so that what it writes is deleted with the rest.
    """
    with ThreadPoolExecutor(len(jobs)) as pool:
        return [run.result() for run in [pool.submit(copy_context().run, job) for job in jobs]]


def spread(df: DataFrame) -> DataFrame:
    """Deal the rows of an input out to as many tasks as the session asks for.

    Texts are not moved unless the caller sets ``spark.corpusmill.spread``,
    which only makes sense for one small file that arrives as a single split.
    """
    tasks = df.sparkSession.conf.get("spark.corpusmill.spread", None)
    return df if tasks is None or df.isStreaming else df.repartition(int(tasks))


def computed_once(df: DataFrame, column: str) -> DataFrame:
    """Keep an expensive column from being computed twice.

    A filter on a computed column is pushed below the projection and takes a
    copy of the expression with it: good for cheap columns, but it would clean
    every text twice. A filter is not pushed through a generator, so the column
    goes through one that yields its single value.
    """
    return df.withColumn(column, F.explode(F.array(column)))
