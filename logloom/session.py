"""Session set-up and the one folder that all executors share."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

_SETTLED: ContextVar[list[str]] = ContextVar("settled", default=[])  # noqa: B039  (one list per process)


def build_session(app_name: str = "logloom", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the library is tuned for.

    AQE is what sizes shuffle partitions, splits skewed join partitions and turns a
    join into a broadcast join once the real size of a side is known, so nothing in
    the library forces a broadcast by hint.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        **{key.replace("__", "."): value for key, value in conf.items()},
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder for checkpoints and staged tables.

    The session names it, in ``spark.checkpoint.dir`` or as its checkpoint folder; there is no other.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    current = spark.sparkContext.getCheckpointDir()
    if current:
        return current.rstrip("/")
    raise ValueError("set spark.checkpoint.dir to a folder that all executors can reach")


def settle(df: DataFrame) -> DataFrame:
    """Write ``df`` as a table to the shared folder and go on from the written copy.

    Used where later steps must see exactly the rows, and the row numbers, of one
    evaluation: executors may be lost and tasks rerun after it without any change.
    Steps that need few of the columns read just those.
    """
    stored, path = written(df)
    _SETTLED.get().append(path)
    return stored


def written(df: DataFrame) -> tuple[DataFrame, str]:
    """A copy of ``df`` in the shared folder, and its path, for the caller to delete."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/logloom-settled/{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path), path


def forget_settled(spark: SparkSession) -> None:
    """Delete the tables settled so far, once no result depends on them any more."""
    paths = _SETTLED.get()
    while paths:
        delete(spark, paths.pop())


def delete(spark: SparkSession, path: str) -> None:
    found = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    found.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(found, True)


@contextmanager
def settled_here(spark: SparkSession) -> Iterator[None]:
    """For work that ends with a write: what it settles is deleted afterwards."""
    token = _SETTLED.set([])
    try:
        yield
    finally:
        forget_settled(spark)
        _SETTLED.reset(token)
