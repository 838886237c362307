"""Shared by all sinks: day partitions, file sizes, idempotent batches, dropped partitions."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

# Columns that rows are looked up by.
LOOKUP_COLUMNS = ["id", "trace_id"]
# What Spark calls the partition of rows whose partition value is null.
NULL_PARTITION = "__HIVE_DEFAULT_PARTITION__"


def with_day(df: DataFrame, ts: str = "timestamp", day: str = "date") -> DataFrame:
    return df.withColumn(day, F.to_date(ts))


def lookup_options(events: DataFrame) -> dict[str, str]:
    """Write options that let a lookup by id skip row groups without the value."""
    return {f"parquet.bloom.filter.enabled#{name}": "true" for name in LOOKUP_COLUMNS if name in events.columns}


def balanced(df: DataFrame, *columns: str) -> DataFrame:
    """Rows of one target partition together, but a big partition split over several tasks.

    Small partitions end up in few files, and one that holds a third of all rows is
    still written by many tasks.
    """
    return df.hint("rebalance", *columns)


def write_partitions(df: DataFrame, path: str, columns: list[str], fmt: str = "parquet",
                     batch_id: int | None = None, within: list[str] | None = None, **options: str) -> None:
    """Append ``df`` partitioned by ``columns``.

    With a batch id the batch gets partitions of its own and overwrites just those, so
    a batch that is run again after a failure leaves no second copy. ``within`` sorts
    rows inside files, which lets readers skip row groups.
    """
    rows = balanced(df, *columns)
    if within:
        rows = rows.sortWithinPartitions(*columns, *within)
    if batch_id is None:
        rows.write.mode("append").options(**options).partitionBy(*columns).format(fmt).save(path)
    else:
        (rows.withColumn("batch", F.lit(batch_id)).write.mode("overwrite")
         .option("partitionOverwriteMode", "dynamic").options(**options)
         .partitionBy(*columns, "batch").format(fmt).save(path))


def replace_partitions(df: DataFrame, path: str, columns: list[str], fmt: str = "parquet",
                       within: list[str] | None = None, **options: str) -> None:
    """Overwrite exactly the partitions that occur in ``df``."""
    rows = balanced(df, *columns)
    if within:
        rows = rows.sortWithinPartitions(*columns, *within)
    (rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .options(**options).partitionBy(*columns).format(fmt).save(path))


def _hadoop_path(spark: SparkSession, path: str):
    found = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return found.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), found


def table_exists(spark: SparkSession, path: str) -> bool:
    files, found = _hadoop_path(spark, path)
    return bool(files.exists(found))


def list_folder(spark: SparkSession, path: str) -> list[str]:
    """Paths of what a folder holds; none if there is no such folder."""
    files, found = _hadoop_path(spark, path)
    return [str(entry.getPath().toString()) for entry in files.listStatus(found)] if files.exists(found) else []


def drop_files(spark: SparkSession, paths: Iterable[str]) -> None:
    for path in paths:
        files, found = _hadoop_path(spark, path)
        files.delete(found, False)


def drop_partitions(spark: SparkSession, path: str, names: Iterable[str]) -> None:
    """Remove whole partition folders such as ``date=2024-01-05``."""
    for name in names:
        files, found = _hadoop_path(spark, f"{path}/{name}" if name else path)
        files.delete(found, True)


def move_folder(spark: SparkSession, source: str, target: str) -> None:
    """Rename a folder; its new parent is made if it is not there."""
    files, found = _hadoop_path(spark, source)
    _, place = _hadoop_path(spark, target)
    files.mkdirs(place.getParent())
    if not files.rename(found, place):
        raise OSError(f"{source} cannot be moved to {target}")


def day_folder(day: object, column: str = "date") -> str:
    return f"{column}={NULL_PARTITION if day is None else day}"


def on_days(days: list[object], column: str = "date") -> Column:
    known = [day for day in days if day is not None]
    condition = F.col(column).isin(known) if known else F.lit(False)
    return condition | F.col(column).isNull() if None in days else condition
