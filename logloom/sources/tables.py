"""Stored tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, types as T


def read_table(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """A Parquet table; with a schema no file footer is read to plan the query."""
    reader = spark.read.schema(schema) if schema is not None else spark.read
    return reader.parquet(path)


def read_jdbc(spark: SparkSession, url: str, table: str, column: str | None = None,
              bounds: tuple[str, str] | None = None, partitions: int = 1, **options: str) -> DataFrame:
    """A database table, read in parallel ranges of ``column`` when bounds are given. Needs the driver jar."""
    settings = {"url": url, "dbtable": table, **options}
    if column is not None and bounds is not None:
        settings |= {"partitionColumn": column, "lowerBound": bounds[0], "upperBound": bounds[1],
                     "numPartitions": str(partitions)}
    return spark.read.format("jdbc").options(**settings).load()
