"""Dead letters."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..functions.json_codec import encode


def letter_documents(dead: DataFrame) -> DataFrame:
    """Dead letters as JSON; quotes, backslashes and control characters are escaped."""
    return dead.select(
        F.lit(None).cast("string").alias("key"),
        encode("raw_log", "failure_reason", "timestamp").alias("value"))


def append_letters(dead: DataFrame, path: str, batch_id: int | None = None) -> None:
    rows = dead.withColumn("date", F.to_date("timestamp"))
    if batch_id is None:
        rows.write.mode("append").partitionBy("date").json(path)
    else:
        (rows.withColumn("batch", F.lit(batch_id)).write.mode("overwrite")
         .option("partitionOverwriteMode", "dynamic").partitionBy("date", "batch").json(path))
