"""Hot and cold tier, the router that feeds all three tiers, and the hourly journal."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..functions.json_codec import encode
from ..functions.time import Moment, before, moment
from ..operators.filters import cold_condition, cold_eligible
from ..operators.joins import HOT_HOURS, hot_view
from ..operators.latest import latest_per_key
from . import compaction
from .layout import day_folder, drop_partitions, with_day, write_partitions
from .warm import append_events


def as_document(events: DataFrame) -> Column:
    """An event as one JSON document."""
    return encode(*events.columns)


def hot_rows(events: DataFrame, as_of: Moment, tie: str = "id") -> DataFrame:
    """Newest live event per trace id as ``trace_id, timestamp, document``."""
    live = hot_view(events, as_of, tie)
    return live.select("trace_id", "timestamp", as_document(live).alias("document"))


def read_hot(spark: SparkSession, path: str, as_of: Moment) -> DataFrame:
    """What the hot tier holds now: of the documents that are not yet a day old the last one written per trace id.

    Later batches are later writes; inside a batch there is one document per trace id.
    """
    since = before(as_of, hours=HOT_HOURS)
    stored = compaction.stored(spark, path).filter(
        (F.col("date") >= F.lit(since.date())) & (F.col("timestamp") > moment(since)))
    written = [F.col("batch").desc(), F.col("timestamp").desc_nulls_last(), F.col("document").desc()]
    return latest_per_key(stored, ["trace_id"], written).select("trace_id", "timestamp", "document")


def expire_hot(spark: SparkSession, path: str, as_of: Moment) -> None:
    """Drop the days of the hot tier that have outlived their time as a whole."""
    oldest = F.lit(before(as_of, hours=HOT_HOURS).date())
    compaction.finish_compactions(spark, path)
    days = spark.read.parquet(path).filter(F.col("date") < oldest).select("date").distinct()
    drop_partitions(spark, path, [day_folder(row["date"]) for row in days.collect()])


def cold_rows(events: DataFrame, as_of: Moment, ts: str = "timestamp") -> DataFrame:
    """Cold events with the partition they go to and the name of that partition as a file."""
    cold = cold_eligible(events, as_of)
    level, day = F.lower("level"), F.to_date(ts)
    return cold.select(
        *[c for c in events.columns if c != "level"], level.alias("level"), day.alias("date"),
        F.concat(level, F.lit("-"), F.date_format(ts, "yyyy-MM-dd"), F.lit(".log")).alias("file_name"))


def append_cold(events: DataFrame, path: str, as_of: Moment, batch_id: int | None = None) -> None:
    """Newline JSON below ``level=<level>/date=<day>``."""
    rows = cold_rows(events, as_of).drop("file_name")
    write_partitions(rows, path, ["level", "date"], "json", batch_id)


def tier_flags(events: DataFrame, as_of: Moment) -> DataFrame:
    """Which tiers each event goes to: warm always, hot while it has a trace id and is live, cold by rule."""
    live = F.col("timestamp") > moment(before(as_of, hours=HOT_HOURS))
    return events.withColumns({
        "warm": F.lit(True),
        "hot": F.coalesce(live & F.col("trace_id").isNotNull(), F.lit(False)),
        "cold": cold_condition(as_of),
    })


def store_batch(events: DataFrame, base: str, as_of: Moment, batch_id: int, tie: str = "id") -> None:
    """One batch to all three tiers.

    The three writes are not one transaction; each overwrites only what the same batch
    wrote before, so running the batch again completes it.
    """
    events = events.persist()
    try:
        append_events(events, f"{base}/warm", batch_id)
        hot = with_day(hot_rows(events, as_of, tie))
        write_partitions(hot, f"{base}/hot", ["date"], batch_id=batch_id)
        append_cold(events, f"{base}/cold", as_of, batch_id)
    finally:
        events.unpersist()


def journal_rows(events: DataFrame, as_of: Moment) -> DataFrame:
    """Events as journal lines with the hour file they belong to (the hour of writing)."""
    return events.select(
        F.date_format(moment(as_of), "yyyy-MM-dd").alias("date"),
        F.date_format(moment(as_of), "HH").alias("hour"),
        F.concat(F.lit("wal-"), F.date_format(moment(as_of), "yyyy-MM-dd-HH"), F.lit(".log")).alias("file_name"),
        as_document(events).alias("value"))


def append_journal(events: DataFrame, path: str, as_of: Moment, batch_id: int | None = None) -> None:
    """Newline JSON below ``date=<day>/hour=<hour>``, one file set per hour of writing."""
    rows = journal_rows(events, as_of).select("value", "date", "hour")
    if batch_id is not None:
        rows = rows.withColumn("batch", F.lit(batch_id))
        (rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy("date", "hour", "batch").text(path))
    else:
        rows.write.mode("append").partitionBy("date", "hour").text(path)
