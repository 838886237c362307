"""Topics: options to read and write them, and the key and value of the records.

The connector is a separate Spark package; without it on the class path ``load`` and
``start`` fail, everything else here works.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import DataStreamWriter

from ..functions.json_codec import encode

# Topic names, and the column each kind of record is keyed by.
LOG_EVENTS, RAW_LOGS, PARSED_EVENTS, PARSING_DLQ = "log-events", "raw-logs", "parsed-events", "parsing-dlq"
RECORD_KEYS = {
    "organization_event": "organization_id",
    "correlated_event": "correlation_id",
    "file_event": "id",
    "parsed_event": "ip_address",
    "traced_event": "trace_id",
    "raw_line": None,
}


def read_options(servers: str, topic: str, starting: str = "earliest",
                 per_trigger: int | None = None, min_partitions: int | None = None) -> dict[str, str]:
    options = {"kafka.bootstrap.servers": servers, "subscribe": topic, "startingOffsets": starting}
    if per_trigger is not None:
        options["maxOffsetsPerTrigger"] = str(per_trigger)
    if min_partitions is not None:
        options["minPartitions"] = str(min_partitions)
    return options


def _as_text(records: DataFrame) -> DataFrame:
    return records.select(
        F.col("key").cast("string").alias("key"), F.col("value").cast("string").alias("value"),
        "topic", "partition", "offset", "timestamp")


def read_topic_stream(spark: SparkSession, servers: str, topic: str, **settings) -> DataFrame:
    """Unbounded stream of a topic; the checkpoint of the query keeps its progress."""
    return _as_text(spark.readStream.format("kafka").options(**read_options(servers, topic, **settings)).load())


def read_topic(spark: SparkSession, servers: str, topic: str, **settings) -> DataFrame:
    """What a topic holds now."""
    return _as_text(spark.read.format("kafka").options(**read_options(servers, topic, **settings)).load())


def records(df: DataFrame, key: str | None, *columns: str | Column) -> DataFrame:
    """Rows as topic records: JSON value, key as text or none."""
    fields = columns or tuple(df.columns)
    return df.select(
        (F.col(key).cast("string") if key else F.lit(None).cast("string")).alias("key"),
        encode(*fields).alias("value"))


def raw_records(lines: DataFrame, line: str = "value") -> DataFrame:
    """Raw lines as records without key; the value is the line itself."""
    return lines.select(F.lit(None).cast("string").alias("key"), F.col(line).alias("value"))


def write_topic(rows: DataFrame, servers: str, topic: str) -> None:
    rows.write.format("kafka").option("kafka.bootstrap.servers", servers).option("topic", topic).save()


def write_topic_stream(rows: DataFrame, servers: str, topic: str, checkpoint: str) -> DataStreamWriter:
    return (rows.writeStream.format("kafka").option("kafka.bootstrap.servers", servers)
            .option("topic", topic).option("checkpointLocation", checkpoint))
