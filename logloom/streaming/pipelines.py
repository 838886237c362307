"""Continuous forms of the batch operators.

Progress is the checkpoint of the query. A batch that is run again after a failure
rewrites only what it wrote before, so delivery is at least once and the stored result
is the same as after one delivery.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from ..functions.time import Moment
from ..operators.dedup import REPEAT_SECONDS, drop_seen, remember
from ..operators.filters import error_events
from ..operators.parse import dead_letters, parse_access_lines, parsed_only
from ..session import settle, settled_here
from ..sinks.layout import drop_partitions, table_exists, with_day, write_partitions
from ..sinks.letters import append_letters
from ..sinks.tiers import store_batch
from ..sinks.warm import upsert_events
from ..sources.ingest import decode_access_logs, decode_events, ingested, split_decoded

Clock = Callable[[], Moment]


def wall_clock() -> datetime:
    return datetime.now(timezone.utc).replace(tzinfo=None)


def _each_batch(stream: DataFrame, handle: Callable[[DataFrame, int], None], checkpoint: str,
                every: str | None) -> DataStreamWriter:
    writer = stream.writeStream.foreachBatch(handle).option("checkpointLocation", checkpoint)
    return writer.trigger(processingTime=every) if every else writer.trigger(availableNow=True)


def parse_stream(lines: DataFrame, base: str, checkpoint: str, clock: Clock = wall_clock,
                 line: str = "value", keep: list[str] | None = None, every: str | None = None, counters: str | None = None) -> StreamingQuery:
    """Access-log lines to ``base/parsed`` and ``base/dlq``; parsed once, routed twice.

    ``counters`` names a folder for the numbers of lines of each batch by format, see :func:`read_counters`.
    """

    def handle(batch: DataFrame, batch_id: int) -> None:
        parsed = parse_access_lines(batch, clock(), line, keep).persist()
        try:
            write_partitions(with_day(parsed_only(parsed)), f"{base}/parsed", ["date"], batch_id=batch_id)
            append_letters(dead_letters(parsed), f"{base}/dlq", batch_id)
            if counters is not None:
                counted = parsed.groupBy("log_format").agg(F.count(F.lit(1)).alias("lines"))
                write_partitions(counted.coalesce(1), counters, [], batch_id=batch_id)
        finally:
            parsed.unpersist()

    return _each_batch(lines, handle, checkpoint, every).start()


def read_counters(spark: SparkSession, path: str) -> DataFrame:
    """Lines of a running parse stream so far, by format, and its batches; a batch that was run again counts once."""
    return spark.read.parquet(path).groupBy("log_format").agg(F.sum("lines").alias("lines"), F.count_distinct("batch").alias("batches"))


def tier_stream(records: DataFrame, schema: T.StructType, base: str, checkpoint: str,
                clock: Clock = wall_clock, id_from: list[str] | None = None,
                every: str | None = None) -> StreamingQuery:
    """JSON events to the three tiers, undecodable records to ``base/dlq``."""

    def handle(batch: DataFrame, batch_id: int) -> None:
        now = clock()
        decoded = decode_events(batch, schema).persist()  # read and decoded once for all four writes
        try:
            ready = ingested(split_decoded(decoded, now), now, id_from)
            store_batch(ready.events, base, now, batch_id)
            append_letters(ready.dead, f"{base}/dlq", batch_id)
        finally:
            decoded.unpersist()

    return _each_batch(records, handle, checkpoint, every).start()


def access_stream(records: DataFrame, base: str, checkpoint: str, clock: Clock = wall_clock,
                  keep: list[str] | None = None, every: str | None = None) -> StreamingQuery:
    """Parsed access records, as JSON, to the day partitions of ``base/access``."""

    def handle(batch: DataFrame, batch_id: int) -> None:
        write_partitions(with_day(decode_access_logs(batch, clock(), keep=keep)), f"{base}/access", ["date"], batch_id=batch_id)

    return _each_batch(records, handle, checkpoint, every).start()


def upsert_stream(events: DataFrame, path: str, checkpoint: str, key: str = "id",
                  version: str = "processed_at", every: str | None = None, arrival: str | None = None,
                  days_can_change: bool = True, alerts: str | None = None) -> StreamingQuery:
    """Events to the warm table by id; those without id to ``path`` + ``_rejects``, errors also to the folder ``alerts``."""

    def handle(batch: DataFrame, batch_id: int) -> None:
        upsert_events(batch, path, key, version, days_can_change, arrival, f"{path}_rejects", batch_id)
        if alerts is not None:
            write_partitions(with_day(error_events(batch)), alerts, ["date"], batch_id=batch_id)

    return _each_batch(events, handle, checkpoint, every).start()


def _seen_before(spark: SparkSession, path: str, batch_id: int, schema: T.StructType) -> DataFrame:
    """The remembered hashes that the previous batch left."""
    previous = f"{path}/batch={batch_id - 1}"
    if batch_id > 0 and table_exists(spark, previous):
        return spark.read.schema(schema).parquet(previous)
    return spark.createDataFrame([], schema)


def dedup_stream(events: DataFrame, base: str, checkpoint: str, key: str = "content_hash",
                 ts: str = "timestamp", tie: str = "id", ttl_seconds: int = REPEAT_SECONDS,
                 every: str | None = None) -> StreamingQuery:
    """Events without repeats to ``base/events``, equal to the batch operator over the whole input.

    The remembered hashes are a table with one version per batch: a batch reads the
    version before it and writes its own, so running it again gives the same result.
    Input must arrive in time order from batch to batch. Rows meet their remembered
    hash in a join, not in a state store, so a very frequent hash is no hot spot.
    """

    def handle(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        schema = T.StructType([batch.schema[key], batch.schema[ts]])
        seen = _seen_before(spark, f"{base}/seen", batch_id, schema)
        with settled_here(spark):
            kept = settle(drop_seen(batch, seen, key, ts, tie, ttl_seconds))
            write_partitions(with_day(kept, ts), f"{base}/events", ["date"], batch_id=batch_id)
            newest = batch.agg(F.max(ts).alias("t")).first()["t"]
            left = remember(seen, kept, newest, key, ts, ttl_seconds) if newest is not None else seen
            left.write.mode("overwrite").parquet(f"{base}/seen/batch={batch_id}")
            drop_partitions(spark, f"{base}/seen", [f"batch={batch_id - 2}"])  # a replay needs the last version only

    return _each_batch(events, handle, checkpoint, every).start()


def drop_repeats_within_watermark(events: DataFrame, key: str = "content_hash", ts: str = "timestamp",
                                  ttl: str = "30 minutes") -> DataFrame:
    """The built-in streaming form: repeats inside the life time are dropped, some later ones too.

    State is cleared only when the watermark passes, so this is cheaper than
    :func:`dedup_stream` but not equal to the batch operator.
    """
    return events.withWatermark(ts, ttl).dropDuplicatesWithinWatermark([key])


def observed(df: DataFrame, name: str, **conditions) -> DataFrame:
    """Attach run counters to a batch or stream; they arrive with the progress events of the query."""
    counters = [F.count(F.lit(1)).alias("received")]
    counters += [F.count_if(condition).alias(label) for label, condition in conditions.items()]
    return df.observe(name, *counters)
