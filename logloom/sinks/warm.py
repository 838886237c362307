"""Warm table: Parquet, one partition per day."""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..functions.json_codec import encode
from ..functions.time import Moment, as_datetime, epoch_seconds, moment
from ..operators.filters import EPOCH
from ..operators.joins import cascade
from ..operators.latest import upsert
from ..session import settle, settled_here
from .compaction import finish_compactions
from .layout import (day_folder, drop_partitions, lookup_options, on_days, replace_partitions, table_exists, with_day,
                     write_partitions)
from .letters import append_letters

# Fixed value: how long events are kept.
RETENTION_DAYS = 30
#: Batch number of days that were merged.
MERGED = -1


def with_bounds(events: DataFrame) -> DataFrame:
    """Add the columns that time filters use to skip partitions and row groups."""
    return with_day(events).withColumn(EPOCH, epoch_seconds(F.col("timestamp")))


def append_events(events: DataFrame, path: str, batch_id: int | None = None,
                  within: list[str] | None = None) -> None:
    """Append to the day partitions, sorted by time inside files, with filters for lookups by id."""
    write_partitions(with_bounds(events), path, ["date"], batch_id=batch_id, within=within or ["timestamp"],
                     **lookup_options(events))


def append_metadata(events: DataFrame, path: str, batch_id: int | None = None, key: str = "id") -> None:
    """Metadata maps as child rows, in the day partition of their event."""
    rows = with_day(events).select(
        "date", F.col(key).alias("log_event_id"), F.explode("metadata").alias("key", "value"))
    write_partitions(rows, path, ["date"], batch_id=batch_id)


def upsert_events(batch: DataFrame, path: str, key: str = "id", version: str = "processed_at",
                  days_can_change: bool = True, arrival: str | None = None, rejects: str | None = None,
                  batch_id: int | None = None) -> None:
    """Store a batch by id: last write wins, and storing a batch twice changes nothing.

    ``arrival`` names a column that orders writes of one version. Rows without id cannot be stored by id: they go to
    the dead-letter folder ``rejects``, once for a ``batch_id``, or the batch is refused. Only the days the batch touches are
    rewritten; in a table that was appended in batches, they become one batch each. An event whose day changed also
    touches its old day; if that cannot happen (a redelivered event keeps its time),
    ``days_can_change=False`` saves the search for old days.
    """
    spark = batch.sparkSession
    with settled_here(spark):
        incoming = settle(with_bounds(batch))
        nameless = incoming.filter(F.col(key).isNull())
        if not nameless.isEmpty():
            if rejects is None:
                raise ValueError(f"rows without {key}; name a folder for rejects")
            shown = encode(*batch.columns).alias("raw_log")
            append_letters(nameless.select(shown, F.lit(f"no {key}").alias("failure_reason"), "timestamp"), rejects, batch_id)
            incoming = incoming.filter(F.col(key).isNotNull())
        if not table_exists(spark, path):
            _replace_days(upsert(incoming.limit(0), incoming, key, version, arrival), path)
            return
        finish_compactions(spark, path)
        stored = spark.read.parquet(path)
        batched = "batch" in stored.columns
        touched = incoming.select("date")
        if days_can_change:
            touched = touched.unionByName(stored.join(incoming.select(key), key, "left_semi").select("date"))
        days = [row["date"] for row in touched.distinct().collect()]  # calendar days, not rows
        old = stored.filter(on_days(days))
        before = [(row["date"], row["batch"]) for row in old.select("date", "batch").distinct().collect()] if batched else []
        merged = settle(upsert(old.drop("batch"), incoming, key, version, arrival))
        left = {row["date"] for row in merged.select("date").distinct().collect()}
        if batched:
            # Until the older batches are gone a reader may see a row twice; storing the batch again mends that.
            _replace_days(merged.withColumn("batch", F.lit(MERGED)), path, ["date", "batch"])
            drop_partitions(spark, path, [f"{day_folder(day)}/batch={number}" for day, number in before if number != MERGED or day not in left])
        else:
            _replace_days(merged, path)
            drop_partitions(spark, path, [day_folder(day) for day in days if day not in left])


def _replace_days(events: DataFrame, path: str, columns: list[str] | None = None) -> None:
    replace_partitions(events, path, columns or ["date"], within=["timestamp"], **lookup_options(events))


def expired(events: DataFrame, as_of: Moment, days: int = RETENTION_DAYS, ts: str = "timestamp") -> DataFrame:
    """Events older than the limit; an event without time never expires."""
    return events.filter(F.col(ts) < moment(as_datetime(as_of) - timedelta(days=days)))


def retained(events: DataFrame, as_of: Moment, days: int = RETENTION_DAYS, ts: str = "timestamp") -> DataFrame:
    limit = moment(as_datetime(as_of) - timedelta(days=days))
    return events.filter(F.col(ts).isNull() | (F.col(ts) >= limit))


def apply_retention(spark: SparkSession, path: str, as_of: Moment, days: int = RETENTION_DAYS,
                    children: str | None = None, key: str = "id") -> int:
    """Delete expired events and return their number.

    Days that are over as a whole are dropped as folders. Only the day the limit falls
    into is rewritten. ``children`` names the metadata table: its whole days go with those of the
    events, and on the edge day the rows whose event has gone.
    """
    limit = as_datetime(as_of) - timedelta(days=days)
    finish_compactions(spark, path)
    stored = spark.read.parquet(path)
    deleted = expired(stored.filter(F.col("date") <= F.lit(limit.date())), as_of, days).count()
    if not deleted:
        return 0
    with settled_here(spark):
        kept = settle(retained(stored.filter(F.col("date") == F.lit(limit.date())), as_of, days))
        if children is not None and table_exists(spark, children):
            finish_compactions(spark, children)
            rows = spark.read.parquet(children)
            own = rows.filter(F.col("date") == F.lit(limit.date()))
            _keep_days(spark, children, limit, settle(cascade(own, kept, key)), [])
        _keep_days(spark, path, limit, kept, ["timestamp"])
    return deleted


def _keep_days(spark: SparkSession, path: str, limit: datetime, kept: DataFrame, within: list[str]) -> None:
    """Leave of the days before ``limit`` nothing and of its own day the ``kept`` rows."""
    stored = spark.read.parquet(path)
    past = stored.filter(F.col("date") < F.lit(limit.date())).select("date").distinct()
    gone = [day_folder(row["date"]) for row in past.collect()]
    # A day holds one folder per batch if it was written in batches; each is replaced or goes.
    columns = [c for c in ("date", "batch") if c in stored.columns]
    last_day = stored.filter(F.col("date") == F.lit(limit.date()))
    emptied = last_day.select(columns).distinct().join(kept.select(columns).distinct(), columns, "left_anti")
    gone += ["/".join(f"{c}={row[c]}" for c in columns) for row in emptied.collect()]
    if not kept.isEmpty():
        replace_partitions(kept, path, columns, within=within, **lookup_options(kept))
    drop_partitions(spark, path, gone)
