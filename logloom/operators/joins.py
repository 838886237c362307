"""Joins. None forces a broadcast: with AQE a side is broadcast once its measured size allows it,
and a skewed partition of a sort-merge join is split."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from ..functions.names import unused
from ..functions.time import Moment, before, moment
from .frames import BLOCK_ROWS, in_blocks
from .latest import newest

# Life times of the hot tier and of cached locations.
HOT_HOURS = 24
LOCATION_DAYS = 7


def explode_metadata(events: DataFrame, key: str = "id") -> DataFrame:
    """Metadata map as child rows; events without metadata have none."""
    return events.select(F.col(key).alias("log_event_id"), F.explode("metadata").alias("key", "value"))


def assemble_metadata(events: DataFrame, metadata: DataFrame, key: str = "id") -> DataFrame:
    """Child rows back into a map column; events without child rows get null.

    Copies of a child row are merged before the shuffle; of different values of one key
    the greatest stays. The map column and the join share one shuffle by id.
    """
    sets = metadata.groupBy("log_event_id").agg(F.collect_set(F.struct("key", "value")).alias("_pairs"))

    def greatest(name: Column) -> Column:
        return F.array_max(F.filter("_pairs", lambda pair: pair["key"] == name))

    entries = F.transform(F.array_distinct(F.col("_pairs.key")), greatest)
    maps = sets.select(F.col("log_event_id").alias(key), F.map_from_entries(entries).alias("metadata"))
    return events.join(maps, key, "left")


def cascade(metadata: DataFrame, kept_events: DataFrame, key: str = "id") -> DataFrame:
    """Child rows whose parent still exists."""
    return metadata.join(
        kept_events.select(F.col(key).alias("log_event_id")), "log_event_id", "left_semi")


def hot_view(events: DataFrame, as_of: Moment, tie: str = "id") -> DataFrame:
    """Newest live event per trace id."""
    live = events.filter(F.col("timestamp") > moment(before(as_of, hours=HOT_HOURS)))
    return newest(live.filter(F.col("trace_id").isNotNull()), ["trace_id"], tie=tie)


def lookup_hot_then_warm(keys: DataFrame, hot: DataFrame, warm: DataFrame, tie: str = "id") -> DataFrame:
    """Events for a set of trace ids: from the hot tier where it has them, else from the warm one.

    ``copies`` counts the warm rows that share the trace id, 1 for an event that is in the hot tier only. Each
    tier is read once, and what it has for a trace id is one row before the tiers meet.
    """
    wanted = keys.select("trace_id").distinct()
    columns = [c for c in warm.columns if c in hot.columns]
    rest = [c for c in columns if c != "trace_id"]
    cold = newest_with_copies(warm.join(wanted, "trace_id", "left_semi").select(*columns), tie)
    cold = cold.select("trace_id", F.struct(*rest).alias("_warm"), "copies")
    live = hot.join(wanted, "trace_id", "left_semi").select("trace_id", F.struct(*rest).alias("_hot"))
    found = live.join(cold, "trace_id", "full_outer")
    tier = F.when(F.col("_hot").isNotNull(), F.lit("hot")).otherwise(F.lit("warm"))
    return found.withColumns({"_row": F.coalesce("_hot", "_warm"), "tier": tier, "copies": F.coalesce("copies", F.lit(1).cast("bigint"))}).select(
        "trace_id", "_row.*", "tier", "copies").select(*columns, "tier", "copies")


def newest_with_copies(events: DataFrame, tie: str = "id") -> DataFrame:
    """Newest event per trace id and how many events share it, merged before the shuffle."""
    row = F.struct(*[c for c in events.columns if c != "trace_id"])
    found = events.groupBy("trace_id").agg(
        F.max_by(row, F.struct("timestamp", tie)).alias("_row"), F.count(F.lit(1)).alias("copies"))
    return found.select("trace_id", "_row.*", "copies").select(*events.columns, "copies")


def live_locations(locations: DataFrame, as_of: Moment) -> DataFrame:
    """Last written location per address, while it is younger than a week."""
    live = locations.filter(F.col("cached_at") > moment(before(as_of, days=LOCATION_DAYS)))
    return newest(live, ["ip_address"], "cached_at", "location").select("ip_address", "location")


def add_location(events: DataFrame, locations: DataFrame) -> DataFrame:
    """Location of the address, null when unknown."""
    return events.join(locations.select("ip_address", "location"), "ip_address", "left")


def location_as_of(events: DataFrame, locations: DataFrame, ts: str = "timestamp", tie: str = "id", days: int = LOCATION_DAYS,
                   block_rows: int = BLOCK_ROWS) -> DataFrame:
    """``events`` with the ``location`` that was last written for their address up to their own time, if that was at most ``days`` before.

    Of locations written at one moment the largest counts. Events and locations are put in one order by address and time and cut into
    blocks; a block looks back inside itself, and only what was last known at the end of earlier blocks, one row per address and block, is carried
    on. So an address that holds most rows is still spread over many tasks. Events without address or time have no location.
    """
    position, home, key, at, kind, row, known, unique, carried = (
        unused(name, events) for name in ("_position", "_home", "_ip", "_time", "_kind", "_row", "_known", "_tie", "_carried"))
    timed = F.col("ip_address").isNotNull() & F.col(ts).isNotNull()
    moment_of = lambda column: F.col(column).cast("timestamp_ntz")
    asked = events.filter(timed).select(F.col("ip_address").alias(key), moment_of(ts).alias(at), F.lit(1).alias(kind), F.col(tie).cast("string").alias(unique),
                                        F.struct(*events.columns).alias(row), F.lit(None).cast("string").alias(known))
    told = locations.filter(F.col("ip_address").isNotNull() & F.col("cached_at").isNotNull()).select(
        F.col("ip_address").alias(key), moment_of("cached_at").alias(at), F.lit(0).alias(kind), F.col("location").alias(unique),
        F.lit(None).cast(asked.schema[row].dataType).alias(row), F.col("location").alias(known))
    blocks = in_blocks(asked.unionByName(told), [key], [at, kind, unique], block_rows, position, home)
    last = F.when(F.col(kind) == 0, F.struct(F.col(position), F.col(at), F.col(known)))
    ends = blocks.groupBy(key, home).agg(F.max(last).alias(carried))
    earlier = W.partitionBy(key).orderBy(home).rowsBetween(W.unboundedPreceding, -1)
    ends = ends.select(key, home, F.last(carried, ignorenulls=True).over(earlier).alias(carried))
    inside = W.partitionBy(key, home).orderBy(position).rowsBetween(W.unboundedPreceding, W.currentRow)
    seen = blocks.withColumn(known, F.last(last, ignorenulls=True).over(inside)).filter(F.col(kind) == 1).join(ends, [key, home])
    found = F.coalesce(known, carried)
    fresh = F.when(found[at] >= F.col(at) - F.make_dt_interval(F.lit(days)), found[known])
    located = seen.select(f"{row}.*", fresh.alias("location"))
    return located.unionByName(events.filter(~timed).withColumn("location", F.lit(None).cast("string")))


def system_stats(stats: DataFrame, services: list[str], metric: str) -> DataFrame:
    """One row with a column per service; a service without statistics shows ``unavailable``."""
    return stats.filter(F.col("metric") == metric).agg(*[
        F.coalesce(
            F.max(F.when(F.col("service") == name, F.col("value").cast("string"))),
            F.lit("unavailable")).alias(name)
        for name in services
    ])
