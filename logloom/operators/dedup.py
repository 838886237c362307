"""Repeats within a life time.

The life time runs from the last *kept* row of a hash, not from the previous row: of
rows at 0, 20 and 40 minutes with 30 minutes to live, 0 and 40 are kept. The kept times
of a hash are a chain (:mod:`.chains`); of rows at one kept time the first by id, then by
all other columns, is kept.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window as W, functions as F, types as T

from ..functions.names import unused
from ..functions.time import Moment, bucket, moment, seconds
from .chains import BLOCK_ROWS, chain_times, micros
from .latest import first_of_each, latest_per_key

# Fixed value: how long a seen line is remembered.
REPEAT_SECONDS = 30 * 60


def _whole_order(df: DataFrame, first: list[str]) -> list[Column]:
    """All columns as sort keys, ``first`` ahead; maps by their sorted entries."""
    rest = [c for c in df.columns if c not in first]
    return [F.array_sort(F.map_entries(c)).asc() if isinstance(df.schema[c].dataType, T.MapType) else F.col(c).asc()
            for c in [*first, *rest]]


def drop_repeats(df: DataFrame, key: str = "content_hash", ts: str = "timestamp", tie: str = "id",
                 ttl_seconds: int = REPEAT_SECONDS, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """Rows that are no repeat of a kept row within its life time.

    Rows without key or time cannot be judged and are kept.
    """
    judged = F.col(key).isNotNull() & F.col(ts).isNotNull()
    at = unused("_at", df)
    timed = df.filter(judged).withColumn(at, micros(df, ts))
    chain = chain_times(df.filter(judged), key, ts, ttl_seconds, block_rows).toDF(key, at)
    members = timed.join(chain, [key, at], "left_semi")
    firsts = latest_per_key(members, [key, at], _whole_order(df, [tie]))
    return firsts.select(*df.columns).unionByName(df.filter(~judged))


def drop_seen(batch: DataFrame, seen: DataFrame, key: str = "content_hash", ts: str = "timestamp",
              tie: str = "id", ttl_seconds: int = REPEAT_SECONDS) -> DataFrame:
    """Rows of a batch that repeat neither a remembered row nor an earlier row of the batch.

    ``seen`` holds one row per hash: (key, last kept time). A row from before that time is
    late, not a repeat: it is judged by the rows of its own batch.
    """
    name = unused("_last", batch)
    last = seen.select(F.col(key), F.col(ts).alias(name))
    repeat = (F.col(ts) >= F.col(name)) & (F.col(ts) < F.col(name) + seconds(ttl_seconds))
    fresh = batch.join(last, key, "left").filter(~F.coalesce(repeat, F.lit(False)))
    return drop_repeats(fresh.select(*batch.columns), key, ts, tie, ttl_seconds)


def remember(seen: DataFrame, kept: DataFrame, as_of: Moment, key: str = "content_hash",
             ts: str = "timestamp", ttl_seconds: int = REPEAT_SECONDS) -> DataFrame:
    """The ``seen`` table after a batch, without entries that have outlived their time."""
    both = seen.select(key, ts).unionByName(kept.filter(F.col(key).isNotNull()).select(key, ts))
    return both.groupBy(key).agg(F.max(ts).alias(ts)).filter(F.col(ts) + seconds(ttl_seconds) > moment(as_of))


def _openings(requests: DataFrame, client: str, ts: str, window_seconds: int, block_rows: int) -> DataFrame:
    """The first times of windows as distinct (client, ts)."""
    at = unused("_at", requests)
    timed = requests.withColumn(at, micros(requests, ts)).select(client, ts, at).distinct()
    chain = chain_times(requests, client, ts, window_seconds, block_rows).toDF(client, at)
    return timed.join(chain, [client, at], "left_semi").select(client, ts)


def _with_opening(requests: DataFrame, openings: DataFrame, client: str, ts: str, window_seconds: int) -> DataFrame:
    """Each request with the time its window opened.

    A request finds its opening in its own or the previous clock-aligned bucket, so the
    join is on equal keys, with at most three openings per client and bucket.
    """
    slot = unused("_bucket", requests)
    opened = openings.select(
        client, F.col(ts).alias("window_start"),
        F.explode(F.array(bucket(F.col(ts), window_seconds), bucket(F.col(ts), window_seconds) + 1)).alias(slot))
    timed = requests.withColumn(slot, bucket(F.col(ts), window_seconds))
    joined = timed.join(opened, [client, slot])
    inside = (F.col(ts) >= F.col("window_start")) & (F.col(ts) < F.col("window_start") + seconds(window_seconds))
    return joined.filter(inside).drop(slot)


def anchored_window_report(requests: DataFrame, client: str, window_seconds: int = 60, limit: int = 100,
                           ts: str = "timestamp", block_rows: int = BLOCK_ROWS) -> DataFrame:
    """Requests per client and window, where a window opens at the first request after the last one closed.

    The openings are the same chains as above. Requests of one moment are counted
    before they are joined to their opening.
    """
    openings = _openings(requests, client, ts, window_seconds, block_rows)
    n = unused("_n", requests)
    per_time = requests.groupBy(client, ts).agg(F.count(F.lit(1)).alias(n))
    counted = _with_opening(per_time, openings, client, ts, window_seconds).groupBy(client, "window_start").agg(
        F.sum(n).alias("requests"))
    return counted.select(
        client, "window_start", "requests",
        F.least("requests", F.lit(limit)).cast("bigint").alias("allowed"),
        F.greatest(F.col("requests") - limit, F.lit(0)).cast("bigint").alias("rejected"))


def anchored_window_admitted(requests: DataFrame, client: str, window_seconds: int = 60, limit: int = 100,
                             ts: str = "timestamp", tie: str = "id", block_rows: int = BLOCK_ROWS) -> DataFrame:
    """The requests that fit: the first ``limit`` of each such window, with its ``window_start``."""
    openings = _openings(requests, client, ts, window_seconds, block_rows)
    opened = _with_opening(requests, openings, client, ts, window_seconds)
    return first_of_each(opened, [client, "window_start"], [ts, tie], limit).select(*requests.columns, "window_start")
