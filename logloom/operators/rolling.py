"""Reports over a moving frame: counter deltas, failure and slow-call rates, rate limits."""

from __future__ import annotations

from collections import deque
from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column, DataFrame, Window as W, functions as F, types as T

from ..functions.time import Moment, as_datetime, before, bucket, epoch_seconds, from_epoch_seconds, moment
from ..functions.names import unused
from .frames import BLOCK_ROWS, over_last_rows
from .latest import first_of_each

# The call window of the breaker settings and the limits of the rate limiters.
CALLS, MIN_CALLS, RATE_THRESHOLD = 10, 5, 0.5
SLOW_QUERY_SECONDS, SLOW_INGEST_SECONDS = 5.0, 2.0
CLIENT_LIMIT, CLIENT_WINDOW_SECONDS = 100, 60
SINGLE_PER_SECOND, BATCH_PER_SECOND = 1000, 100
TOKEN_RATE, TOKEN_BURST = 100, 200
_SPAN_SECONDS = 3600


def counter_delta(ticks: DataFrame, instance: str = "instance_id", tick: str = "tick",
                  total: str = "total", out: str = "rate") -> DataFrame:
    """Growth of a cumulative counter from tick to tick; the first tick counts from 0."""
    first, n = unused("_first", ticks), unused("_n", ticks)
    lagged = over_last_rows(
        ticks, [instance], [tick], 2,
        {first: lambda w: F.first(total).over(w), n: lambda w: F.count(F.lit(1)).over(w)})
    previous = F.when(F.col(n) == 1, F.lit(0)).otherwise(F.col(first))
    return lagged.withColumn(out, F.col(total) - previous).drop(first, n)


def bad_call_rate(calls: DataFrame, bad: Column, instance: str = "instance", order: list[str] | None = None,
                  window: int = CALLS, min_calls: int = MIN_CALLS, threshold: float = RATE_THRESHOLD,
                  block_rows: int = BLOCK_ROWS) -> DataFrame:
    """Share of bad calls among the last ``window`` calls of an instance, judged from ``min_calls`` on."""
    flag = unused("_bad", calls)
    marked = calls.withColumn(flag, F.when(bad, 1).otherwise(0))
    framed = over_last_rows(
        marked, [instance], order or ["timestamp", "id"], window,
        {"calls": lambda w: F.count(F.lit(1)).over(w), "bad_calls": lambda w: F.sum(flag).over(w)},
        block_rows)
    rate = F.col("bad_calls") / F.col("calls")
    return framed.drop(flag).withColumns({
        "rate": rate, "tripped": (F.col("calls") >= min_calls) & (rate >= threshold)})


def failure_rate(calls: DataFrame, failed: str = "failed", **settings) -> DataFrame:
    return bad_call_rate(calls, F.col(failed), **settings)


def slow_call_rate(calls: DataFrame, limit: float = SLOW_QUERY_SECONDS, duration: str = "duration",
                   **settings) -> DataFrame:
    return bad_call_rate(calls, F.col(duration) > limit, **settings)


def fixed_window_report(requests: DataFrame, client: str, window_seconds: int = CLIENT_WINDOW_SECONDS,
                        limit: int = CLIENT_LIMIT, ts: str = "timestamp") -> DataFrame:
    """Requests per client and clock-aligned window, with how many fit the limit."""
    counted = requests.groupBy(client, bucket(F.col(ts), window_seconds).alias("_b")).agg(
        F.count(F.lit(1)).alias("requests"))
    return counted.select(
        client, from_epoch_seconds(F.col("_b") * window_seconds).alias("window_start"), "requests",
        F.least("requests", F.lit(limit)).cast("bigint").alias("allowed"),
        F.greatest(F.col("requests") - limit, F.lit(0)).cast("bigint").alias("rejected"))


def fixed_window_admitted(requests: DataFrame, client: str, window_seconds: int = CLIENT_WINDOW_SECONDS,
                          limit: int = CLIENT_LIMIT, ts: str = "timestamp", tie: str = "id") -> DataFrame:
    """The requests that fit: the first ``limit`` of each client and window."""
    return first_of_each(requests, [F.col(client), bucket(F.col(ts), window_seconds)], [ts, tie], limit)


def _trailing_sum(per_second: DataFrame, keys: list[str], second: str, value: str, window_seconds: int,
                  out: str) -> DataFrame:
    """Sum over the last ``window_seconds`` of a series with at most one row per key and second.

    The series is cut into spans; the seconds a later span still looks at are copied
    into it. A group then holds at most span + window seconds, however many events a
    key has. Inside a span each value enters at its second and leaves one window later,
    so the trailing sum is a running total and no frame is summed anew.
    """
    span = max(_SPAN_SECONDS, window_seconds)
    home = F.floor(F.col(second) / span).cast("bigint")
    at_end = F.pmod(F.col(second), F.lit(span)) > span - window_seconds
    spans = per_second.withColumn("_home", home).withColumn(
        "_span", F.explode(F.when(at_end, F.array("_home", F.col("_home") + 1)).otherwise(F.array("_home"))))
    enters = F.struct(F.col(second).alias("_at"), F.col(value).alias("_change"), F.lit(True).alias("_own"))
    leaves = F.struct((F.col(second) + window_seconds).alias("_at"), (-F.col(value)).alias("_change"),
                      F.lit(False).alias("_own"))
    changes = spans.withColumn("_c", F.explode(F.array(enters, leaves))).select("*", "_c.*")
    running = W.partitionBy(*keys, "_span").orderBy("_at").rangeBetween(W.unboundedPreceding, W.currentRow)
    summed = changes.withColumn(out, F.sum("_change").over(running))
    return summed.filter(F.col("_own") & (F.col("_span") == F.col("_home"))).select(*per_second.columns, out)


def sliding_window_report(requests: DataFrame, key: str, window_seconds: int, limit: int,
                          ts: str = "timestamp") -> DataFrame:
    """Requests per key and second, and in the last ``window_seconds`` up to that second.

    All requests of one second share their window, so one row per second says it all.
    """
    per_second = requests.groupBy(key, epoch_seconds(F.col(ts)).alias("_sec")).agg(
        F.count(F.lit(1)).alias("requests"))
    summed = _trailing_sum(per_second, [key], "_sec", "requests", window_seconds, "in_window")
    return summed.select(
        key, from_epoch_seconds(F.col("_sec")).alias("second"), "requests", "in_window",
        (F.col("in_window") > limit).alias("limited"))


def sliding_window_requests(requests: DataFrame, key: str, window_seconds: int, limit: int,
                            ts: str = "timestamp") -> DataFrame:
    """Every request with the number in its window and whether that is over the limit."""
    own, at, second = (unused(name, requests) for name in ("_key", "_at", "_second"))
    report = sliding_window_report(requests, key, window_seconds, limit, ts).select(
        F.col(key).alias(own), F.col("second").alias(second), "in_window", "limited")
    timed = requests.withColumn(at, from_epoch_seconds(epoch_seconds(F.col(ts))))
    joined = timed.join(report, timed[key].eqNullSafe(report[own]) & (timed[at] == report[second]))
    return joined.drop(at, own, second)


def _admit(window_seconds: int, limit: int) -> Callable[[pd.DataFrame], pd.DataFrame]:
    """Admitted requests per second, given those admitted in the window before."""

    def fold(seconds: pd.DataFrame) -> pd.DataFrame:
        ordered = seconds.sort_values("_sec")
        live: deque[tuple[int, int]] = deque()
        in_window, admitted = 0, []
        for second, requests in zip(ordered["_sec"], ordered["requests"], strict=True):
            while live and live[0][0] <= second - window_seconds:
                in_window -= live.popleft()[1]
            fit = min(requests, limit - in_window)
            admitted.append(fit)
            in_window += fit
            live.append((second, fit))
        return ordered.assign(admitted=admitted)

    return fold


def sliding_window_admitted(requests: DataFrame, key: str, window_seconds: int, limit: int,
                            ts: str = "timestamp") -> DataFrame:
    """Requests and admitted requests per key and second, where only admitted ones fill the window.

    What is admitted depends on what was admitted before, so this is a fold in time
    order. It runs on one row per key and second, whatever the number of requests, and
    a pause as long as the window starts a new, independent run.
    """
    per_second = requests.filter(F.col(key).isNotNull() & F.col(ts).isNotNull()).groupBy(
        key, epoch_seconds(F.col(ts)).alias("_sec")).agg(F.count(F.lit(1)).alias("requests"))
    in_order = W.partitionBy(key).orderBy("_sec")
    pause = F.col("_sec") - F.lag("_sec").over(in_order) >= window_seconds
    runs = per_second.withColumn("_run", F.sum(F.when(pause, 1).otherwise(0)).over(in_order))
    schema = T.StructType([*runs.schema.fields, T.StructField("admitted", T.LongType())])
    folded = runs.groupBy(key, "_run").applyInPandas(_admit(window_seconds, limit), schema)
    return folded.select(
        key, from_epoch_seconds(F.col("_sec")).alias("second"), "requests", "admitted",
        (F.col("requests") - F.col("admitted")).alias("rejected"))


def current_rate(requests: DataFrame, key: str, as_of: Moment, window_seconds: int = 60,
                 ts: str = "timestamp") -> DataFrame:
    """Requests per key in the window that ends now, both end seconds counted; idle keys are absent."""
    end = as_datetime(as_of).replace(microsecond=0)
    inside = requests.filter(
        (F.col(ts) >= moment(before(end, seconds=window_seconds))) & (F.col(ts) < moment(before(end, seconds=-1))))
    return inside.groupBy(key).agg(F.count(F.lit(1)).alias("in_window"))


def period_limit_report(requests: DataFrame, limit: int = SINGLE_PER_SECOND, period_seconds: int = 1,
                        ts: str = "timestamp") -> DataFrame:
    """Requests per period and whether they exceed the limit."""
    counted = requests.filter(F.col(ts).isNotNull()).groupBy(
        bucket(F.col(ts), period_seconds).alias("_b")).agg(F.count(F.lit(1)).alias("requests"))
    return counted.select(
        from_epoch_seconds(F.col("_b") * period_seconds).alias("period_start"), "requests",
        (F.col("requests") > limit).alias("limited"))


def token_rate_report(requests: DataFrame, rate: int = TOKEN_RATE, burst: int = TOKEN_BURST,
                      trailing: int = 10, unit_seconds: int = 1, ts: str = "timestamp") -> DataFrame:
    """Time units with more requests than the burst, or a trailing mean above the rate."""
    counted = requests.filter(F.col(ts).isNotNull()).groupBy(
        bucket(F.col(ts), unit_seconds).alias("_unit")).agg(F.count(F.lit(1)).alias("requests"))
    summed = _trailing_sum(counted, [], "_unit", "requests", trailing, "_in_trailing")
    mean = F.col("_in_trailing") / F.lit(float(trailing))
    return summed.select(
        from_epoch_seconds(F.col("_unit") * unit_seconds).alias("unit_start"), "requests",
        mean.alias("trailing_mean"), (F.col("requests") > burst).alias("over_burst"),
        (mean > rate).alias("over_rate"))
