"""Repeats, rate limits and call windows."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import dedup, rolling
from .catalog import query
from .inputs import AS_OF, CALLS_SQL, LOG_EVENTS_SQL, SOURCE_CASE, calls, events, log_events, repeats

HALF_HOUR = "interval 30 minute"


def _chain_sql(source: str, key: str, life: str) -> str:
    """Chain members per key: every time is linked to the first time at least ``life`` later."""
    return f"""times as (select distinct {key} as k, ts from ({source})),
    links as (select k, ts, min(ts) over (partition by k order by ts
      range between {life} following and unbounded following) as nxt from times),
    chain as (
      select k, min(ts) as ts from times group by k
      union all
      select links.k, links.nxt from chain join links on chain.k = links.k and chain.ts = links.ts
        where links.nxt is not null)"""


def _dedup_sql(content: str) -> str:
    return f"""with recursive {_chain_sql(f"select {content} as content, ts from events", "content", HALF_HOUR)},
    ranked as (select event_id as id, ts as "timestamp", {content} as content, row_number() over (
      partition by {content}, ts order by event_id) as rn from events)
    select id, "timestamp", content from ranked join chain on content = k and "timestamp" = ts where rn = 1"""


USER_CONTENT = "concat(event_type, ':', cast(user_id as varchar))"


@query("dedup_ttl", "T1", _dedup_sql(USER_CONTENT))
def dedup_ttl(spark, sf_dir):
    return dedup.drop_repeats(repeats(spark, sf_dir)).drop("content_hash")


@query("dedup_ttl_busy", "T1", _dedup_sql("event_type"))
def dedup_ttl_busy(spark, sf_dir):
    """Five hashes hold all rows: the way that never gathers a hash."""
    return dedup.drop_repeats(repeats(spark, sf_dir, "type")).drop("content_hash")


@query("dedup_seen", "J3 T7", _dedup_sql(USER_CONTENT))
def dedup_seen(spark, sf_dir):
    """The same result in two rounds, the second against what the first one remembered."""
    rows = repeats(spark, sf_dir)
    cut = F.lit("2024-01-15 12:00:00").cast("timestamp_ntz")
    first = dedup.drop_repeats(rows.filter(F.col("timestamp") < cut))
    none = first.limit(0)
    seen = dedup.remember(none, first, "2024-01-15 12:00:00")
    second = dedup.drop_seen(rows.filter(F.col("timestamp") >= cut), seen)
    return first.unionByName(second).drop("content_hash")


@query("collector_stats", "A9 T1", f"""with kept as (select id from (
      {_dedup_sql(USER_CONTENT)}))
    select (select count(*) from events) as processed, (select count(*) from kept) as sent,
      (select count(*) from events) - (select count(*) from kept) as duplicates_skipped""")
def collector_stats(spark, sf_dir):
    rows = repeats(spark, sf_dir)
    kept = dedup.drop_repeats(rows)
    marked = rows.select(F.lit(1).alias("processed"), F.lit(0).alias("sent")).unionByName(
        kept.select(F.lit(0).alias("processed"), F.lit(1).alias("sent")))
    return marked.agg(F.sum("processed").alias("processed"), F.sum("sent").alias("sent")).withColumn(
        "duplicates_skipped", F.col("processed") - F.col("sent"))


@query("fixed_window_limit", "T2", f"""
    with counted as (select {SOURCE_CASE} as source, make_timestamp(cast(floor(epoch(ts) / 3600) as bigint) * 3600000000)
        as window_start, count(*) as requests from events group by 1, 2)
    select *, least(requests, 3) as allowed, greatest(requests - 3, 0) as rejected from counted""")
def fixed_window_limit(spark, sf_dir):
    return rolling.fixed_window_report(log_events(spark, sf_dir), "source", 3600, 3)


@query("fixed_window_admitted", "T2", f"""with {LOG_EVENTS_SQL},
    ranked as (select id, source, "timestamp", row_number() over (partition by source,
      cast(floor(epoch("timestamp") / 3600) as bigint) order by "timestamp", id) as rn from log_events)
    select id, source, "timestamp" from ranked where rn <= 3""")
def fixed_window_admitted(spark, sf_dir):
    return rolling.fixed_window_admitted(
        log_events(spark, sf_dir).select("id", "source", "timestamp"), "source", 3600, 3)


def _anchored_sql(key: str) -> str:
    return f"""with recursive {_chain_sql(f"select {key} as source, ts from events", "source", "interval 3600 second")},
    counted as (select chain.k as source, chain.ts as window_start, count(*) as requests
      from chain join (select {key} as source, ts from events) e
        on e.source = chain.k and e.ts >= chain.ts and e.ts < chain.ts + interval 3600 second group by 1, 2)
    select *, least(requests, 3) as allowed, greatest(requests - 3, 0) as rejected from counted"""


@query("fixed_window_anchored", "T2", _anchored_sql(SOURCE_CASE))
def fixed_window_anchored(spark, sf_dir):
    return dedup.anchored_window_report(log_events(spark, sf_dir), "source", 3600, 3)


@query("fixed_window_anchored_small", "T2", _anchored_sql("cast(user_id as varchar)"))
def fixed_window_anchored_small(spark, sf_dir):
    rows = events(spark, sf_dir).select(F.col("user_id").cast("string").alias("source"), F.col("ts").alias("timestamp"))
    return dedup.anchored_window_report(rows, "source", 3600, 3)


@query("fixed_window_anchored_admitted", "T2", f"""
    with recursive {_chain_sql(f"select {SOURCE_CASE} as source, ts from events", "source", "interval 3600 second")},
    ranked as (select e.event_id as id, e.source, e.ts as "timestamp", chain.ts as window_start,
        row_number() over (partition by e.source, chain.ts order by e.ts, e.event_id) as rn
      from chain join (select event_id, {SOURCE_CASE} as source, ts from events) e
        on e.source = chain.k and e.ts >= chain.ts and e.ts < chain.ts + interval 3600 second)
    select id, source, "timestamp", window_start from ranked where rn <= 3""")
def fixed_window_anchored_admitted(spark, sf_dir):
    rows = log_events(spark, sf_dir).select("id", "source", "timestamp")
    return dedup.anchored_window_admitted(rows, "source", 3600, 3)


_SLIDING_SQL = f"""with per_second as (select {SOURCE_CASE} as source, date_trunc('second', ts) as second,
        count(*) as requests from events group by 1, 2),
    summed as (select *, cast(sum(requests) over (partition by source order by second
        range between interval 3599 second preceding and current row) as bigint) as in_window from per_second)"""


@query("sliding_window_limit", "T3 Q7", f"{_SLIDING_SQL} select *, in_window > 4 as limited from summed")
def sliding_window_limit(spark, sf_dir):
    return rolling.sliding_window_report(log_events(spark, sf_dir), "source", 3600, 4)


@query("sliding_window_requests", "T3 Q7", f"""{_SLIDING_SQL}
    select event_id as id, e.source, ts as "timestamp", in_window, in_window > 4 as limited
    from (select event_id, {SOURCE_CASE} as source, ts from events) e
      join summed s on e.source = s.source and date_trunc('second', ts) = s.second""")
def sliding_window_requests(spark, sf_dir):
    rows = log_events(spark, sf_dir).select("id", "source", "timestamp")
    return rolling.sliding_window_requests(rows, "source", 3600, 4)


@query("sliding_window_admitted", "T3", f"""with recursive
    per_second as (select {SOURCE_CASE} as source, cast(floor(epoch(ts)) as bigint) as sec, count(*) as requests
      from events group by 1, 2),
    numbered as (select *, row_number() over (partition by source order by sec) as i from per_second),
    fold as (
      select source, i, sec, requests, least(requests, 4) as admitted, [{{'s': sec, 'n': least(requests, 4)}}] as live
        from numbered where i = 1
      union all
      select source, i, sec, requests, fit, list_append(kept, {{'s': sec, 'n': fit}}) from (
        select *, least(requests, 4 - coalesce(list_sum(list_transform(kept, lambda x: x.n)), 0))::bigint as fit from (
          select n.source, n.i, n.sec, n.requests, list_filter(f.live, lambda x: x.s > n.sec - 3600) as kept
          from fold f join numbered n on n.source = f.source and n.i = f.i + 1)))
    select source, make_timestamp(sec * 1000000) as second, requests, admitted, requests - admitted as rejected
    from fold""")
def sliding_window_admitted(spark, sf_dir):
    return rolling.sliding_window_admitted(log_events(spark, sf_dir), "source", 3600, 4)


@query("current_rate", "T3", f"""
    select {SOURCE_CASE} as source, count(*) as in_window from events
    where ts >= timestamp '{AS_OF}' - interval 7200 second and ts < timestamp '{AS_OF}' + interval 1 second group by 1""")
def current_rate(spark, sf_dir):
    return rolling.current_rate(log_events(spark, sf_dir), "source", AS_OF, 7200)


@query("period_limit", "T4 E6", """
    with counted as (select make_timestamp(cast(floor(epoch(ts) / 600) as bigint) * 600000000) as period_start,
      count(*) as requests from events group by 1)
    select *, requests > 3 as limited from counted""")
def period_limit(spark, sf_dir):
    return rolling.period_limit_report(log_events(spark, sf_dir), 3, 600)


@query("token_rate", "T5", """
    with counted as (select cast(floor(epoch(ts) / 600) as bigint) as unit, count(*) as requests from events group by 1),
    summed as (select *, sum(requests) over (order by unit range between 5 preceding and current row) as s from counted)
    select make_timestamp(unit * 600000000) as unit_start, requests, cast(s as double) / 6.0::double as trailing_mean,
      requests > 4 as over_burst, cast(s as double) / 6.0::double > 2 as over_rate from summed""")
def token_rate(spark, sf_dir):
    return rolling.token_rate_report(log_events(spark, sf_dir), rate=2, burst=4, trailing=6, unit_seconds=600)


def _bad_calls_sql(bad: str) -> str:
    return f"""with {CALLS_SQL},
    framed as (select id, "timestamp", instance, failed, duration,
      count(*) over w as calls, cast(sum(case when {bad} then 1 else 0 end) over w as bigint) as bad_calls from calls
      window w as (partition by instance order by "timestamp", id rows between 9 preceding and current row))
    select *, bad_calls / cast(calls as double) as rate, calls >= 5 and bad_calls / cast(calls as double) >= 0.5 as tripped
    from framed"""


@query("failure_rate_window", "W4", _bad_calls_sql("failed"))
def failure_rate_window(spark, sf_dir):
    return rolling.failure_rate(calls(spark, sf_dir))


@query("slow_call_window", "W5", _bad_calls_sql("duration > 5.0"))
def slow_call_window(spark, sf_dir):
    """Cut into short blocks, so that frames cross many block ends."""
    return rolling.slow_call_rate(calls(spark, sf_dir), block_rows=64)


@query("breaker_trips", "W4 A9", f"""with f as ({_bad_calls_sql("failed")})
    select instance, count(*) filter (where tripped) as tripped_calls, count(*) as calls from f group by 1""")
def breaker_trips(spark, sf_dir):
    judged = rolling.failure_rate(calls(spark, sf_dir)).drop("calls")
    return judged.groupBy("instance").agg(F.count_if("tripped").alias("tripped_calls"), F.count(F.lit(1)).alias("calls"))
