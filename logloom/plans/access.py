"""Access logs: parsing, dead letters, request statistics."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import paging, parse, sketches, stats
from ..operators.filters import recent_by_ip, select_events
from ..sinks.letters import letter_documents
from .catalog import query
from .inputs import ACCESS_LOGS_SQL, AS_OF, access_lines, parsed_lines

_SCALARS = [
    "event_id", "timestamp", "ip_address", "http_method", "request_path", "status_code", "response_size",
    "user_agent", "referer", "response_time", "log_format",
]
_SELECT = ", ".join(f'"{name}"' for name in _SCALARS)
GOOD_SQL = f"with {ACCESS_LOGS_SQL}, good as (select * from access_logs where log_format <> 'failed')"


def good(spark, sf_dir):
    return parse.parsed_only(parsed_lines(spark, sf_dir)).select(*_SCALARS)


def _window_sql(width: int, ts: str = '"timestamp"') -> str:
    return f"make_timestamp(cast(floor(epoch({ts}) / {width}) as bigint) * {width * 1_000_000})"


@query("status_code_counts", "L1-L7 F19 A4 P12", f"""{GOOD_SQL}
    select status_code, count(*) as count from good group by 1""")
def status_code_counts(spark, sf_dir):
    return stats.status_counts(good(spark, sf_dir))


@query("parse_access_logs", "L1-L7 E1 E15", f"with {ACCESS_LOGS_SQL} select {_SELECT} from access_logs")
def parse_access_logs(spark, sf_dir):
    return parsed_lines(spark, sf_dir).select(*_SCALARS)


@query("parse_metadata", "P9 P10", f"""with {ACCESS_LOGS_SQL}
    select event_id, log_format,
      case when log_format <> 'failed' then timestamp '{AS_OF}' end as parsed_at,
      case when log_format <> 'failed' then '1.0' end as parser_version,
      case when log_format = 'nginx' then true end as has_user_agent,
      case when log_format = 'nginx' then false end as has_referer,
      case when log_format = 'failed' then 'Unknown format' end as parse_failure_reason,
      case when log_format = 'failed' then timestamp '{AS_OF}' end as failed_at,
      false as timestamp_defaulted
    from access_logs""")
def parse_metadata(spark, sf_dir):
    return parsed_lines(spark, sf_dir).select("event_id", "log_format", "metadata.*", "timestamp_defaulted")


@query("parse_dlq", "K13 F19", f"""
    select concat('corrupted line ', cast(event_id as varchar)) as raw_log, 'Unknown format' as failure_reason,
      timestamp '{AS_OF}' as "timestamp"
    from events where event_id % 50 = 0""")
def parse_dlq(spark, sf_dir):
    return parse.dead_letters(parsed_lines(spark, sf_dir))


@query("dead_letter_documents", "K13 Q12 E12", f"""
    select concat('{{"raw_log":"corrupted line ', cast(event_id as varchar),
      '","failure_reason":"Unknown format","timestamp":"{AS_OF.replace(" ", "T")}"}}') as value
    from events where event_id % 50 = 0""")
def dead_letter_documents(spark, sf_dir):
    return letter_documents(parse.dead_letters(parsed_lines(spark, sf_dir))).select("value")


@query("hourly_counts", "A5 O5 E4 E5", f"""{GOOD_SQL}
    select cast(hour("timestamp") as integer) as hour, count(*) as count from good
    where "timestamp" >= timestamp '{AS_OF}' - interval 24 hour group by 1""")
def hourly_counts(spark, sf_dir):
    return stats.hourly_counts(good(spark, sf_dir), AS_OF)


@query("hourly_counts_by_date", "A5 Q10", f"""{GOOD_SQL}
    select date_trunc('hour', "timestamp") as hour, count(*) as count from good
    where "timestamp" >= timestamp '{AS_OF}' - interval 24 hour group by 1""")
def hourly_counts_by_date(spark, sf_dir):
    return stats.hourly_counts(good(spark, sf_dir), AS_OF, by_date=True)


@query("format_counts", "A7", f"with {ACCESS_LOGS_SQL} select log_format, count(*) as count from access_logs group by 1")
def format_counts(spark, sf_dir):
    return stats.format_counts(parsed_lines(spark, sf_dir))


@query("parse_success_rate", "A8", f"""with {ACCESS_LOGS_SQL},
    counted as (select {_window_sql(300)} as window_start,
      count(*) filter (where log_format <> 'failed') as parsed,
      count(*) filter (where log_format = 'failed') as failed from access_logs group by 1)
    select *, 100.0::double * parsed / nullif(parsed + failed, 0) as success_percent from counted""")
def parse_success_rate(spark, sf_dir):
    return stats.parse_success_rate(parsed_lines(spark, sf_dir))


@query("parse_pipeline_stats", "A9 A7", f"""with {ACCESS_LOGS_SQL}
    select count(*) as received, count(*) filter (where log_format <> 'failed') as processed,
      count(*) filter (where log_format = 'failed') as sent_to_dlq from access_logs""")
def parse_pipeline_stats(spark, sf_dir):
    return stats.parse_pipeline_stats(parsed_lines(spark, sf_dir))


@query("latency_stats", "A12", f"""{GOOD_SQL}
    select request_path, count(response_time) as calls,
      cast(sum(cast(response_time as decimal(24,6))) as double) as total_time, max(response_time) as max_time,
      cast(sum(cast(response_time as decimal(24,6))) as double) / nullif(count(response_time), 0) as mean_time
    from good group by 1""")
def latency_stats(spark, sf_dir):
    return stats.duration_stats(good(spark, sf_dir), "response_time", ["request_path"])


@query("latency_percentiles", "A11", f"""{GOOD_SQL}
    select {_window_sql(3600)} as window_start, count(*) as calls,
      round(quantile_cont(response_time, 0.5), 6) as p50, round(quantile_cont(response_time, 0.95), 6) as p95
    from good where response_time is not null group by 1""")
def latency_percentiles(spark, sf_dir):
    found = stats.latency_percentiles(good(spark, sf_dir), width_seconds=3600)
    return found.withColumns({p: F.round(p, 6) for p in ("p50", "p95")})


_BOUNDS = [0.1, 0.25, 0.5, 1.0, 2.5]


def _quantile_sql(q: float) -> str:
    branches = []
    for i, bound in enumerate(_BOUNDS):
        low, below = (_BOUNDS[i - 1], f"le{i - 1}") if i else (0.0, "0")
        branches.append(
            f"when le{i} >= {q}::double * calls then coalesce({low}::double + {bound}::double * 0 + "
            f"({bound}::double - {low}::double) * ({q}::double * calls - {below}) / nullif(le{i} - {below}, 0), {bound})")
    return f"round(case {' '.join(branches)} else {_BOUNDS[-1]}::double end, 6)"


@query("latency_rollup", "A11 A12", f"""{GOOD_SQL}
    select date_trunc('day', "timestamp") as window_start, count(*) as calls, true as p50_close, true as p95_close
    from good where response_time is not null group by 1""")
def latency_rollup(spark, sf_dir):
    """Sketches of five minutes merged into hours and those into days: the rank of each percentile is within a hundredth of the exact one."""
    rows = good(spark, sf_dir)
    hours = sketches.rolled_up(sketches.latency_sketches(rows), 3600)
    days = sketches.sketch_percentiles(sketches.rolled_up(hours, 86_400))
    measured = rows.filter(F.col("response_time").isNotNull()).select(F.date_trunc("day", "timestamp").cast("timestamp_ntz").alias("window_start"), "response_time")
    joined = measured.join(days, "window_start").groupBy("window_start", "calls")
    shares = {name: (F.count_if(F.col("response_time") < F.col(name)) / F.count("*"), F.count_if(F.col("response_time") <= F.col(name)) / F.count("*"))
              for name in ("p50", "p95")}
    return joined.agg(*[((below <= share + 0.01) & (upto >= share - 0.01)).alias(f"{name}_close")
                        for (name, (below, upto)), share in zip(shares.items(), (0.5, 0.95), strict=True)])


@query("latency_histogram_quantiles", "A11", f"""{GOOD_SQL},
    counted as (select {_window_sql(86400)} as window_start, count(*) as calls,
      {", ".join(f"count(*) filter (where response_time <= {b}) as le{i}" for i, b in enumerate(_BOUNDS))}
      from good where response_time is not null group by 1)
    select window_start, calls, {_quantile_sql(0.5)} as p50, {_quantile_sql(0.95)} as p95 from counted""")
def latency_histogram_quantiles(spark, sf_dir):
    found = stats.histogram_quantiles(good(spark, sf_dir), _BOUNDS, width_seconds=86400)
    return found.withColumns({p: F.round(p, 6) for p in ("p50", "p95")})


@query("ip_recent", "F9", f"""{GOOD_SQL}
    select {_SELECT} from good
    where ip_address = '10.0.3.7' and "timestamp" >= timestamp '2024-01-15 00:00:00'""")
def ip_recent(spark, sf_dir):
    return recent_by_ip(good(spark, sf_dir), "10.0.3.7", "2024-01-15")


@query("ip_status_filter", "F10", f"""{GOOD_SQL}
    select {_SELECT} from good where ip_address = '10.0.1.25' and status_code = 404""")
def ip_status_filter(spark, sf_dir):
    return select_events(good(spark, sf_dir), ip_address="10.0.1.25", status_code=404)


@query("access_page", "O1 O2 S10", f"""{GOOD_SQL}
    select {_SELECT} from good order by response_size asc nulls first, event_id limit 20 offset 20""")
def access_page(spark, sf_dir):
    return paging.page_of(good(spark, sf_dir), 1, paging.ACCESS_PAGE_SIZE, "response_size", "asc", "event_id")


@query("ip_page", "O3 F10", f"""{GOOD_SQL}
    select {_SELECT} from good where ip_address = '10.0.2.42' order by "timestamp" desc, event_id limit 20""")
def ip_page(spark, sf_dir):
    return paging.access_by_ip(good(spark, sf_dir), "10.0.2.42", tie="event_id")


@query("status_page", "O3 F10", f"""{GOOD_SQL}
    select {_SELECT} from good where status_code = 500 order by "timestamp" desc, event_id limit 20 offset 40""")
def status_page(spark, sf_dir):
    return paging.access_by_status(good(spark, sf_dir), 500, page=2, tie="event_id")


@query("line_fan_in", "U1 P12", f"""with {ACCESS_LOGS_SQL}
    select case when event_id % 2 = 0 then 'even' else 'odd' end as feed, log_format, count(*) as count
    from access_logs group by 1, 2""")
def line_fan_in(spark, sf_dir):
    lines = access_lines(spark, sf_dir)
    even = lines.filter(F.col("event_id") % 2 == 0).withColumn("feed", F.lit("even"))
    odd = lines.filter(F.col("event_id") % 2 == 1).withColumn("feed", F.lit("odd"))
    parsed = parse.parse_access_lines(parse.fan_in(even, odd), AS_OF, keep=["feed"])
    return stats.count_by(parsed, "feed", "log_format")
