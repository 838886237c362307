"""Log events: filters, pages, search, statistics, JSON decoding, metadata, joins."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.json_codec import encode
from ..functions.text import content_hash, string_hash32
from ..operators import enrich, filters, joins, paging, rolling, stats
from ..operators.parse import parsed_only
from ..schema import ACCESS_LOG, ORG_EVENT_WIRE, TRACED_EVENT_WIRE
from ..sources import ingest, topics
from .catalog import query
from .inputs import (ACCESS_LOGS_SQL, AS_OF, LOG_EVENTS_SQL, SOURCE_CASE, events, log_events, parsed_lines, table,
                     with_metadata)

_COLUMNS = ["id", "organization_id", "level", "source", "message", "timestamp", "trace_id"]
_SELECT = ", ".join(f'"{name}"' for name in _COLUMNS)
FROM, TO = "2024-01-10 00:00:00", "2024-01-20 12:00:00"


def _sql(where: str) -> str:
    return f"with {LOG_EVENTS_SQL} select {_SELECT} from log_events {where}"


@query("filter_level", "F1", _sql("where level = 'ERROR'"))
def filter_level(spark, sf_dir):
    return filters.by_level(log_events(spark, sf_dir), "ERROR")


@query("filter_source", "F2", _sql("where source = 'auth-service'"))
def filter_source(spark, sf_dir):
    return filters.by_source(log_events(spark, sf_dir), "auth-service")


@query("filter_level_source", "F3", _sql("where level = 'WARN' and source = 'payment-service'"))
def filter_level_source(spark, sf_dir):
    return filters.by_level_and_source(log_events(spark, sf_dir), "WARN", "payment-service")


@query("filter_between", "F4", _sql(f"where \"timestamp\" between timestamp '{FROM}' and timestamp '{TO}'"))
def filter_between(spark, sf_dir):
    return filters.between(log_events(spark, sf_dir), FROM, TO)


@query("filter_level_source_between", "F5", _sql(
    f"where level = 'INFO' and source = 'user-service' and \"timestamp\" between timestamp '{FROM}' and timestamp '{TO}'"))
def filter_level_source_between(spark, sf_dir):
    return filters.select_events(
        log_events(spark, sf_dir), level="INFO", source="user-service", start=FROM, end=TO)


@query("filter_org_between", "F6", _sql(
    f"where organization_id = 'org-3' and \"timestamp\" between timestamp '{FROM}' and timestamp '{TO}'"))
def filter_org_between(spark, sf_dir):
    return filters.by_organization_between(log_events(spark, sf_dir), "org-3", FROM, TO)


@query("filter_level_after", "F7", _sql(f"where level = 'DEBUG' and \"timestamp\" > timestamp '{TO}'"))
def filter_level_after(spark, sf_dir):
    return filters.by_level_after(log_events(spark, sf_dir), "DEBUG", TO)


@query("filter_source_after", "F8", _sql(f"where source = 'notification-service' and \"timestamp\" > timestamp '{TO}'"))
def filter_source_after(spark, sf_dir):
    return filters.by_source_after(log_events(spark, sf_dir), "notification-service", TO)


@query("search_keyword", "F11", _sql("where contains(upper(message), upper('Purchase BY user_1'))"))
def search_keyword(spark, sf_dir):
    return filters.search(log_events(spark, sf_dir), "Purchase BY user_1")


@query("search_like_after", "F12", _sql(f"where message like '%k by user_4%' and \"timestamp\" > timestamp '{TO}'"))
def search_like_after(spark, sf_dir):
    return filters.like_after(log_events(spark, sf_dir), "k by user_4", TO)


@query("trace_lookup", "F13 Q17", f"""with {LOG_EVENTS_SQL},
    copies as (select *, row_number() over (partition by trace_id order by "timestamp" desc, id desc) as rn,
      count(*) over (partition by trace_id) as copies from log_events)
    select {_SELECT}, copies from copies where rn = 1 and trace_id = md5('t42')""")
def trace_lookup(spark, sf_dir):
    trace = F.md5(F.lit("t42"))
    return joins.newest_with_copies(log_events(spark, sf_dir).filter(F.col("trace_id") == trace)).select(
        *_COLUMNS, "copies")


@query("cold_eligible", "F14", _sql(
    f"where level in ('ERROR', 'WARN') or \"timestamp\" < timestamp '{AS_OF}' - interval 7 day"))
def cold_eligible(spark, sf_dir):
    return filters.cold_eligible(log_events(spark, sf_dir), AS_OF)


@query("query_logs", "F15 Q5", _sql(
    f"where level = 'ERROR' and contains(upper(message), 'USER_7') and \"timestamp\" <= timestamp '{TO}'"))
def query_logs(spark, sf_dir):
    return filters.select_events(log_events(spark, sf_dir), level="ERROR", keyword="user_7", end=TO)


@query("query_logs_all", "F15 S10", _sql(""))
def query_logs_all(spark, sf_dir):
    return filters.select_events(log_events(spark, sf_dir))


@query("query_logs_page", "F15 O1 O2", _sql(
    f"where level = 'ERROR' and \"timestamp\" between timestamp '{FROM}' and timestamp '{TO}' "
    "order by \"timestamp\" desc, id limit 50 offset 100"))
def query_logs_page(spark, sf_dir):
    return paging.query_events(log_events(spark, sf_dir), 2, level="ERROR", start=FROM, end=TO).content


@query("query_logs_total", "A6", f"""with {LOG_EVENTS_SQL} select count(*) as total from log_events
    where level = 'ERROR' and "timestamp" between timestamp '{FROM}' and timestamp '{TO}'""")
def query_logs_total(spark, sf_dir):
    return paging.query_events(log_events(spark, sf_dir), 2, level="ERROR", start=FROM, end=TO).total


@query("query_logs_sorted", "O1 O2 Q15", _sql("order by source asc, id limit 50 offset 50"))
def query_logs_sorted(spark, sf_dir):
    return paging.query_events(log_events(spark, sf_dir), 1, 50, "source", "asc").content


@query("query_logs_page_after", "O2", _sql(
    f"where \"timestamp\" <= timestamp '{TO}' order by \"timestamp\" desc, id limit 50"))
def query_logs_page_after(spark, sf_dir):
    return paging.page_after(log_events(spark, sf_dir), (TO, -1))


@query("search_logs", "O4 F11", _sql(
    "where contains(upper(message), 'SIGNUP') order by \"timestamp\" desc, id limit 100"))
def search_logs(spark, sf_dir):
    return paging.search_events(log_events(spark, sf_dir), "signup")


@query("error_alerts", "F16 P4", f"""with {LOG_EVENTS_SQL}
    select {_SELECT}, timestamp '{AS_OF}' as processed_at from log_events where level = 'ERROR'""")
def error_alerts(spark, sf_dir):
    return enrich.stamp(filters.error_events(log_events(spark, sf_dir)), AS_OF)


@query("org_level_counts", "A1", f"""with {LOG_EVENTS_SQL}
    select organization_id, level, count(*) as count from log_events group by 1, 2""")
def org_level_counts(spark, sf_dir):
    return stats.organization_level_counts(log_events(spark, sf_dir))


@query("org_level_count", "A1", f"""with {LOG_EVENTS_SQL}
    select count(*) as total from log_events where organization_id = 'org-2' and level = 'WARN'""")
def org_level_count(spark, sf_dir):
    return paging.total_of(filters.select_events(log_events(spark, sf_dir), organization_id="org-2", level="WARN"))


@query("level_counts_after", "A2", f"""with {LOG_EVENTS_SQL}
    select level, count(*) as count from log_events where "timestamp" > timestamp '{TO}' group by 1""")
def level_counts_after(spark, sf_dir):
    return stats.level_counts_after(log_events(spark, sf_dir), TO)


@query("level_stats", "A3 Q14", f"""with {LOG_EVENTS_SQL},
    recent as (select * from log_events where "timestamp" > timestamp '{AS_OF}' - interval 24 hour)
    select count(*) filter (where level = 'ERROR') as error_count, count(*) filter (where level = 'WARN') as warn_count,
      count(*) filter (where level = 'INFO') as info_count, count(*) filter (where level = 'DEBUG') as debug_count,
      count(*) as all_levels, count(*) filter (where level in ('ERROR', 'WARN', 'INFO', 'DEBUG')) as total_logs,
      timestamp '{AS_OF}' - interval 24 hour as since, timestamp '{AS_OF}' as generated_at from recent""")
def level_stats(spark, sf_dir):
    return stats.level_stats(log_events(spark, sf_dir), AS_OF)


def _window_sql(width: int) -> str:
    return f"make_timestamp(cast(floor(epoch(ts) / {width}) as bigint) * {width * 1_000_000})"


@query("event_rate", "A10", f"""
    select {_window_sql(300)} as window_start, count(*) as events, count(*) / 300.0::double as per_second
    from events group by 1""")
def event_rate(spark, sf_dir):
    return stats.event_rate(events(spark, sf_dir), ts="ts")


@query("event_rate_sliding", "A10", f"""
    with copied as (select make_timestamp((cast(floor(epoch(ts) / 60) as bigint) - back) * 60000000) as window_start
      from events, range(5) as r(back))
    select window_start, count(*) as events, count(*) / 300.0::double as per_second from copied group by 1""")
def event_rate_sliding(spark, sf_dir):
    return stats.sliding_event_rate(events(spark, sf_dir), ts="ts")


@query("ingest_outcomes", "A13", """
    select cast(sum(1 + event_id % 3) as bigint) as received,
      cast(sum(1 + event_id % 3) filter (where event_type = 'error') as bigint) as rejected,
      cast(sum(1 + event_id % 3) filter (where event_type <> 'error') as bigint) as processed from events""")
def ingest_outcomes(spark, sf_dir):
    batches = events(spark, sf_dir).withColumn("size", 1 + F.col("event_id") % 3)
    bad = F.col("event_type") == "error"
    return stats.outcome_counts(batches, {"received": F.lit(True), "rejected": bad, "processed": ~bad}, "size")


@query("query_time_stats", "A12", f"""with {LOG_EVENTS_SQL}
    select source, count(value) as calls, cast(sum(cast(value as decimal(24,6))) as double) as total_time,
      max(value) as max_time,
      cast(sum(cast(value as decimal(24,6))) as double) / nullif(count(value), 0) as mean_time
    from log_events group by 1""")
def query_time_stats(spark, sf_dir):
    return stats.duration_stats(log_events(spark, sf_dir, "value"), "value", ["source"])


def _wire_events(spark, sf_dir):
    """Events as a producer sends them; one in forty is cut off in the middle."""
    rows = log_events(spark, sf_dir)
    text = encode(
        F.col("id").cast("string").alias("id"), F.col("organization_id").alias("organizationId"), "level",
        "message", "source", "timestamp", F.lit("x").alias("unknown"))
    cut = F.when(F.col("id") % 40 == 0, F.substring(text, 1, 30)).otherwise(text)
    return rows.select(F.col("id").alias("sent_id"), cut.alias("value"))


@query("decode_json", "S1 S3 S4 S12 E12", f"""with {LOG_EVENTS_SQL}
    select id as sent_id, cast(id as varchar) as id, organization_id as "organizationId", level, message, source,
      date_trunc('second', "timestamp") as "timestamp" from log_events where id % 40 <> 0""")
def decode_json(spark, sf_dir):
    decoded = ingest.decode_events(_wire_events(spark, sf_dir), ORG_EVENT_WIRE, keep=["sent_id"])
    return ingest.split_decoded(decoded, AS_OF).events


@query("decode_json_dead", "S4 K14", f"""
    select substr(concat('{{"id":"', cast(event_id as varchar), '","organizationId":"org-', cast(user_id % 5 as varchar)),
      1, 30) as raw_log, 'Invalid JSON' as failure_reason, timestamp '{AS_OF}' as "timestamp"
    from events where event_id % 40 = 0""")
def decode_json_dead(spark, sf_dir):
    decoded = ingest.decode_events(_wire_events(spark, sf_dir), ORG_EVENT_WIRE, keep=["sent_id"])
    return ingest.split_decoded(decoded, AS_OF).dead


@query("decode_json_fields", "S5 Q4 E2 E7", f"""with {ACCESS_LOGS_SQL}
    select event_id,
      case when event_id % 11 = 0 then timestamp '{AS_OF}' else "timestamp" end as "timestamp",
      ip_address, http_method, request_path, case when event_id % 13 <> 0 then status_code end as status_code,
      response_size, user_agent, referer, response_time, log_format
    from access_logs""")
def decode_json_fields(spark, sf_dir):
    parsed = parsed_lines(spark, sf_dir)
    broken = F.when(F.col("event_id") % 11 == 0, "yesterday").otherwise(
        F.date_format("timestamp", "yyyy-MM-dd HH:mm:ss"))
    status = F.when(F.col("event_id") % 13 == 0, "teapot").otherwise(F.col("status_code").cast("string"))
    others = [c for c in ACCESS_LOG.fieldNames() if c not in ("timestamp", "status_code", "raw_log")]
    records = parsed.select(
        "event_id", encode(broken.alias("timestamp"), status.alias("status_code"), *others).alias("value"))
    return ingest.decode_access_logs(records, AS_OF, keep=["event_id"]).drop("raw_log")


@query("ingest_defaults", "S11 P1 P2 P3 P4", f"""
    select event_id,
      case when event_id % 4 <> 0 then cast(event_id as varchar)
        else sha256(concat(cast(event_id as varchar), chr(31), event_type)) end as id,
      case when event_id % 3 <> 0 then md5(concat('t', cast(event_id as varchar)))
        else sha256(concat(cast(event_id as varchar), chr(31), event_type)) end as trace_id,
      case when event_id % 5 <> 0 then ts else timestamp '{AS_OF}' end as "timestamp",
      timestamp '{AS_OF}' as processed_at from events""")
def ingest_defaults(spark, sf_dir):
    n = F.col("event_id")
    rows = events(spark, sf_dir).select(
        "event_id", "event_type", F.when(n % 4 != 0, n.cast("string")).alias("id"),
        F.when(n % 3 != 0, F.md5(F.concat(F.lit("t"), n.cast("string")))).alias("trace_id"),
        F.when(n % 5 != 0, F.col("ts")).alias("timestamp"))
    ready = enrich.prepare_events(rows, AS_OF, id_from=["event_id", "event_type"])
    return enrich.stamp(ready, AS_OF).drop("event_type")


@query("random_ids", "P1 P2 E11", f"""with {LOG_EVENTS_SQL}
    select level, count(*) as rows, count(*) as ids, count(*) as traces, count(*) as well_formed from log_events group by level""")
def random_ids(spark, sf_dir):
    """The ids are random; that they are all there, different and of the right form is not."""
    rows = log_events(spark, sf_dir).select(F.lit(None).cast("string").alias("id"), "level")
    form = r"^[0-9a-f]{8}-[0-9a-f]{4}-4[0-9a-f]{3}-[89ab][0-9a-f]{3}-[0-9a-f]{12}$"
    return enrich.fill_trace_id(enrich.fill_id(rows)).groupBy("level").agg(
        F.count("*").alias("rows"), F.countDistinct("id").alias("ids"), F.countDistinct("trace_id").alias("traces"),
        F.count_if(F.col("id").rlike(form) & F.col("trace_id").rlike(form)).alias("well_formed"))


@query("decode_traced", "S3 S12 Q9 E13", f"""with {LOG_EVENTS_SQL}
    select date_trunc('second', "timestamp") as "timestamp", level, source, message, trace_id,
      cast(user_id as varchar) as user_id, json_extract_string(props, '$.k') as k from log_events""")
def decode_traced(spark, sf_dir):
    rows = with_metadata(spark, sf_dir)
    sent = rows.select(encode("timestamp", "level", "source", "message", "metadata", "trace_id").alias("value"))
    decoded = ingest.split_decoded(ingest.decode_events(sent, TRACED_EVENT_WIRE), AS_OF).events
    return decoded.select(
        "timestamp", "level", "source", "message", "trace_id",
        F.try_element_at("metadata", F.lit("user_id")).alias("user_id"),
        F.coalesce(F.try_element_at("metadata", F.lit("k")), F.lit("none")).alias("k"))


@query("metadata_explode", "K9", """
    select event_id as log_event_id, 'user_id' as key, cast(user_id as varchar) as value from events
    union all select event_id, 'k', json_extract_string(props, '$.k') from events""")
def metadata_explode(spark, sf_dir):
    return joins.explode_metadata(with_metadata(spark, sf_dir))


@query("metadata_assemble", "J1", f"""with {LOG_EVENTS_SQL}
    select id, level, case when id % 10 <> 0 then cast(user_id as varchar) end as user_id,
      case when id % 10 <> 0 then json_extract_string(props, '$.k') end as k from log_events""")
def metadata_assemble(spark, sf_dir):
    rows = with_metadata(spark, sf_dir)
    some = rows.withColumn("metadata", F.when(F.col("id") % 10 != 0, F.col("metadata")))  # one in ten has none
    children = joins.explode_metadata(some)
    whole = joins.assemble_metadata(rows.select("id", "level"), children)
    return whole.select("id", "level", F.try_element_at("metadata", F.lit("user_id")).alias("user_id"),
                        F.try_element_at("metadata", F.lit("k")).alias("k"))


@query("cascade_delete", "K18", f"""
    select event_id as log_event_id, 'user_id' as key, cast(user_id as varchar) as value from events
      where ts >= timestamp '{AS_OF}' - interval 10 day
    union all select event_id, 'k', json_extract_string(props, '$.k') from events
      where ts >= timestamp '{AS_OF}' - interval 10 day""")
def cascade_delete(spark, sf_dir):
    rows = with_metadata(spark, sf_dir)
    kept = filters.select_events(rows, start="2024-01-20 00:00:00")
    return joins.cascade(joins.explode_metadata(rows), kept)


@query("geo_enrich", "J4 T7", f"""
    with written as (
      select concat('10.0.', cast(user_id % 4 as varchar), '.', cast(user_id % 250 as varchar)) as ip_address,
        ts as cached_at, n_name as location
      from events join nation on n_nationkey = event_id % 25 where event_type = 'signup'),
    live as (select ip_address, location, row_number() over (partition by ip_address
        order by cached_at desc, location desc) as rn
      from written where cached_at > timestamp '{AS_OF}' - interval 7 day),
    {ACCESS_LOGS_SQL}
    select a.event_id, a.ip_address, l.location from access_logs a
      left join live l on a.ip_address = l.ip_address and l.rn = 1
      where a.log_format <> 'failed'""")
def geo_enrich(spark, sf_dir):
    nations = table(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("_n"), "n_name")
    address = F.concat(F.lit("10.0."), (F.col("user_id") % 4).cast("string"), F.lit("."),
                       (F.col("user_id") % 250).cast("string"))
    written = events(spark, sf_dir).filter(F.col("event_type") == "signup").select(
        address.alias("ip_address"), F.col("ts").alias("cached_at"), (F.col("event_id") % 25).alias("_n")
    ).join(nations, "_n").withColumnRenamed("n_name", "location")
    logs = parsed_only(parsed_lines(spark, sf_dir)).select("event_id", "ip_address")
    return joins.add_location(logs, joins.live_locations(written, AS_OF)).select("event_id", "ip_address", "location")


@query("geo_as_of", "J4", f"""
    with written as (
      select concat('10.0.', cast(user_id % 4 as varchar), '.', cast(user_id % 250 as varchar)) as ip_address,
        ts + (event_id % 9) * interval 1 hour as cached_at, max(n_name) as location
      from events join nation on n_nationkey = event_id % 25 group by 1, 2),
    {ACCESS_LOGS_SQL}
    select a.event_id, a.ip_address, a."timestamp", case when w.cached_at >= a."timestamp" - interval 7 day then w.location end as location
    from access_logs a asof left join written w on a.ip_address = w.ip_address and a."timestamp" >= w.cached_at
    where a.log_format <> 'failed'""")
def geo_as_of(spark, sf_dir):
    """Each line with the location last known when it was written; every event writes one, up to eight hours later."""
    nations = table(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("_n"), F.col("n_name").alias("location"))
    address = F.concat(F.lit("10.0."), (F.col("user_id") % 4).cast("string"), F.lit("."), (F.col("user_id") % 250).cast("string"))
    later = F.make_dt_interval(F.lit(0), (F.col("event_id") % 9).cast("int"))
    written = events(spark, sf_dir).select(
        address.alias("ip_address"), (F.col("ts") + later).alias("cached_at"), (F.col("event_id") % 25).alias("_n")).join(nations, "_n")
    logs = parsed_only(parsed_lines(spark, sf_dir)).select("event_id", "ip_address", "timestamp")
    return joins.location_as_of(logs, written, tie="event_id")


@query("hot_warm_lookup", "J2 U2 F13", f"""with {LOG_EVENTS_SQL},
    wanted as (select distinct md5(concat('t', cast(event_id * 3 as varchar))) as trace_id from events),
    hot as (select * from log_events where "timestamp" > timestamp '{AS_OF}' - interval 24 hour)
    select {_SELECT}, case when trace_id in (select trace_id from hot) then 'hot' else 'warm' end as tier, 1 as copies
    from log_events where trace_id in (select trace_id from wanted)""")
def hot_warm_lookup(spark, sf_dir):
    warm = log_events(spark, sf_dir)
    keys = events(spark, sf_dir).select(
        F.md5(F.concat(F.lit("t"), (F.col("event_id") * 3).cast("string"))).alias("trace_id"))
    found = joins.lookup_hot_then_warm(keys, joins.hot_view(warm, AS_OF), warm)
    return found.select(*_COLUMNS, "tier", F.col("copies").cast("int").alias("copies"))


@query("system_stats", "J5", f"""with {LOG_EVENTS_SQL}
    select cast(count(*) filter (where source = 'auth-service') as varchar) as "auth-service",
      cast(count(*) filter (where source = 'payment-service') as varchar) as "payment-service",
      'unavailable' as "order-service" from log_events""")
def system_stats(spark, sf_dir):
    rows = stats.count_by(log_events(spark, sf_dir), "source", name="value").select(
        F.col("source").alias("service"), F.lit("events").alias("metric"), "value")
    return joins.system_stats(rows, ["auth-service", "payment-service", "order-service"], "events")


@query("counter_delta", "W3 Q8", f"""
    with minutes as (select {SOURCE_CASE} as instance_id, date_trunc('hour', ts) as tick, count(*) as n
      from events group by 1, 2),
    totals as (select instance_id, tick, n, sum(n) over (partition by instance_id order by tick) as total from minutes)
    select instance_id, tick, cast(total as bigint) as total,
      cast(total - lag(total, 1, 0) over (partition by instance_id order by tick) as bigint) as rate from totals""")
def counter_delta(spark, sf_dir):
    ticks = events(spark, sf_dir).groupBy(
        F.expr(SOURCE_CASE).alias("instance_id"), F.date_trunc("hour", "ts").cast("timestamp_ntz").alias("tick")
    ).agg(F.count(F.lit(1)).alias("n"))
    totals = stats.cumulative(ticks, ["instance_id"], "tick", "n", "total").drop("n")
    return rolling.counter_delta(totals)


@query("publish_by_organization", "K1 K3 K5", f"""with {LOG_EVENTS_SQL}
    select organization_id as key, concat('{{"id":"', cast(id as varchar), '","organizationId":"', organization_id,
      '","level":"', level, '","message":"', message, '","source":"', source, '","timestamp":"',
      strftime("timestamp", '%Y-%m-%dT%H:%M:%S'), '"}}') as value from log_events""")
def publish_by_organization(spark, sf_dir):
    return topics.records(
        log_events(spark, sf_dir), topics.RECORD_KEYS["organization_event"],
        F.col("id").cast("string").alias("id"), F.col("organization_id").alias("organizationId"),
        "level", "message", "source", "timestamp")


@query("publish_parsed", "K4", f"""with {ACCESS_LOGS_SQL}
    select ip_address as key, concat('{{"ip_address":"', ip_address, '","request_path":"', request_path,
      '","status_code":', cast(status_code as varchar), '}}') as value
    from access_logs where log_format <> 'failed'""")
def publish_parsed(spark, sf_dir):
    return topics.records(
        parsed_only(parsed_lines(spark, sf_dir)), topics.RECORD_KEYS["parsed_event"],
        "ip_address", "request_path", "status_code")


@query("publish_correlated", "K2", """
    select md5(concat('c', cast(user_id as varchar))) as key, concat('{"correlationId":"',
      md5(concat('c', cast(user_id as varchar))), '","message":"', event_type, '"}') as value from events""")
def publish_correlated(spark, sf_dir):
    rows = events(spark, sf_dir).select(
        F.md5(F.concat(F.lit("c"), F.col("user_id").cast("string"))).alias("correlation_id"),
        F.col("event_type").alias("message"))
    return topics.records(rows, topics.RECORD_KEYS["correlated_event"],
                          F.col("correlation_id").alias("correlationId"), "message")


@query("publish_raw", "K6", "select cast(null as varchar) as key, concat(event_type, ' ', props) as value from events")
def publish_raw(spark, sf_dir):
    lines = events(spark, sf_dir).select(F.concat_ws(" ", "event_type", "props").alias("value"))
    return topics.raw_records(lines)


@query("content_hashes", "P7 E10", """
    select event_id, sha256(event_type) as content_hash, length(event_type) as size from events""")
def content_hashes(spark, sf_dir):
    return events(spark, sf_dir).select(
        "event_id", content_hash(F.col("event_type")).alias("content_hash"),
        F.length("event_type").cast("bigint").alias("size"))


@query("content_hash32", "P7", """
    with recursive chars as (
      select distinct event_type, 1 as i, cast(ascii(event_type) as bigint) as h from events
      union all
      select event_type, i + 1, (h * 31 + ascii(substr(event_type, i + 1, 1))) % 4294967296 from chars
        where i < length(event_type))
    select e.event_id, cast(case when h >= 2147483648 then h - 4294967296 else h end as integer) as hash32
    from events e join chars c on e.event_type = c.event_type and c.i = length(c.event_type)""")
def content_hash32(spark, sf_dir):
    return events(spark, sf_dir).select("event_id", string_hash32(F.col("event_type")).alias("hash32"))


@query("declared_widths", "K8", f"""with {LOG_EVENTS_SQL}
    select 'level' as column_name, 4 as width, count(*) filter (where length(level) > 4) as too_wide from log_events
    union all select 'source', 12, count(*) filter (where length(source) > 12) from log_events""")
def declared_widths(spark, sf_dir):
    return enrich.too_wide(log_events(spark, sf_dir), {"level": 4, "source": 12})


@query("rounded_durations", "E16", "select event_id, round(value / 7, 3) as duration from events")
def rounded_durations(spark, sf_dir):
    return events(spark, sf_dir).select("event_id", F.round(F.col("value") / 7, 3).alias("duration"))
