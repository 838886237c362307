"""The record types as projections of the test tables, in Spark and in SQL.

Every projection covers the whole ``events`` table and is a narrow expression, so the
queries below plan as they would on stored tables of these types.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..functions.app_log import app_line
from ..operators.parse import parse_access_lines

# "Now" of all queries over the test tables.
AS_OF = "2024-01-30 00:00:00"

LEVEL_CASE = ("case event_type when 'error' then 'ERROR' when 'signup' then 'WARN' "
              "when 'view' then 'DEBUG' else 'INFO' end")
SOURCE_CASE = ("case user_id % 4 when 0 then 'auth-service' when 1 then 'user-service' "
               "when 2 then 'payment-service' else 'notification-service' end")
STATUS_CASE = ("case event_type when 'error' then 500 when 'signup' then 201 "
               "when 'view' then 404 else 200 end")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events")


def log_events(spark: SparkSession, sf_dir: str, *extra: str | Column) -> DataFrame:
    """Service log events; ``extra`` adds columns of the events table."""
    return events(spark, sf_dir).select(
        F.col("event_id").alias("id"),
        F.concat(F.lit("org-"), (F.col("user_id") % 5).cast("string")).alias("organization_id"),
        F.expr(LEVEL_CASE).alias("level"),
        F.expr(SOURCE_CASE).alias("source"),
        F.concat(F.col("event_type"), F.lit(" by user_"), F.col("user_id").cast("string")).alias("message"),
        F.col("ts").alias("timestamp"),
        F.md5(F.concat(F.lit("t"), F.col("event_id").cast("string"))).alias("trace_id"),
        *extra,
    )


def with_metadata(spark: SparkSession, sf_dir: str) -> DataFrame:
    metadata = F.create_map(
        F.lit("user_id"), F.col("user_id").cast("string"),
        F.lit("k"), F.get_json_object("props", "$.k"))
    return log_events(spark, sf_dir, metadata.alias("metadata"))


LOG_EVENTS_SQL = f"""log_events as (
  select event_id as id, concat('org-', cast(user_id % 5 as varchar)) as organization_id,
    {LEVEL_CASE} as level, {SOURCE_CASE} as source,
    concat(event_type, ' by user_', cast(user_id as varchar)) as message, ts as "timestamp",
    md5(concat('t', cast(event_id as varchar))) as trace_id,
    user_id, event_type, value, props
  from events)"""


def lines_of(e: DataFrame) -> DataFrame:
    """Raw access-log lines of both formats, one in fifty corrupted, as ``event_id, value``."""
    millis = F.lpad((F.col("event_id") % 2000).cast("string"), 4, "0")
    head = F.concat(
        F.lit("10.0."), (F.col("user_id") % 4).cast("string"), F.lit("."), (F.col("user_id") % 250).cast("string"),
        F.lit(" - - ["), F.date_format("ts", "dd/MMM/yyyy:HH:mm:ss"), F.lit(' +0000] "'),
        F.expr("case when event_id % 2 = 0 then 'GET' else 'POST' end"),
        F.lit(" /api/"), F.col("event_type"), F.lit(' HTTP/1.1" '),
        F.expr(STATUS_CASE).cast("string"), F.lit(" "),
        F.when(F.col("event_id") % 7 == 0, "-").otherwise(F.floor(F.col("value") * 100).cast("string")))
    tail = F.concat(F.lit(' "-" "Mozilla/5.0" rt='), F.substring(millis, 1, 1), F.lit("."), F.substring(millis, 2, 3))
    line = (
        F.when(F.col("event_id") % 50 == 0, F.concat(F.lit("corrupted line "), F.col("event_id").cast("string")))
        .when(F.col("event_id") % 3 == 0, F.concat(head, tail))
        .otherwise(head))
    return e.select("event_id", line.alias("value"))


def access_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lines_of(events(spark, sf_dir))


# What parsing those lines must give, straight from the table.
ACCESS_LOGS_SQL = f"""access_logs as (
  select event_id,
    case when event_id % 50 = 0 then timestamp '{AS_OF}' else date_trunc('second', ts) end as "timestamp",
    case when event_id % 50 <> 0 then concat('10.0.', cast(user_id % 4 as varchar), '.', cast(user_id % 250 as varchar))
      end as ip_address,
    case when event_id % 50 <> 0 then case when event_id % 2 = 0 then 'GET' else 'POST' end end as http_method,
    case when event_id % 50 <> 0 then concat('/api/', event_type) end as request_path,
    case when event_id % 50 <> 0 then cast({STATUS_CASE} as integer) end as status_code,
    case when event_id % 50 <> 0 and event_id % 7 <> 0 then cast(floor(value * 100) as bigint) end as response_size,
    case when event_id % 50 <> 0 and event_id % 3 = 0 then 'Mozilla/5.0' end as user_agent,
    case when event_id % 50 <> 0 and event_id % 3 = 0 then '-' end as referer,
    case when event_id % 50 <> 0 and event_id % 3 = 0 then (event_id % 2000) / 1000.0::double end as response_time,
    case when event_id % 50 = 0 then 'failed' when event_id % 3 = 0 then 'nginx' else 'apache' end as log_format
  from events)"""


def parsed_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return parse_access_lines(access_lines(spark, sf_dir), AS_OF, keep=["event_id"])


def file_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Application log lines, as collected from one file per source."""
    e = events(spark, sf_dir)
    line = app_line(
        F.col("ts"), F.expr(LEVEL_CASE), F.expr(SOURCE_CASE), F.col("event_id") + 1_000_000,
        F.col("user_id") + 1000, F.col("event_type"), F.col("event_id") % 2000)
    return e.select(
        "event_id", F.concat(F.lit("/var/log/"), F.expr(SOURCE_CASE), F.lit(".log")).alias("file_path"),
        F.col("ts").alias("timestamp"), line.alias("content"))


FILE_LINES_SQL = f"""file_lines as (
  select event_id, concat('/var/log/', {SOURCE_CASE}, '.log') as file_path, ts as "timestamp",
    concat('[', strftime(ts, '%Y-%m-%d %H:%M:%S.%g'), '] ', {LEVEL_CASE}, ' [', {SOURCE_CASE}, '] [req:',
      cast(event_id + 1000000 as varchar), '] [user:', cast(user_id + 1000 as varchar), '] Operation ''',
      event_type, ''' completed in ', cast(event_id % 2000 as varchar), 'ms') as content
  from events)"""


def repeats(spark: SparkSession, sf_dir: str, content: str = "user") -> DataFrame:
    """Lines with repeats: few per hash (type and user), or few hashes with very many rows (type)."""
    text = F.concat_ws(":", F.col("event_type"), F.col("user_id").cast("string")) if content == "user" \
        else F.col("event_type")
    return events(spark, sf_dir).select(
        F.col("event_id").alias("id"), F.col("ts").alias("timestamp"), text.alias("content"),
        F.sha2(text, 256).alias("content_hash"))


def calls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Call outcomes per service instance."""
    return events(spark, sf_dir).select(
        F.col("event_id").alias("id"), F.col("ts").alias("timestamp"), F.expr(SOURCE_CASE).alias("instance"),
        (F.col("event_type") == "error").alias("failed"), F.col("value").alias("duration"))


CALLS_SQL = f"""calls as (
  select event_id as id, ts as "timestamp", {SOURCE_CASE} as instance, event_type = 'error' as failed,
    value as duration from events)"""
