"""Collected log files: application lines, offsets, tailing."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from ..operators import enrich, parse
from ..operators.frames import running_sum_before
from ..session import shared_dir
from ..sources import files
from ..sources.collector import collect_round
from .catalog import query
from .inputs import AS_OF, FILE_LINES_SQL, LEVEL_CASE, SOURCE_CASE, events, file_lines

_PLACED_SQL = f"""with {FILE_LINES_SQL},
    placed as (select *, octet_length(encode(content)) as byte_length,
      coalesce(cast(sum(octet_length(encode(content)) + 1) over (partition by file_path order by event_id
        rows between unbounded preceding and 1 preceding) as bigint), 0) as file_offset from file_lines)"""


def placed_lines(spark, sf_dir):
    """Lines of one file per source with the byte each starts at."""
    lines = file_lines(spark, sf_dir).withColumn("byte_length", F.octet_length("content").cast("bigint"))
    return running_sum_before(lines, ["file_path"], ["event_id"], F.col("byte_length") + 1, "file_offset")


@query("app_log_parse", "L8 E14", f"""
    select event_id, date_trunc('millisecond', ts) as "timestamp", {LEVEL_CASE} as level, {SOURCE_CASE} as service_name,
      event_id + 1000000 as request_id, user_id + 1000 as user_id, event_type as operation,
      event_id % 2000 as response_time_ms, true as parsed from events""")
def app_log_parse(spark, sf_dir):
    parsed = parse.parse_app_lines(file_lines(spark, sf_dir), "content", keep=["event_id"])
    return parsed.drop("raw_log")


@query("file_offsets", "P8 W2 Q19", f"{_PLACED_SQL} select event_id, file_path, file_offset from placed")
def file_offsets(spark, sf_dir):
    return placed_lines(spark, sf_dir).select("event_id", "file_path", "file_offset")


@query("file_events", "P5 P6 P7 P11 E14", f"""{_PLACED_SQL}
    select event_id, file_path, content, file_offset, timestamp '{AS_OF}' as "timestamp", 'localhost' as hostname,
      'log-collector' as service_name, sha256(content) as content_hash,
      concat(sha256(file_path), '-', cast(file_offset as varchar), '-{AS_OF.replace(" ", "T")}') as id,
      substr(content, 1, 50) as preview from placed""")
def file_events(spark, sf_dir):
    lines = placed_lines(spark, sf_dir).drop("timestamp", "byte_length")
    return enrich.stamp_file_event(lines, AS_OF)


@query("file_tail", "S8 Q6 Q20 T7", f"""{_PLACED_SQL},
    sizes as (select file_path, max(file_offset + byte_length + 1) as file_size from placed group by 1),
    commits as (select file_path, case when file_path like '%auth%' then file_size + 1
        when file_path like '%user%' then 0 else cast(floor(file_size / 2) as bigint) end as committed
      from sizes where file_path not like '%payment%')
    select event_id, p.file_path, file_offset from placed p join sizes s on p.file_path = s.file_path
      left join commits c on p.file_path = c.file_path
    where file_offset + byte_length > case when s.file_size < c.committed then 0 else coalesce(c.committed, 0) end""")
def file_tail(spark, sf_dir):
    """One file read from the middle, one from the start, one replaced by a shorter one, one whose commit is too old."""
    lines = placed_lines(spark, sf_dir)
    sizes = lines.groupBy("file_path").agg(
        F.max(F.col("file_offset") + F.col("byte_length") + 1).alias("file_size"))
    path = F.col("file_path")
    committed = F.when(path.contains("auth"), F.col("file_size") + 1).when(path.contains("user"), 0).otherwise(
        F.floor(F.col("file_size") / 2))
    old = F.when(path.contains("payment"), F.lit("2024-01-28 00:00:00")).otherwise(F.lit("2024-01-29 12:00:00"))
    commits = sizes.select(
        "file_path", committed.alias("committed_offset"), old.cast("timestamp_ntz").alias("committed_at"))
    new = files.after_offsets(lines.join(sizes, "file_path"), files.current_offsets(commits, AS_OF))
    return new.select("event_id", "file_path", "file_offset")


@query("collect_files", "S6 S9 F17 P8", f"with {FILE_LINES_SQL} select content, true as inside from file_lines")
def collect_files(spark, sf_dir):
    """The lines written to files below two directories and collected again."""
    base = f"{shared_dir(spark)}/logloom-runs/{uuid.uuid4().hex}"
    lines = file_lines(spark, sf_dir).withColumn("side", F.col("event_id") % 2)
    lines.select("content", "side").write.partitionBy("side").text(base)
    found = files.read_placed_lines(spark, f"{base}/side=0, {base}/side=1", "*.txt")
    return found.select("content", (F.col("file_offset") + F.col("byte_length") < F.col("file_size")).alias("inside"))


@query("collect_rounds", "S6 S7 S8 P8 T1 K3", f"with {FILE_LINES_SQL} select content, count(*) as rows from (select distinct content from file_lines) group by content")
def collect_rounds(spark, sf_dir):
    """Three rounds: some files, the same ones grown by a copy of their lines and new files, and nothing new."""
    base = f"{shared_dir(spark)}/logloom-runs/{uuid.uuid4().hex}"
    lines = file_lines(spark, sf_dir).select("content", (F.col("event_id") % 3).alias("side"))
    for number, part in enumerate((lines.filter("side = 0"), lines.filter("side <= 1"), lines.filter("side = 2"), lines.limit(0))):
        part.write.mode("append").partitionBy("side").text(f"{base}/logs")
        collect_round(spark, f"{base}/logs", f"{base}/store", f"2024-01-30 00:0{number}:00", "*.txt")
    stored = spark.read.parquet(f"{base}/store/events")
    return stored.groupBy("content").agg(F.count("*").alias("rows"))


@query("drop_blank_lines", "F18", "select event_id, event_type as value from events where event_id % 3 <> 0")
def drop_blank_lines(spark, sf_dir):
    value = F.when(F.col("event_id") % 6 == 0, " \t").when(F.col("event_id") % 3 == 0, "").otherwise(F.col("event_type"))
    return parse.drop_blank_lines(events(spark, sf_dir).select("event_id", value.alias("value")))


