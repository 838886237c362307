"""The continuous queries, driven over all rows of the events table and read back."""

from __future__ import annotations

import uuid
from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window as W, functions as F
from pyspark.sql.streaming import StreamingQuery

from ..functions.json_codec import encode
from ..schema import TRACED_EVENT_WIRE
from ..session import shared_dir
from ..sinks.layout import drop_files
from ..sinks.tiers import read_hot
from ..sources.tail import file_system, tail_stream as tailed
from ..streaming import pipelines, stateful
from .catalog import query
from .inputs import ACCESS_LOGS_SQL, AS_OF, FILE_LINES_SQL, LEVEL_CASE, LOG_EVENTS_SQL, SOURCE_CASE, events, file_lines, lines_of
from .limits import USER_CONTENT, _dedup_sql

#: Parts in which a stream's input arrives, each behind the one before in time.
ROUNDS = 3


def _events_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    schema = spark.read.parquet(f"{sf_dir}/events.parquet").schema
    return spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet").parquet(sf_dir)


def _run_dir(spark: SparkSession) -> str:
    return f"{shared_dir(spark)}/logloom-runs/{uuid.uuid4().hex}"


def _clock() -> str:
    return AS_OF


@query("stream_parse", "S1 S2 S7 T6 F19 K13", f"""with {ACCESS_LOGS_SQL}
    select event_id, "timestamp", ip_address, status_code, response_size, response_time, log_format
    from access_logs where log_format <> 'failed'""")
def stream_parse(spark, sf_dir):
    base = _run_dir(spark)
    stream = _events_stream(spark, sf_dir)
    lines = lines_of(stream)
    pipelines.parse_stream(lines, base, f"{base}/checkpoint", _clock, keep=["event_id"]).awaitTermination()
    return spark.read.parquet(f"{base}/parsed").select(
        "event_id", "timestamp", "ip_address", "status_code", "response_size", "response_time", "log_format")


@query("stream_counters", "A7 A9 A13 T6", f"""with {ACCESS_LOGS_SQL}
    select log_format, count(*) as lines from access_logs group by 1""")
def stream_counters(spark, sf_dir):
    """Counters that a parse stream writes beside its rows, over three batches of which the last is run twice."""
    base = _run_dir(spark)
    rows = events(spark, sf_dir).withColumn("timestamp", F.col("ts"))
    start = lambda stream: pipelines.parse_stream(lines_of(stream), base, f"{base}/checkpoint", _clock, keep=["event_id"], counters=f"{base}/counters")
    _in_rounds(spark, rows, base, start)
    drop_files(spark, [f"{base}/checkpoint/commits/{ROUNDS - 1}", f"{base}/checkpoint/commits/.{ROUNDS - 1}.crc"])  # as if it had broken off before the end
    start(spark.readStream.schema(rows.schema).parquet(f"{base}/in/part=*")).awaitTermination()
    return pipelines.read_counters(spark, f"{base}/counters").select("log_format", "lines")


@query("stream_tiers", "S3 S12 K8 K10 K11 K12 T6", f"""with {LOG_EVENTS_SQL},
    sent as (select id, level, date_trunc('second', "timestamp") as "timestamp" from log_events)
    select 'warm' as tier, level, count(*) as count from sent group by 2
    union all select 'hot', level, count(*) from sent where "timestamp" > timestamp '{AS_OF}' - interval 24 hour group by 2
    union all select 'cold', upper(level), count(*) from sent
      where level in ('ERROR', 'WARN') or "timestamp" < timestamp '{AS_OF}' - interval 7 day group by 2""")
def stream_tiers(spark, sf_dir):
    base = _run_dir(spark)
    records = _events_stream(spark, sf_dir).select(encode(
        F.col("ts").alias("timestamp"), F.expr(LEVEL_CASE).alias("level"), F.expr(SOURCE_CASE).alias("source"),
        F.concat(F.lit("event "), F.col("event_id").cast("string")).alias("message"),
        F.create_map(F.lit("user_id"), F.col("user_id").cast("string")).alias("metadata"),
        F.md5(F.concat(F.lit("t"), F.col("event_id").cast("string"))).alias("trace_id")).alias("value"))
    pipelines.tier_stream(
        records, TRACED_EVENT_WIRE, base, f"{base}/checkpoint", _clock, id_from=["trace_id"]).awaitTermination()
    warm = spark.read.parquet(f"{base}/warm").select(F.lit("warm").alias("tier"), "level")
    hot = read_hot(spark, f"{base}/hot", AS_OF).select(
        F.lit("hot").alias("tier"), F.get_json_object("document", "$.level").alias("level"))
    cold = spark.read.schema("message string, level string, date date").json(f"{base}/cold").select(
        F.lit("cold").alias("tier"), F.upper("level").alias("level"))
    return warm.unionByName(hot).unionByName(cold).groupBy("tier", "level").agg(F.count(F.lit(1)).alias("count"))


@query("stream_upsert", "K7 T6", f"""
    select user_id as id, event_id as version, event_type, ts as "timestamp" from (
      select *, row_number() over (partition by user_id order by event_id desc) as rn from events) where rn = 1""")
def stream_upsert(spark, sf_dir):
    base = _run_dir(spark)
    rows = _events_stream(spark, sf_dir).select(
        F.col("user_id").alias("id"), F.col("event_id").alias("version"), "event_type", F.col("ts").alias("timestamp"))
    pipelines.upsert_stream(rows, f"{base}/warm", f"{base}/checkpoint", version="version").awaitTermination()
    return spark.read.parquet(f"{base}/warm").drop("date", "epoch_s")


def _in_rounds(spark: SparkSession, rows: DataFrame, base: str, start: Callable[[DataFrame], StreamingQuery]) -> None:
    """Run a stream once for each of ``ROUNDS`` parts of ``rows``, in the order of their ``timestamp``; each run goes on from the last one's checkpoint."""
    ends = rows.agg(F.percentile_approx(F.unix_micros(F.col("timestamp").cast("timestamp")), [k / ROUNDS for k in range(1, ROUNDS)]).alias("ends")).first()["ends"]
    at = F.unix_micros(F.col("timestamp").cast("timestamp"))
    part = sum(((at > end).cast("int") for end in ends), F.lit(0))
    for number in range(ROUNDS):
        rows.where(F.coalesce(part, F.lit(0)) == number).write.parquet(f"{base}/in/part={number}")
        start(spark.readStream.schema(rows.schema).parquet(f"{base}/in/part=*")).awaitTermination()


def _hashed(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.concat_ws(":", "event_type", F.col("user_id").cast("string"))
    return events(spark, sf_dir).select(
        F.col("event_id").alias("id"), F.col("ts").alias("timestamp"), text.alias("content"), F.sha2(text, 256).alias("content_hash"))


@query("stream_dedup", "T1 J3 T6 T7", _dedup_sql(USER_CONTENT))
def stream_dedup(spark, sf_dir):
    """Three batches against the table of remembered hashes."""
    base = _run_dir(spark)
    _in_rounds(spark, _hashed(spark, sf_dir), base, lambda rows: pipelines.dedup_stream(rows, base, f"{base}/checkpoint"))
    return spark.read.parquet(f"{base}/events").select("id", "timestamp", "content")


@query("stream_dedup_state", "T1 J3 T6", _dedup_sql(USER_CONTENT))
def stream_dedup_state(spark, sf_dir):
    """Three batches against keyed state: the same rows."""
    base = _run_dir(spark)
    stateful.keep_state(spark)

    def start(rows: DataFrame) -> StreamingQuery:
        zoned = rows.withColumn("timestamp", F.col("timestamp").cast("timestamp"))
        return (stateful.drop_repeats_stream(zoned).writeStream.format("parquet").option("path", f"{base}/events")
                .option("checkpointLocation", f"{base}/checkpoint").trigger(availableNow=True).start())

    _in_rounds(spark, _hashed(spark, sf_dir), base, start)
    return spark.read.parquet(f"{base}/events").select("id", F.col("timestamp").cast("timestamp_ntz").alias("timestamp"), "content")


@query("stream_failure_rate", "W4 T6", f"""with calls as (
      select event_id as id, {SOURCE_CASE} as instance, ts as "timestamp", event_type = 'error' as failed from events),
    framed as (select *, count(*) over w as calls, cast(sum(failed::int) over w as bigint) as bad_calls from calls
      window w as (partition by instance order by "timestamp", id rows between 9 preceding and current row))
    select id, instance, "timestamp", calls, bad_calls, bad_calls / calls as rate, calls >= 5 and bad_calls / calls >= 0.5 as tripped from framed""")
def stream_failure_rate(spark, sf_dir):
    """Three batches; the last ten calls of an instance go over from one to the next."""
    base = _run_dir(spark)
    stateful.keep_state(spark)
    calls = events(spark, sf_dir).select(F.col("event_id").alias("id"), F.expr(SOURCE_CASE).alias("instance"), F.col("ts").alias("timestamp"),
                                         (F.col("event_type") == "error").alias("failed"))

    def start(rows: DataFrame) -> StreamingQuery:
        return (stateful.bad_call_rate_stream(rows, "failed").writeStream.format("parquet").option("path", f"{base}/rates")
                .option("checkpointLocation", f"{base}/checkpoint").trigger(availableNow=True).start())

    _in_rounds(spark, calls, base, start)
    return spark.read.parquet(f"{base}/rates").drop("failed")


@query("stream_dedup_watermark", "T1", f"""
    with firsts as (select event_id as id, ts as "timestamp", sha256({USER_CONTENT}) as content_hash,
      row_number() over (partition by {USER_CONTENT} order by ts, event_id) as rn from events)
    select content_hash, count(*) as rows, true as first_kept, true as apart from firsts where rn = 1 group by content_hash""")
def stream_dedup_watermark(spark, sf_dir):
    """The built-in form in three batches: which rows of a batch it keeps is open, but each hash has one in the batch it
    first comes in, and rows that it keeps in different batches are apart by the life time."""
    base = _run_dir(spark)

    def start(rows: DataFrame) -> StreamingQuery:
        zoned = rows.withColumn("timestamp", F.col("timestamp").cast("timestamp"))
        return (pipelines.drop_repeats_within_watermark(zoned).writeStream.format("parquet")
                .option("path", f"{base}/events").option("checkpointLocation", f"{base}/checkpoint")
                .trigger(availableNow=True).start())

    rows = _hashed(spark, sf_dir)
    _in_rounds(spark, rows, base, start)
    kept = spark.read.parquet(f"{base}/events").withColumn("timestamp", F.col("timestamp").cast("timestamp_ntz"))
    before = F.lag("timestamp").over(W.partitionBy("content_hash").orderBy("timestamp"))
    apart = F.coalesce(F.col("timestamp") >= before + F.expr("interval 30 minutes"), F.lit(True))
    parts = spark.read.parquet(f"{base}/in").select("id", "part", "content_hash")
    first_part = parts.groupBy("content_hash").agg(F.min("part").alias("first_part"))
    marked = kept.withColumn("apart", apart).join(parts.select("id", "part"), "id")
    found = marked.groupBy("content_hash").agg(F.min("part").alias("part"), F.min("apart").alias("apart")).join(first_part, "content_hash")
    return found.select("content_hash", F.lit(1).cast("bigint").alias("rows"), (F.col("part") == F.col("first_part")).alias("first_kept"), "apart")


@query("tail_stream", "S7 S8 P8 T6", f"with {FILE_LINES_SQL} select content, count(*) as rows from file_lines group by content")
def tail_stream(spark, sf_dir):
    """Files that grow twice while they are read: every complete line comes once."""
    base = _run_dir(spark)
    lines = file_lines(spark, sf_dir).withColumn("file", F.concat(F.lit(f"{base}/logs/"), F.md5("file_path"), F.lit("-"), (F.col("event_id") % 4).cast("string"), F.lit(".log")))
    for number in range(ROUNDS):
        _append(lines.where(F.floor(F.col("event_id") / 4) % ROUNDS == number).select("file", "event_id", "content"))
        (tailed(spark, f"{base}/logs").writeStream.format("parquet").option("path", f"{base}/lines")
         .option("checkpointLocation", f"{base}/checkpoint").trigger(availableNow=True).start().awaitTermination())
    return spark.read.parquet(f"{base}/lines").groupBy("content").agg(F.count("*").alias("rows"))


def _append(lines: DataFrame) -> None:
    """Stands for the programs that write logs: each task appends to its files."""

    def run(batches):
        for batch in batches:
            held = {}
            for path, line in zip(batch.column("file").to_pylist(), batch.column("content").to_pylist(), strict=True):
                held.setdefault(path, []).append(line + "\n")
            for path, own in held.items():
                files, inner, _ = file_system(path)
                files.create_dir(inner.rpartition("/")[0])
                with files.open_append_stream(inner) as out:
                    out.write("".join(own).encode())
            yield pa.RecordBatch.from_arrays([pa.array([len(held)], pa.int64())], ["files"])

    lines.repartition("file").sortWithinPartitions("file", "event_id").mapInArrow(run, "files bigint").count()
