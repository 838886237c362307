"""Streams read files in several batches; the stored result equals the batch operator, and a restart adds nothing."""

import json
import os
import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from logloom.operators import dedup, rolling
from logloom.schema import TRACED_EVENT_WIRE
from logloom.sinks.tiers import read_hot
from logloom.sources import files
from logloom.streaming import pipelines, stateful

AS_OF = "2024-05-10 00:00:00"
LINE = '10.0.0.{} - - [01/May/2024:10:{:02d}:00 +0000] "GET /x HTTP/1.1" {} 10'


def clock():
    return AS_OF


def text_stream(spark, folder):
    return spark.readStream.option("maxFilesPerTrigger", 1).text(str(folder))


def write(folder, name, lines):
    folder.mkdir(exist_ok=True)
    path = folder / name
    path.write_text("".join(f"{line}\n" for line in lines))
    at = 1_700_000_000 + len(list(folder.iterdir()))  # files arrive one after the other
    os.utime(path, (at, at))


def test_parse_stream_and_restart(spark, tmp_path):
    source, base = tmp_path / "in", str(tmp_path / "out")
    for n in range(3):
        write(source, f"{n}.log", [LINE.format(n, m, 200 + n) for m in range(5)] + [f"bad {n}"])

    def run():
        pipelines.parse_stream(text_stream(spark, source), base, f"{base}/checkpoint", clock).awaitTermination()
        return spark.read.parquet(f"{base}/parsed").count(), spark.read.json(f"{base}/dlq").count()

    assert run() == (15, 3)
    assert run() == (15, 3)
    write(source, "3.log", [LINE.format(9, 1, 500), "bad"])
    assert run() == (16, 4)
    statuses = {r["status_code"] for r in spark.read.parquet(f"{base}/parsed").collect()}
    assert statuses == {200, 201, 202, 500}


def test_tier_stream(spark, tmp_path):
    source, base = tmp_path / "in", str(tmp_path / "out")
    events = [{"timestamp": f"2024-05-0{1 + i % 9}T12:00:00", "level": ["ERROR", "INFO"][i % 2], "source": "s",
               "message": str(i), "metadata": {"user_id": i}, "trace_id": f"t{i % 20}"} for i in range(40)]
    write(source, "0.json", map(json.dumps, events[:20]))
    write(source, "1.json", [*map(json.dumps, events[20:]), "{broken"])
    for _ in range(2):
        pipelines.tier_stream(
            text_stream(spark, source), TRACED_EVENT_WIRE, base, f"{base}/checkpoint", clock,
            id_from=["trace_id", "message"]).awaitTermination()
    warm = spark.read.parquet(f"{base}/warm")
    assert warm.count() == 40 and warm.select("id").distinct().count() == 40
    live = {e["trace_id"] for e in events if e["timestamp"] > "2024-05-09"}
    assert {r["trace_id"] for r in read_hot(spark, f"{base}/hot", AS_OF).collect()} == live
    cold = sum(e["level"] == "ERROR" or e["timestamp"] < "2024-05-03" for e in events)
    assert spark.read.text(f"{base}/cold").count() == cold
    assert [r["raw_log"] for r in spark.read.json(f"{base}/dlq").collect()] == ["{broken"]


def test_upsert_stream(spark, tmp_path):
    source, base = tmp_path / "in", str(tmp_path / "out")
    write(source, "0.csv", ["1,a,1", "2,b,1"])
    write(source, "1.csv", ["1,A,2", "3,c,1"])
    rows = text_stream(spark, source).select(F.split("value", ",").alias("p")).selectExpr(
        "p[0] as id", "p[1] as v", "cast(p[2] as int) as processed_at", "timestamp_ntz'2024-05-01 00:00:00' as timestamp")
    for _ in range(2):
        pipelines.upsert_stream(rows, f"{base}/warm", f"{base}/checkpoint").awaitTermination()
        assert sorted(tuple(r) for r in spark.read.parquet(f"{base}/warm").select("id", "v").collect()) == [
            ("1", "A"), ("2", "b"), ("3", "c")]


def test_dedup_stream_equals_batch(spark, tmp_path):
    rng = random.Random(8)
    times = sorted(rng.randrange(0, 20_000) for _ in range(300))
    rows = [(i, rng.choice("abcd"), datetime(2024, 5, 1) + timedelta(seconds=s)) for i, s in enumerate(times)]
    source, base = tmp_path / "in", str(tmp_path / "out")
    for n in range(4):
        write(source, f"{n}.csv", [f"{i},{h},{t.isoformat()}" for i, h, t in rows[n * 75:(n + 1) * 75]])
    parts = F.split("value", ",")
    stream = text_stream(spark, source).select(
        parts[0].cast("bigint").alias("id"), parts[1].alias("content_hash"),
        parts[2].cast("timestamp_ntz").alias("timestamp"))
    for _ in range(2):
        pipelines.dedup_stream(stream, base, f"{base}/checkpoint").awaitTermination()
        streamed = sorted(r["id"] for r in spark.read.parquet(f"{base}/events").collect())
        batch = dedup.drop_repeats(spark.createDataFrame(rows, "id bigint, content_hash string, timestamp timestamp_ntz"))
        assert streamed == sorted(r["id"] for r in batch.collect())


def test_built_in_dedup_keeps_first_and_drops_near_repeats(spark, tmp_path):
    source = tmp_path / "in"
    write(source, "0.csv", ["1,a,2024-05-01T00:00:00", "2,a,2024-05-01T00:10:00", "3,b,2024-05-01T00:10:00"])
    write(source, "1.csv", ["4,a,2024-05-01T00:29:00"])
    write(source, "2.csv", ["5,z,2024-05-01T09:00:00"])
    write(source, "3.csv", ["6,y,2024-05-01T09:30:00"])
    write(source, "4.csv", ["7,a,2024-05-01T20:00:00"])
    parts = F.split("value", ",")
    stream = text_stream(spark, source).select(
        parts[0].cast("int").alias("id"), parts[1].alias("content_hash"), parts[2].cast("timestamp").alias("timestamp"))
    query = (pipelines.drop_repeats_within_watermark(stream).writeStream.format("memory").queryName("near")
             .option("checkpointLocation", str(tmp_path / "checkpoint")).trigger(availableNow=True).start())
    query.awaitTermination()
    kept = {r["id"] for r in spark.table("near").collect()}
    assert kept == {1, 3, 5, 6, 7}


def test_file_stream_of_several_directories(spark, tmp_path):
    write(tmp_path / "a", "x.log", ["one", "", "two\r"])
    write(tmp_path / "b", "y.log", ["three"])
    write(tmp_path / "b", "z.txt", ["no"])
    stream = files.stream_lines(spark, f"{tmp_path}/a,{tmp_path}/b", files_per_trigger=1)
    query = (stream.writeStream.format("memory").queryName("lines")
             .option("checkpointLocation", str(tmp_path / "checkpoint")).trigger(availableNow=True).start())
    query.awaitTermination()
    assert sorted(r["content"] for r in spark.table("lines").collect()) == ["one", "three", "two"]


def test_run_counters(spark):
    from pyspark.sql import Observation

    rows = spark.range(10)
    seen = Observation("run")
    rows.observe(seen, F.count(F.lit(1)).alias("received")).count()
    assert seen.get["received"] == 10
    observed = pipelines.observed(rows, "counters", odd=F.col("id") % 2 == 1)
    assert observed.count() == 10


@pytest.mark.parametrize("missing", ["kafka"])
def test_topic_source_needs_its_package(spark, missing):
    from logloom.sources import topics

    with pytest.raises(Exception, match="(?i)kafka"):
        topics.read_topic_stream(spark, "host:1", topics.LOG_EVENTS)


def test_repeats_by_keyed_state(spark, tmp_path):
    """Batches in time order give what one run of the batch operator gives; a restart in between changes nothing."""
    rng = random.Random(6)
    source, out, checkpoint = str(tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / "checkpoint")
    start = datetime(2024, 3, 1)
    data = [(k, rng.choice(["a"] * 6 + ["b", "c", None]), start + timedelta(seconds=s)) for k, s in enumerate(sorted(rng.randrange(20_000) for _ in range(600)))]
    data += [(9999, "a", None)]
    schema = "id bigint, content_hash string, timestamp timestamp"
    stateful.keep_state(spark)
    for number in range(3):
        spark.createDataFrame(data[number * 200 : number * 200 + 200 + (number == 2)], schema).coalesce(1).write.parquet(f"{source}/part={number}")
        rows = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(f"{source}/part=*")
        (stateful.drop_repeats_stream(rows, ttl_seconds=700).writeStream.format("parquet").option("path", out)
         .option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination())
    expected = dedup.drop_repeats(spark.createDataFrame(data, schema), ttl_seconds=700)
    assert sorted(r["id"] for r in spark.read.parquet(out).collect()) == sorted(r["id"] for r in expected.collect())


def test_call_rates_by_keyed_state(spark, tmp_path):
    source, out, checkpoint = str(tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / "checkpoint")
    rng = random.Random(8)
    data = [(k, rng.choice("aaab"), rng.choice([True, False, None])) for k in range(200)]
    schema = "id bigint, instance string, failed boolean"
    stateful.keep_state(spark)
    for number in range(4):
        spark.createDataFrame(data[number * 50 : number * 50 + 50], schema).write.parquet(f"{source}/part={number}")
        rows = spark.readStream.schema(schema).parquet(f"{source}/part=*")
        (stateful.bad_call_rate_stream(rows, "failed", order=["id"], window=4, min_calls=3).writeStream.format("parquet").option("path", out)
         .option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination())
    columns = ["id", "instance", "calls", "bad_calls", "rate", "tripped"]
    expected = rolling.failure_rate(spark.createDataFrame(data, schema), order=["id"], window=4, min_calls=3).select(columns)
    assert sorted(map(tuple, spark.read.parquet(out).select(columns).collect())) == sorted(map(tuple, expected.collect()))


def test_repeats_of_many_keys_share_state(spark, tmp_path):
    """Python is called for buckets, not for keys: the state has a row and a timer for a bucket, and the rows are those of the batch operator."""
    rng = random.Random(9)
    source, out, checkpoint = str(tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / "checkpoint")
    start = datetime(2024, 3, 1)
    data = [(k, rng.randrange(150), start + timedelta(seconds=s)) for k, s in enumerate(sorted(rng.randrange(9_000) for _ in range(1500)))]
    schema = "id bigint, _bucket bigint, timestamp timestamp"
    stateful.keep_state(spark)
    held = []
    for number in range(3):
        spark.createDataFrame(data[number * 500 : number * 500 + 500], schema).coalesce(1).write.parquet(f"{source}/part={number}")
        rows = spark.readStream.schema(schema).parquet(f"{source}/part=*")
        query = (stateful.drop_repeats_stream(rows, key="_bucket", ttl_seconds=900, buckets=4).writeStream.format("parquet").option("path", out)
                 .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
        query.awaitTermination()
        held += [operator["numRowsTotal"] for progress in query.recentProgress for operator in json.loads(progress.json)["stateOperators"]]
    expected = dedup.drop_repeats(spark.createDataFrame(data, schema), key="_bucket", ttl_seconds=900)
    assert sorted(r["id"] for r in spark.read.parquet(out).collect()) == sorted(r["id"] for r in expected.collect())
    assert 0 < max(held) <= 4 * 3
