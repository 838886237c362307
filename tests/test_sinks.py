import glob
import gzip
import json
import os
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from logloom.schema import ORG_EVENT_WIRE, TRACED_EVENT_WIRE
from logloom.operators import filters
from logloom.sinks import layout, letters, rotation, tiers, warm
from logloom.sources import ingest, tables, topics

AS_OF = "2024-05-10 00:00:00"


@pytest.fixture
def log(events_of):
    return events_of([
        (1, "ERROR", "auth", "boom", "2024-05-01 09:00:00", "a"),
        (2, "WARN", "auth", "hmm", "2024-05-02 10:00:00", "b"),
        (3, "INFO", "user", "in", "2024-05-02 10:30:00", "c"),
        (4, "INFO", "user", "out", "2024-05-09 11:00:00", "c"),
        (5, "DEBUG", "user", "late", "2024-05-09 23:00:00", "c"),
        (6, "INFO", "user", "no time", None, "d"),
    ])


def versioned(df, n):
    return df.withColumn("processed_at", F.lit(f"2024-05-10 0{n}:00:00").cast("timestamp_ntz"))


def stored(spark, path, *columns):
    return sorted(tuple(r) for r in spark.read.parquet(str(path)).select(*columns).collect())


def test_upsert_table(spark, log, tmp_path):
    path = f"{tmp_path}/warm"
    warm.upsert_events(versioned(log, 1), path)
    untouched = sorted(glob.glob(f"{path}/date=2024-05-01/*.parquet"))
    batch = versioned(log.filter("id in (2, 4)"), 2).withColumn("message", F.lit("again"))
    for _ in range(2):
        warm.upsert_events(batch, path)
        assert stored(spark, path, "id", "message") == [
            (1, "boom"), (2, "again"), (3, "in"), (4, "again"), (5, "late"), (6, "no time")]
    assert sorted(glob.glob(f"{path}/date=2024-05-01/*.parquet")) == untouched


def test_upsert_moves_an_event_to_another_day(spark, log, tmp_path):
    path = f"{tmp_path}/warm"
    warm.upsert_events(versioned(log, 1), path)
    moved = versioned(log.filter("id = 1"), 2).withColumn("timestamp", F.lit("2024-05-03 00:00:00").cast("timestamp_ntz"))
    warm.upsert_events(moved, path)
    assert stored(spark, path, "id") == [(i,) for i in range(1, 7)]
    assert not os.path.exists(f"{path}/date=2024-05-01") and os.path.exists(f"{path}/date=2024-05-03")
    found = versioned(log.filter("id = 6"), 3).withColumn("timestamp", F.lit("2024-05-03 01:00:00").cast("timestamp_ntz"))
    warm.upsert_events(found, path)
    assert stored(spark, path, "id") == [(i,) for i in range(1, 7)]


def test_appending_a_batch_twice_leaves_one_copy(spark, log, tmp_path):
    path = f"{tmp_path}/warm"
    warm.append_events(log, path, batch_id=0)
    for _ in range(2):
        warm.append_events(log.withColumn("id", F.col("id") + 10), path, batch_id=1, within=["timestamp"])
    assert tables.read_table(spark, path).count() == 12
    warm.append_events(log, path + "2")
    warm.append_events(log, path + "2")
    assert spark.read.parquet(path + "2").count() == 12


def test_metadata_rows(spark, tmp_path):
    events = spark.sql("select 1 as id, timestamp_ntz'2024-05-01 00:00:00' as timestamp, map('k', 'v') as metadata")
    warm.append_metadata(events, f"{tmp_path}/meta", batch_id=0)
    assert stored(spark, f"{tmp_path}/meta", "log_event_id", "key", "value") == [(1, "k", "v")]


@pytest.mark.parametrize("batch_id", [None, 3])
def test_retention(spark, log, tmp_path, batch_id):
    path = f"{tmp_path}/warm"
    warm.append_events(log, path, batch_id)
    assert warm.apply_retention(spark, path, "2024-05-10 10:15:00", days=8) == 2
    assert stored(spark, path, "id") == [(3,), (4,), (5,), (6,)]
    assert not os.path.exists(f"{path}/date=2024-05-01")
    assert warm.apply_retention(spark, path, "2024-05-10 10:15:00", days=8) == 0
    assert warm.apply_retention(spark, path, "2024-05-10 10:30:01", days=8) == 1
    assert stored(spark, path, "id") == [(4,), (5,), (6,)]  # events without time never expire


def test_tiers(spark, log, tmp_path):
    base = str(tmp_path)
    events = log.withColumn("metadata", F.create_map(F.lit("k"), F.lit("v")))
    for _ in range(2):
        tiers.store_batch(events, base, AS_OF, 0)
    newer = events.filter("id = 5").withColumn("message", F.lit("newest"))
    tiers.store_batch(newer, base, AS_OF, 1)
    assert spark.read.parquet(f"{base}/warm").count() == 7
    names = sorted(os.path.relpath(p, f"{base}/cold").rsplit("/", 2)[0]
                   for p in glob.glob(f"{base}/cold/**/*.json", recursive=True))
    assert names == ["level=error/date=2024-05-01", "level=info/date=2024-05-02", "level=warn/date=2024-05-02"]
    hot = [json.loads(r["document"]) for r in tiers.read_hot(spark, f"{base}/hot", AS_OF).collect()]
    assert [(d["trace_id"], d["message"], d["metadata"]) for d in hot] == [("c", "newest", {"k": "v"})]
    assert tiers.read_hot(spark, f"{base}/hot", "2024-05-12 00:00:00").isEmpty()
    tiers.expire_hot(spark, f"{base}/hot", AS_OF)
    assert os.path.exists(f"{base}/hot/date=2024-05-09")
    tiers.store_batch(events.withColumn("timestamp", F.lit("2024-05-11 23:00:00").cast("timestamp_ntz")), base, "2024-05-12 00:00:00", 2)
    tiers.expire_hot(spark, f"{base}/hot", "2024-05-12 00:00:00")
    assert sorted(n for n in os.listdir(f"{base}/hot") if n.startswith("date")) == ["date=2024-05-11"]
def test_cold_names(log):
    rows = tiers.cold_rows(log, AS_OF).select("id", "file_name").collect()
    assert {r["id"]: r["file_name"] for r in rows} == {
        1: "error-2024-05-01.log", 2: "warn-2024-05-02.log", 3: "info-2024-05-02.log"}


def test_journal(spark, log, tmp_path):
    for batch in (0, 0, 1):
        tiers.append_journal(log, f"{tmp_path}/wal", "2024-05-10 07:59:59", batch)
    tiers.append_journal(log, f"{tmp_path}/wal", "2024-05-10 08:00:00", 2)
    assert sorted(os.listdir(f"{tmp_path}/wal/date=2024-05-10")) == ["hour=07", "hour=08"]
    assert spark.read.text(f"{tmp_path}/wal").count() == 18


def test_rotation(spark, log, tmp_path):
    cold, archive = f"{tmp_path}/cold", f"{tmp_path}/archive"
    tiers.append_cold(log, cold, AS_OF, 0)
    tiers.append_cold(log.withColumn("message", F.repeat("message", F.lit(100))).filter("id = 1"), cold, AS_OF, 1)
    before = sorted(r["value"] for r in spark.read.text(cold).collect())
    now = datetime.now().replace(microsecond=0)
    applied = rotation.rotate(spark, cold, archive, now, max_size="400", max_age_hours=24)
    assert [(r["file_name"], r["reason"]) for r in applied.collect()] == [("error-2024-05-01.log", "size")]
    assert applied.first()["rotated_name"] == f"error-2024-05-01-{now:%Y%m%d-%H%M%S}.log.gz"
    assert sorted(os.listdir(cold)) [-2:] == ["level=info", "level=warn"]
    packed = [p for p in glob.glob(f"{archive}/**/*.gz", recursive=True) if "level=error/date=2024-05-01" in p]
    moved = [line for p in packed for line in gzip.open(p, "rt").read().splitlines()]
    left = [r["value"] for r in spark.read.text(cold).collect()]
    assert len(moved) == 2 and sorted(moved + left) == before
    assert rotation.rotate(spark, cold, archive, now, max_size="1MB").isEmpty()


def test_rotation_plan_limits(spark):
    files = spark.createDataFrame(
        [("a.log", 100, "2024-05-09 00:00:00"), ("b.log", 101, "2024-05-09 12:00:00"),
         ("c.log", 1, "2024-05-08 23:59:59"), ("d.txt", 999, "2024-01-01 00:00:00")],
        "file_name string, file_size bigint, at string").selectExpr("file_name", "file_size", "cast(at as timestamp_ntz) as modified")
    plan = rotation.rotation_plan(files, AS_OF, max_size=100)
    assert {(r["file_name"], r["reason"]) for r in plan.collect()} == {("b.log", "size"), ("c.log", "age")}


def test_dead_letter_table(spark, tmp_path):
    dead = spark.createDataFrame([('a "b"', "why", datetime(2024, 5, 1))], "raw_log string, failure_reason string, timestamp timestamp_ntz")
    for batch in (0, 0, 1):
        letters.append_letters(dead, f"{tmp_path}/dlq", batch)
    rows = spark.read.json(f"{tmp_path}/dlq").collect()
    assert [(r["raw_log"], r["failure_reason"]) for r in rows] == [('a "b"', "why")] * 2


def test_decode(spark):
    records = spark.createDataFrame([
        ('{"id":"1","organizationId":"o","level":"INFO","timestamp":"2024-05-01T10:00:00","extra":1}',),
        ('{"id":"2","timestamp":null}',), ("not json",), ('{"id":',), ('{"id":"3","timestamp":"nope"}',), (None,),
    ], "value string")
    good, dead = ingest.ingest(records, ORG_EVENT_WIRE, AS_OF)
    rows = sorted(good.collect(), key=lambda r: r["id"])
    assert [r["id"] for r in rows] == ["1", "2"]
    assert rows[0]["timestamp"] == datetime(2024, 5, 1, 10) and rows[1]["timestamp"] == datetime(2024, 5, 10)
    assert all(r["processed_at"] == datetime(2024, 5, 10) and r["trace_id"] for r in rows)
    assert sorted(str(r["raw_log"]) for r in dead.collect()) == sorted(
        ["not json", '{"id":', '{"id":"3","timestamp":"nope"}', ""])


def test_metadata_values_keep_their_json_text(spark):
    value = '{"trace_id":"t","metadata":{"s":"x","n":7,"o":{"a":[1]},"z":null}}'
    row = ingest.decode_events(spark.createDataFrame([(value,)], "value string"), TRACED_EVENT_WIRE).first()
    assert row["trace_id"] == "t" and row["metadata"] == {"s": "x", "n": "7", "o": '{"a":[1]}', "z": None}


def test_access_json_field_by_field(spark):
    records = spark.createDataFrame([
        ('{"timestamp":"2024-05-01 10:00:00","status_code":200,"response_size":"12","response_time":0.5}',),
        ('{"timestamp":"bad","status_code":"x","ip_address":null,"metadata":{"a":1}}',), ("{}",)], "value string")
    one, two, three = ingest.decode_access_logs(records, AS_OF).collect()
    assert (one["status_code"], one["response_size"], one["response_time"]) == (200, 12, 0.5)
    assert two["timestamp"] == datetime(2024, 5, 10) and two["status_code"] is None and two["ip_address"] is None
    assert three["timestamp"] is None


def test_topic_records_and_options(log):
    rows = topics.records(log.filter("id = 1"), "trace_id", "id", "level").collect()
    assert [tuple(r) for r in rows] == [("a", '{"id":1,"level":"ERROR"}')]
    raw = topics.raw_records(log.selectExpr("message as value").limit(1)).first()
    assert raw["key"] is None and raw["value"] == "boom"
    assert topics.read_options("h:1", "t", per_trigger=5) == {
        "kafka.bootstrap.servers": "h:1", "subscribe": "t", "startingOffsets": "earliest", "maxOffsetsPerTrigger": "5"}


def test_layout_helpers():
    assert layout.day_folder(None) == "date=__HIVE_DEFAULT_PARTITION__"


def scan_metric(df, name):
    df.collect()

    def find(node):
        if node.nodeName().startswith("Scan"):
            return node
        if node.nodeName() == "AdaptiveSparkPlan":
            return find(node.executedPlan())
        children = node.children()
        return next(filter(None, (find(children.apply(i)) for i in range(children.size()))), None)

    return find(df._jdf.queryExecution().executedPlan()).metrics().apply(name).value()


def test_time_bounds_and_lookups_skip_what_they_can(spark, tmp_path):
    path = str(tmp_path / "warm")
    rows = spark.range(40_000).selectExpr(
        "id", "timestamp_ntz'2024-05-01 00:00:00' + id * interval '5' second as timestamp",
        "md5(cast(id as string)) as trace_id", "'INFO' as level")
    saved = spark.conf.get("spark.sql.shuffle.partitions")
    spark.sparkContext._jsc.hadoopConfiguration().set("parquet.block.size", "60000")
    spark.sparkContext._jsc.hadoopConfiguration().set("parquet.page.size", "4000")
    try:
        warm.append_events(rows, path)
    finally:
        spark.sparkContext._jsc.hadoopConfiguration().unset("parquet.block.size")
        spark.sparkContext._jsc.hadoopConfiguration().unset("parquet.page.size")
        spark.conf.set("spark.sql.shuffle.partitions", saved)
    table = spark.read.parquet(path)
    hour = filters.select_events(table, start="2024-05-02 10:00:00", end="2024-05-02 10:59:59")
    assert hour.count() == 720
    assert scan_metric(hour, "numFiles") == 1
    assert scan_metric(hour, "numOutputRows") < 10_000  # of 17,280 of that day
    found = table.filter(F.col("trace_id") == "a1d0c6e83f027327d8461063f4ac58a6")  # md5 of 42
    assert [r["id"] for r in found.collect()] == [42]
    assert scan_metric(found, "numOutputRows") < 20_000
