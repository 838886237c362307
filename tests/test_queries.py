"""Filters, pages, search, statistics: bounds, nulls, unknown values, empty input."""

from datetime import datetime

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as driver
from logloom.functions import text
from logloom.operators import enrich, filters, joins, latest, paging, rolling, stats

T0 = "2024-05-01 10:00:00"


@pytest.fixture
def log(events_of):
    return events_of([
        (1, "ERROR", "auth", "Disk 100% full", "2024-05-01 09:00:00", "a"),
        (2, "WARN", "auth", "disk almost full", "2024-05-01 10:00:00", "b"),
        (3, "INFO", "user", "user_1 logged in", "2024-05-01 10:30:00", "c"),
        (4, "DEBUG", "user", "userX1 cache", "2024-05-01 11:00:00", "c"),
        (5, "TRACE", "user", None, "2024-05-01 11:00:00", None),
        (6, None, None, "no level", None, "d"),
        (7, "INFO", "pay", "ok", "2024-04-20 00:00:00", "e"),
    ])


def ids(df):
    return [r["id"] for r in df.select("id").collect()]


def test_between_is_inclusive_and_after_is_strict(log):
    assert sorted(ids(filters.between(log, T0, "2024-05-01 11:00:00"))) == [2, 3, 4, 5]
    assert sorted(ids(filters.select_events(log, after=T0))) == [3, 4, 5]
    assert sorted(ids(filters.by_source_after(log, "user", "2024-05-01 10:30:00"))) == [4, 5]


def test_every_given_condition_counts(log):
    assert sorted(ids(filters.select_events(log))) == [1, 2, 3, 4, 5, 6, 7]
    assert ids(filters.select_events(log, level="INFO", start=T0)) == [3]
    assert ids(filters.select_events(log, source="auth", keyword="ALMOST", end=T0)) == [2]
    assert ids(filters.select_events(log, trace_id="a")) == [1]


def test_search_takes_wildcards_literally_and_like_does_not(log):
    assert ids(filters.search(log, "100%")) == [1]
    assert ids(filters.search(log, "USER_1")) == [3]
    assert ids(filters.search(log, "0_")) == []
    assert sorted(ids(filters.like_after(log, "user_1", "2024-05-01 09:00:00"))) == [3, 4]
    assert ids(filters.like_after(log, "Disk", "2024-04-01")) == [1]


def test_cold_rule(log):
    assert sorted(ids(filters.cold_eligible(log, T0))) == [1, 2, 7]
    edge = filters.cold_eligible(log, "2024-04-27 00:00:00")
    assert sorted(ids(edge)) == [1, 2]  # exactly seven days old is not yet older


def test_day_partition_is_used_when_there_is_one(log):
    dated = log.withColumn("date", F.to_date("timestamp"))
    found = filters.between(dated, T0, "2024-05-01 11:00:00")
    assert sorted(ids(found)) == [2, 3, 4, 5]
    assert "date" in found._jdf.queryExecution().analyzed().toString().split("Filter")[1]


def test_pages(log):
    assert ids(paging.page_of(log, 0, 3)) == [4, 5, 3]
    assert ids(paging.page_of(log, 1, 3)) == [2, 1, 7]
    assert ids(paging.page_of(log, 2, 3)) == [6]
    assert ids(paging.page_of(log, 9, 3)) == []
    assert ids(paging.page_of(log, 0, 2, "source", "asc")) == [6, 1]
    first = paging.page_after(log, None, 3)
    assert ids(first) == [4, 5, 3]
    assert ids(paging.page_after(log, ("2024-05-01 11:00:00", 4), 2)) == [5, 3]
    assert paging.query_events(log, level="INFO").total.first()["total"] == 2
    assert ids(paging.search_events(log, "full", 1)) == [2]


def test_walk_holds_every_row_once_and_in_order(spark):
    """A hot level, ties of the sort column and a block without a level that each span many pages."""
    data = [(k * 7919 % 503, None if k % 3 == 0 else "HOT" if k % 5 else f"L{k % 4}") for k in range(503)]
    table = spark.createDataFrame(data, "id bigint, level string").repartition(5).cache()
    for direction in ("asc", "desc"):
        known = sorted((r for r in data if r[1] is not None), key=lambda r: r[0])
        known.sort(key=lambda r: r[1], reverse=direction == "desc")
        unknown = sorted(r for r in data if r[1] is None)
        expected = unknown + known if direction == "asc" else known + unknown
        for size in (61, 503):
            pages = list(paging.walk(table, size, "level", direction))
            assert [tuple(r) for page in pages for r in page] == expected
            assert [len(page) for page in pages] == [size] * (503 // size) + ([503 % size] if 503 % size else [])
    assert list(paging.walk(table.limit(0), 5, "level")) == []


def test_registered_walk_reads_the_whole_log(spark):
    found = driver.queries()["pages_walked_all"](spark, "/root/testdata/sf0.001").collect()
    log = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    assert sum(r.rows for r in found) == log.count()
    assert sum(r.ids for r in found) == log.agg({"event_id": "sum"}).first()[0]
    assert sum(r.rows for r in found if r.level is None) == log.where("event_id % 2 != 0").count()


def test_page_arguments_are_checked(log):
    for bad in ({"sort_by": "nope"}, {"direction": "sideways"}, {"page": -1}, {"size": 0}):
        with pytest.raises(ValueError):
            paging.page_of(log, **bad)


def test_level_stats_count_four_levels(log):
    row = stats.level_stats(log, "2024-05-01 12:00:00", since="2024-04-01").first().asDict()
    assert [row[f"{n}_count"] for n in ("error", "warn", "info", "debug")] == [1, 1, 2, 1]
    assert row["total_logs"] == 5 and row["all_levels"] == 6
    assert row["generated_at"] == datetime(2024, 5, 1, 12)
    assert stats.level_stats(log, "2024-05-02 10:00:00").first()["total_logs"] == 2  # strictly after since


def test_empty_input(log, spark):
    none = log.limit(0)
    assert stats.level_stats(none, T0).first()["total_logs"] == 0
    assert stats.organization_level_counts(none.withColumn("organization_id", F.lit("x"))).isEmpty()
    assert stats.event_rate(none).isEmpty() and stats.sliding_event_rate(none).isEmpty()
    row = stats.duration_stats(none.withColumn("d", F.lit(1.0)), "d").first()
    assert row["calls"] == 0 and row["total_time"] is None and row["mean_time"] is None
    lines = none.selectExpr("timestamp", "'apache' as log_format", "1 as status_code", "1.0D as response_time")
    assert stats.status_counts(lines).isEmpty() and stats.hourly_counts(lines, T0).isEmpty()
    assert stats.latency_percentiles(lines).isEmpty() and stats.histogram_quantiles(lines, [1.0]).isEmpty()
    assert stats.parse_pipeline_stats(lines).first().asDict() == {"received": 0, "processed": 0, "sent_to_dlq": 0}
    assert paging.total_of(none).first()["total"] == 0 and ids(paging.page_of(none)) == []


def test_null_status_is_a_group(spark):
    df = spark.createDataFrame([(200,), (200,), (None,)], "status_code int")
    assert {tuple(r) for r in stats.status_counts(df).collect()} == {(200, 2), (None, 1)}


def test_percentiles_by_hand(spark):
    df = spark.createDataFrame([(i / 10,) for i in range(1, 12)], "response_time double").withColumn(
        "timestamp", F.lit(T0).cast("timestamp_ntz"))
    row = stats.latency_percentiles(df).first()
    assert (row["calls"], row["p50"]) == (11, 0.6) and row["p95"] == pytest.approx(1.05)
    near = stats.latency_percentiles_approx(df).first()
    assert near["p50"] == 0.6
    quantiles = stats.histogram_quantiles(df, [0.5, 1.0]).first()
    assert quantiles["p50"] == pytest.approx(0.5 + 0.5 * 0.5 / 5) and quantiles["p95"] == 1.0


def test_upsert_is_idempotent_and_last_write_wins(spark, rows):
    old = spark.createDataFrame([(1, "a", 1), (2, "b", 5), (3, "c", 1)], "id int, v string, processed_at int")
    new = spark.createDataFrame([(1, "A", 2), (2, "B", 4), (3, "C", 1), (4, "D", 1)], "id int, v string, processed_at int")
    once = latest.upsert(old, new)
    assert rows(once) == rows(latest.upsert(once, new)) == [(1, "A", 2), (2, "b", 5), (3, "C", 1), (4, "D", 1)]


def test_latest_prunes_before_the_shuffle(log):
    plan = latest.newest(log, ["source"])._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan


def test_hot_then_warm(log, spark, rows):
    hot = joins.hot_view(log, "2024-05-01 12:00:00")
    assert sorted(r["id"] for r in hot.collect()) == [1, 2, 4]
    keys = spark.createDataFrame([("c",), ("e",), ("e",), ("zzz",), ("d",)], "trace_id string")
    found = joins.lookup_hot_then_warm(keys, hot, log)
    assert rows(found, "trace_id", "id", "tier") == [("c", 4, "hot"), ("d", 6, "warm"), ("e", 7, "warm")]


def test_duplicate_trace_ids_give_the_newest_and_a_count(log, rows):
    found = joins.newest_with_copies(log.filter("trace_id = 'c'"))
    assert rows(found, "id", "copies") == [(4, 2)]


def test_metadata_there_and_back(spark, rows):
    events = spark.createDataFrame(
        [(1, {"a": "x", "b": None}), (2, {}), (3, None)], "id int, metadata map<string,string>")
    children = joins.explode_metadata(events)
    assert rows(children) == [(1, "a", "x"), (1, "b", None)]
    doubled = children.unionByName(children).unionByName(
        spark.createDataFrame([(1, "a", "w"), (1, "a", None), (1, "b", None)], children.schema))
    whole = {r["id"]: r["metadata"] for r in joins.assemble_metadata(events.select("id"), doubled).collect()}
    assert whole == {1: {"a": "x", "b": None}, 2: None, 3: None}
    assert rows(joins.cascade(children, events.filter("id > 1"))) == []


def test_locations_expire(spark, rows):
    places = spark.createDataFrame(
        [("1.1.1.1", "old", "2024-04-20"), ("2.2.2.2", "a", "2024-04-29"), ("2.2.2.2", "b", "2024-04-30")],
        "ip_address string, location string, at string").selectExpr(
        "ip_address", "location", "cast(at as timestamp_ntz) as cached_at")
    seen = spark.createDataFrame([("1.1.1.1",), ("2.2.2.2",), (None,)], "ip_address string")
    found = joins.add_location(seen, joins.live_locations(places, T0))
    assert rows(found) == [("1.1.1.1", None), ("2.2.2.2", "b"), (None, None)]


def test_system_stats_without_a_service(spark):
    df = spark.createDataFrame([("a", "events", 5)], "service string, metric string, value bigint")
    assert joins.system_stats(df, ["a", "b"], "events").first().asDict() == {"a": "5", "b": "unavailable"}
    assert joins.system_stats(df.limit(0), ["a"], "events").first().asDict() == {"a": "unavailable"}


def test_defaults(spark):
    df = spark.createDataFrame([("x", None), (None, "t")], "id string, trace_id string").withColumn(
        "timestamp", F.lit(None).cast("timestamp_ntz"))
    one, two = enrich.prepare_events(df, T0).orderBy(F.col("trace_id") == "t").collect()
    assert one["id"] == "x" and len(one["trace_id"]) == 36
    assert two["trace_id"] == "t" and len(two["id"]) == 36
    assert one["timestamp"] == two["timestamp"] == datetime(2024, 5, 1, 10)


def test_text_functions(spark):
    df = spark.range(1).select(
        text.string_hash32(F.lit("hello")).alias("h"), text.string_hash32(F.lit("")).alias("e"),
        text.string_hash32(F.lit("polygenelubricants")).alias("n"),
        text.size_in_bytes(F.lit("100MB")).alias("mb"), text.size_in_bytes(F.lit("7")).alias("b"),
        text.size_in_bytes(F.lit("7TB")).alias("bad"), text.preview(F.lit("x" * 80)).alias("p"),
        text.not_blank(F.lit(" \t\r")).alias("blank"), text.not_blank(F.lit(" a ")).alias("full"),
        text.dash_to_null(F.lit("-")).alias("dash"))
    row = df.first()
    assert (row["h"], row["e"], row["n"]) == (99162322, 0, -2147483648)
    assert (row["mb"], row["b"], row["bad"]) == (104857600, 7, None)
    assert len(row["p"]) == 50 and row["blank"] is False and row["full"] is True and row["dash"] is None
    assert text.parse_size("1GB") == 2 ** 30
    with pytest.raises(ValueError):
        text.parse_size("much")


def test_bad_calls_by_hand(spark):
    outcome = [1, 0, 1, 1, 0, 0, 0, 0, 0, 0, 0, 1, 1, 1, 1, 1]
    calls = spark.createDataFrame([(i, "a", bool(b)) for i, b in enumerate(outcome)], "id int, instance string, failed boolean")
    for block in (10, 11, 1000):
        got = rolling.failure_rate(calls, order=["id"], block_rows=block).orderBy("id").collect()
        for i, row in enumerate(got):
            last = outcome[max(0, i - 9):i + 1]
            assert (row["calls"], row["bad_calls"]) == (len(last), sum(last))
            assert row["tripped"] == (len(last) >= 5 and sum(last) / len(last) >= 0.5)


def test_counter_delta_starts_at_zero(spark, rows):
    ticks = spark.createDataFrame([("a", 1, 10), ("a", 2, 25), ("a", 3, 25), ("b", 2, 7)], "instance_id string, tick int, total int")
    assert rows(rolling.counter_delta(ticks), "instance_id", "tick", "rate") == [
        ("a", 1, 10), ("a", 2, 15), ("a", 3, 0), ("b", 2, 7)]


def test_sliding_window_crosses_spans(spark):
    base = 1714557600  # on a span boundary
    offsets = [-70, -59, -58, -1, 0, 0, 1, 59, 60, 61, 3599, 3600, 3601, 7300]
    df = spark.createDataFrame([(i, "k", base + o) for i, o in enumerate(offsets)], "id int, k string, s bigint").selectExpr(
        "id", "k", "cast(timestamp_seconds(s) as timestamp_ntz) as timestamp", "s")
    for window in (1, 60, 3600, 5000):
        got = rolling.sliding_window_requests(df, "k", window, 2).collect()
        for row in got:
            expected = sum(row["s"] - window < base + o <= row["s"] for o in offsets)
            assert (row["in_window"], row["limited"]) == (expected, expected > 2)


def test_only_admitted_requests_fill_the_window(spark):
    offsets = sorted([0, 0, 0, 5, 9, 10, 11, 11, 14, 30, 45, 45, 45, 45, 46, 60])
    df = spark.createDataFrame([("k", o) for o in offsets] + [(None, 1)], "k string, o int").selectExpr(
        "k", "timestamp_ntz'2024-05-01 10:59:50' + o * interval '1' second as timestamp")
    admitted, found = [], {}
    for o in offsets:
        fits = sum(o - 10 < a <= o for a in admitted) < 3
        admitted += [o] * fits
        found[o] = found.get(o, 0) + fits
    rows = rolling.sliding_window_admitted(df, "k", 10, 3).orderBy("second").collect()
    assert [r["admitted"] for r in rows] == list(found.values())
    assert sum(r["requests"] for r in rows) == len(offsets)
