"""Columns of the caller that are called like a helper of the library come back unchanged."""

from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from logloom.operators import dedup, frames, latest, paging, rolling

HELPERS = ["_at", "_AT_", "_rank", "_last", "_bucket", "_n", "_bad", "_first", "_late", "_pos", "_home", "_block", "_v", "_key", "_local", "_before",
           "_place", "_part", "_start", "_slice", "_rows", "_entry", "_exit", "_second", "_position", "_task", "_sum", "_b"]
START = datetime(2024, 3, 1)


@pytest.fixture(scope="module")
def rows(spark):
    data = [(k, f"h{k % 3}", START + timedelta(seconds=97 * k), k % 4 == 0, float(k % 9)) for k in range(60)]
    frame = spark.createDataFrame(data, "id bigint, content_hash string, timestamp timestamp_ntz, failed boolean, duration double")
    return frame.withColumns({name: F.concat(F.lit(name), F.col("id").cast("string")) for name in HELPERS}).cache()


OPERATORS = {
    "drop_repeats": lambda df: dedup.drop_repeats(df, ttl_seconds=300),
    "drop_repeats in blocks": lambda df: dedup.drop_repeats(df, ttl_seconds=300, block_rows=4),
    "drop_seen": lambda df: dedup.drop_seen(df, df.where("id < 3").select("content_hash", "timestamp"), ttl_seconds=300),
    "anchored_window_admitted": lambda df: dedup.anchored_window_admitted(df, "content_hash", 600, 2),
    "anchored, long limit": lambda df: dedup.anchored_window_admitted(df, "content_hash", 600, 2000),
    "fixed_window_admitted": lambda df: rolling.fixed_window_admitted(df, "content_hash", 600, 2),
    "fixed, long limit": lambda df: rolling.fixed_window_admitted(df, "content_hash", 600, 2000),
    "newest": lambda df: latest.newest(df, ["content_hash"], tie="id"),
    "upsert": lambda df: latest.upsert(df.where("id < 30"), df.where("id >= 20"), version="timestamp"),
    "failure_rate": lambda df: rolling.failure_rate(df, instance="content_hash", block_rows=20),
    "slow_call_rate": lambda df: rolling.slow_call_rate(df, instance="content_hash"),
    "counter_delta": lambda df: rolling.counter_delta(df, "content_hash", "timestamp", "duration"),
    "running_sum_before": lambda df: frames.running_sum_before(df, ["content_hash"], ["id"], F.col("id"), "sum"),
    "sliding_window_requests": lambda df: rolling.sliding_window_requests(df, "content_hash", 600, 3),
    "numbered_pages": lambda df: paging.numbered_pages(df, 7),
}


@pytest.mark.parametrize("name", OPERATORS)
def test_helpers_of_the_caller_stay(rows, name):
    found = OPERATORS[name](rows).collect()
    plain = OPERATORS[name](rows.drop(*HELPERS)).collect()
    assert found and all(row[helper] == f"{helper}{row['id']}" for row in found for helper in HELPERS)
    own = [c for c in plain[0].asDict()]
    assert sorted(repr([row[c] for c in own]) for row in found) == sorted(repr([row[c] for c in own]) for row in plain)


def test_anchored_report_with_helper_names(rows):
    report = dedup.anchored_window_report(rows, "_at", 600, 2)
    assert report.count() == 60


def test_long_rank_limits_are_cut_before_the_shuffle(spark):
    table = spark.range(20_000, numPartitions=6).selectExpr("id", "'hot' as k", "id * 7919 % 20011 as o")
    found = latest.first_of_each(table, ["k"], ["o"], 1500)
    assert sorted(r["o"] for r in found.collect()) == sorted(k * 7919 % 20011 for k in range(20_000))[:1500]
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert plan.count("row_number") >= 2


@pytest.mark.parametrize("direction", ["asc", "desc"])
def test_page_numbers_are_those_of_pages(spark, direction):
    data = [(k * 7919 % 103, None if k % 3 == 0 else f"L{k % 4}") for k in range(103)]
    table = spark.createDataFrame(data, "id bigint, level string").repartition(5).cache()
    pages = {r["id"]: r["page"] for r in paging.numbered_pages(table, 20, "level", direction).collect()}
    for number in range(6):
        assert {r["id"] for r in paging.page_of(table, number, 20, "level", direction).collect()} == {k for k, page in pages.items() if page == number}
