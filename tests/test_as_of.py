"""Locations as of an event's own time, and percentiles from merged sketches, against plain loops."""

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from logloom.operators import joins, sketches

START = datetime(2024, 3, 1)


def at(hours):
    return None if hours is None else START + timedelta(hours=hours)


def by_hand(events, locations):
    found = {}
    for number, address, hours in events:
        known = [(h, name) for a, h, name in locations if None not in (a, h, hours) and a == address and h <= hours]
        newest = max(known, default=None)
        found[number] = newest[1] if newest and newest[0] >= hours - 24 * joins.LOCATION_DAYS else None
    return found


@pytest.mark.parametrize("block_rows", [1, 7, 50, 100_000])
def test_location_as_of_against_a_loop(spark, block_rows):
    pick = random.Random(block_rows)
    addresses = ["hot"] * 8 + ["a", "b", None, "never"]
    events = [(k, pick.choice(addresses), pick.choice([None, *range(0, 900)]) if k % 9 == 0 else pick.randrange(900)) for k in range(400)]
    locations = [(pick.choice(["hot", "hot", "a", "b", None]), pick.choice([*range(0, 300), *range(700, 760)]), f"place {pick.randrange(9)}") for _ in range(60)]
    locations += [("hot", 500, "twice"), ("hot", 500, "also"), ("a", None, "no time")]
    left = spark.createDataFrame([(k, a, at(h), "x") for k, a, h in events], "id bigint, ip_address string, timestamp timestamp_ntz, _row string")
    right = spark.createDataFrame([(a, at(h), name) for a, h, name in locations], "ip_address string, cached_at timestamp_ntz, location string")
    found = joins.location_as_of(left, right, block_rows=block_rows)
    assert found.columns == ["id", "ip_address", "timestamp", "_row", "location"]
    assert {r["id"]: r["location"] for r in found.collect()} == by_hand(events, locations)
    assert found.where("_row = 'x'").count() == 400
    assert joins.location_as_of(left, right.limit(0)).where("location is not null").isEmpty()
    assert joins.location_as_of(left.limit(0), right).isEmpty()


def test_sketches_rolled_up_are_close_to_exact_ranks(spark):
    pick = random.Random(1)
    rows = [(START + timedelta(seconds=pick.randrange(2 * 86_400)), pick.lognormvariate(3, 1)) for _ in range(40_000)] + [(START, None), (None, 5.0)]
    table = spark.createDataFrame(rows, "timestamp timestamp_ntz, response_time double").repartition(9)
    small = sketches.latency_sketches(table)
    assert small.count() == 2 * 288
    days = sketches.sketch_percentiles(sketches.rolled_up(sketches.rolled_up(small, 3600), 86_400), (0.1, 0.5, 0.99)).collect()
    assert sorted(r["window_start"] for r in days) == [START, START + timedelta(days=1)]
    for day in days:
        own = sorted(v for t, v in rows if t and v is not None and t.date() == day["window_start"].date())
        assert day["calls"] == len(own)
        for share, value in ((0.1, day["p10"]), (0.5, day["p50"]), (0.99, day["p99"])):
            assert abs(sum(v <= value for v in own) / len(own) - share) < 0.01
    assert sketches.latency_sketches(table.where(F.lit(False))).isEmpty()
