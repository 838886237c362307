import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from logloom.functions import time
from logloom.operators import frames


@pytest.fixture(scope="module")
def skewed(spark):
    rng = random.Random(3)
    data = [(rng.choice(["hot"] * 20 + ["a", "b", None]), i, rng.randrange(100)) for i in range(5000)]
    rng.shuffle(data)
    return data, spark.createDataFrame(data, "k string, n int, v int").repartition(5)


def by_key(data):
    groups = {}
    for k, n, v in sorted(data, key=lambda r: r[1]):
        groups.setdefault(k, []).append((n, v))
    return groups


def test_positions_are_gapless_and_ordered(skewed):
    data, df = skewed
    got = frames.in_blocks(df, ["k"], ["n"], 100).collect()
    expected = sorted(data, key=lambda r: (r[0] is not None, r[0] or "", r[1]))
    assert {r["n"]: (r["_pos"], r["_home"]) for r in got} == {
        row[1]: (i, i // 100) for i, row in enumerate(expected)}


def test_a_hot_key_is_spread(spark, skewed, monkeypatch):
    _, df = skewed
    written, settle = [], frames.settle
    monkeypatch.setattr(frames, "settle", lambda rows: written.append(settle(rows)) or written[0])
    before = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        frames.positioned(df, ["k", "n"], "at")
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", before)
    parts = written[0].filter("k = 'hot'").groupBy("_part").count().collect()
    assert len(parts) >= 6 and max(r["count"] for r in parts) < 2000


@pytest.mark.parametrize("block", [10, 37, 100_000])
def test_over_last_rows(skewed, block):
    data, df = skewed
    got = frames.over_last_rows(
        df, ["k"], ["n"], 10, {"s": lambda w: F.sum("v").over(w), "c": lambda w: F.count("v").over(w)}, block)
    expected = {}
    for rows in by_key(data).values():
        for i, (n, _) in enumerate(rows):
            last = [v for _, v in rows[max(0, i - 9):i + 1]]
            expected[n] = (sum(last), len(last))
    assert {r["n"]: (r["s"], r["c"]) for r in got.collect()} == expected


@pytest.mark.parametrize("block", [13, 100_000])
def test_running_sum_before(spark, skewed, block):
    data, df = skewed
    before = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = frames.running_sum_before(df, ["k"], ["n"], F.col("v"), "before", block).collect()
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", before)
    expected = {}
    for rows in by_key(data).values():
        total = 0
        for n, v in rows:
            expected[n] = total
            total += v
    assert {r["n"]: r["before"] for r in got} == expected


def test_frame_longer_than_block_is_refused(skewed):
    with pytest.raises(ValueError):
        frames.over_last_rows(skewed[1], ["k"], ["n"], 10, {}, 9)


@pytest.mark.parametrize("zone", ["UTC", "America/New_York", "Asia/Kolkata"])
def test_epoch_seconds_do_not_depend_on_the_zone(spark, zone):
    moments = [datetime(1969, 12, 31, 23, 59, 59), datetime(2024, 3, 10, 2, 30), datetime(2024, 11, 3, 1, 30, 0, 5)]
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        df = spark.createDataFrame([(m.isoformat(),) for m in moments], "t string").selectExpr("cast(t as timestamp_ntz) t")
        rows = df.select(
            "t", time.epoch_seconds(F.col("t")).alias("e"),
            time.from_epoch_seconds(time.epoch_seconds(F.col("t"))).alias("back"),
            time.bucket_start(F.col("t"), 300).alias("b")).collect()
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
    for row in rows:
        seconds = (row["t"].replace(microsecond=0) - datetime(1970, 1, 1)) // timedelta(seconds=1)
        assert row["e"] == seconds and row["back"] == row["t"].replace(microsecond=0)
        assert row["b"] == datetime(1970, 1, 1) + timedelta(seconds=seconds // 300 * 300)
