import random
from collections import defaultdict
from datetime import datetime, timedelta

import numpy as np
import pytest
from pyspark.sql import functions as F

from logloom.operators import chains, dedup

START = datetime(2024, 3, 1)


def frame(spark, data):
    """data: (id, hash, seconds)"""
    return spark.createDataFrame(
        [(i, h, None if s is None else START + timedelta(seconds=s), {"n": str(i)}) for i, h, s in data],
        "id bigint, content_hash string, timestamp timestamp_ntz, metadata map<string,string>")


def kept_by_hand(data, ttl):
    last, kept = {}, []
    for i, h, s in sorted(data, key=lambda r: (r[2], r[0])):
        if h not in last or s >= last[h] + ttl:
            last[h] = s
            kept.append(i)
    return sorted(kept)


def test_life_time_runs_from_the_kept_row(spark):
    df = frame(spark, [(n, "a", m * 60) for n, m in enumerate([0, 20, 40, 45, 71])])
    zoned = df.withColumn("timestamp", F.col("timestamp").cast("timestamp"))
    for rows, limit in ((df, 100), (df, 1), (zoned, 100), (zoned, 1)):
        found = dedup.drop_repeats(rows, block_rows=limit)
        assert sorted(r["id"] for r in found.collect()) == [0, 2, 4]


@pytest.mark.parametrize("limit", [1, 12, 10_000])
@pytest.mark.parametrize("seed", [1, 2])
def test_random_rows_against_brute_force(spark, limit, seed):
    rng = random.Random(seed)
    data = [(i, rng.choice("aaaaaabbbcd") + str(rng.randrange(3)), rng.randrange(0, 6000)) for i in range(400)]
    data += [(1000 + i, "alone", 100) for i in range(5)]
    found = dedup.drop_repeats(frame(spark, data), ttl_seconds=600, block_rows=limit)
    assert sorted(r["id"] for r in found.collect()) == kept_by_hand(data, 600)
    assert found.filter(F.col("metadata")["n"] != F.col("id").cast("string")).isEmpty()


def test_one_hash_holding_all_rows(spark):
    data = [(i, "hot", i * 7 % 5003) for i in range(3000)]
    found = dedup.drop_repeats(frame(spark, data), ttl_seconds=60, block_rows=50)
    assert sorted(r["id"] for r in found.collect()) == kept_by_hand(data, 60)


@pytest.mark.parametrize("limit", [1, 100])
def test_rows_that_cannot_be_judged_are_kept(spark, limit):
    df = frame(spark, [(1, None, 0), (2, None, 1), (3, "a", None), (4, "a", None), (5, "a", 0), (6, "a", 1)])
    found = dedup.drop_repeats(df, block_rows=limit)
    assert sorted(r["id"] for r in found.collect()) == [1, 2, 3, 4, 5]


@pytest.mark.parametrize("limit", [1, 100])
def test_identical_copies_keep_one(spark, limit):
    df = frame(spark, [(1, "a", 0)] * 4 + [(None, "b", 5)] * 3)
    assert dedup.drop_repeats(df, block_rows=limit).count() == 2


def test_empty_input(spark):
    assert dedup.drop_repeats(frame(spark, [])).isEmpty()
    assert dedup.anchored_window_report(frame(spark, []), "content_hash").isEmpty()


def test_batches_equal_one_run(spark):
    rng = random.Random(5)
    data = [(i, rng.choice("abc"), s) for i, s in enumerate(sorted(rng.randrange(0, 9000) for _ in range(200)))]
    seen = frame(spark, []).select("content_hash", "timestamp")
    kept = []
    for low in range(0, 9000, 1500):
        batch = frame(spark, [r for r in data if low <= r[2] < low + 1500])
        out = dedup.drop_seen(batch, seen, ttl_seconds=700)
        rows = out.collect()
        kept += [r["id"] for r in rows]
        seen = dedup.remember(seen, out, START + timedelta(seconds=low + 1499), ttl_seconds=700)
        seen = spark.createDataFrame(seen.collect(), "content_hash string, timestamp timestamp_ntz")
    assert sorted(kept) == kept_by_hand(data, 700)


@pytest.mark.parametrize("limit", [1, 10_000])
def test_anchored_windows_against_brute_force(spark, limit):
    rng = random.Random(9)
    data = [(i, rng.choice("xxxy"), rng.randrange(0, 4000)) for i in range(500)]
    opened, counts = {}, defaultdict(int)
    for _, client, s in sorted(data, key=lambda r: r[2]):
        if client not in opened or s >= opened[client] + 60:
            opened[client] = s
        counts[client, opened[client]] += 1
    report = dedup.anchored_window_report(frame(spark, data), "content_hash", 60, 4, block_rows=limit).collect()
    found = {(r["content_hash"], int((r["window_start"] - START).total_seconds())):
             (r["requests"], r["allowed"], r["rejected"]) for r in report}
    assert found == {k: (n, min(n, 4), max(n - 4, 0)) for k, n in counts.items()}
    admitted = dedup.anchored_window_admitted(frame(spark, data), "content_hash", 60, 4, block_rows=limit)
    assert admitted.count() == sum(min(n, 4) for n in counts.values())


def test_the_block_size_changes_no_row(spark):
    """Rows of one hash, time and id that differ in content: the same one stays whatever the block."""
    df = spark.createDataFrame([("h", START, 1, c) for c in "cab"] + [("h", START + timedelta(seconds=k), 1, "z") for k in range(200)],
                               "content_hash string, timestamp timestamp_ntz, id bigint, content string")
    found = {size: sorted(map(tuple, dedup.drop_repeats(df, ttl_seconds=7, block_rows=size).collect())) for size in (1, 5, 1000)}
    assert found[1] == found[5] == found[1000]
    assert found[1][0][3] == "a"


def test_late_rows_are_no_repeats(spark):
    seen = frame(spark, [(0, "a", 20_000)]).select("content_hash", "timestamp")
    found = dedup.drop_seen(frame(spark, [(1, "a", 100), (2, "a", 200), (3, "a", 20_100), (4, "a", 30_000)]), seen)
    assert sorted(r["id"] for r in found.collect()) == [1, 4]


def test_chains_of_many_keys_in_small_batches(spark):
    """Keys whose times cross the borders of Arrow batches, as many keys as rows among them."""
    rng = random.Random(11)
    data = [(i, f"k{rng.randrange(40)}" if i % 3 else f"alone{i}", rng.randrange(0, 9000)) for i in range(2500)]
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        for limit in (1, 20, 10_000):
            found = dedup.drop_repeats(frame(spark, data), ttl_seconds=500, block_rows=limit)
            assert sorted(r["id"] for r in found.collect()) == kept_by_hand(data, 500)
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)


def test_kernels_against_single_steps():
    rng = np.random.default_rng(3)
    for _ in range(200):
        sizes = rng.integers(1, 12, rng.integers(1, 9))
        heads = np.concatenate([[0], np.cumsum(sizes)[:-1]])
        times = np.concatenate([np.sort(rng.integers(-50, 50, n)) for n in sizes])
        ttl, earliest = int(rng.integers(1, 30)), rng.integers(-60, 60, len(sizes))
        kept, from_entry, exits = [], [], []
        for head, size, entry in zip(heads, sizes, earliest, strict=True):
            own = times[head : head + size]
            for into, begin in ((kept, -(10**9)), (from_entry, entry)):
                for k, t in enumerate(own):
                    if t >= begin:
                        into.append(head + k)
                        begin = t + ttl
            for t in own:
                while len(later := own[own >= t + ttl]):
                    t = later[0]
                exits.append(t + ttl)
        assert chains.kept_of(heads, times, ttl).tolist() == kept
        assert chains.kept_of(heads, times, ttl, earliest).tolist() == from_entry
        assert chains.exits_of(heads, times, ttl).tolist() == exits


def test_keys_with_short_spans_never_reach_python(spark):
    """Distinct hashes are settled by one aggregate."""
    data = [(i, f"h{i}", i) for i in range(300)] + [(1000 + i, f"h{i}", i + 5) for i in range(300)]
    found = dedup.drop_repeats(frame(spark, data), ttl_seconds=60)
    assert "MapInArrow" not in found._jdf.queryExecution().executedPlan().toString()
    assert sorted(r["id"] for r in found.collect()) == list(range(300))


@pytest.mark.parametrize("limit", [20, 10_000])
def test_chains_stay_whole_when_a_join_is_turned_into_a_broadcast_join(spark, tmp_path, limit):
    """Then Spark reads a shuffle by its writers; a chain of each writer's times would keep too much."""
    data = [(i, "ab"[i % 2], i * 7 % 5003) for i in range(1200)]
    for part in range(4):
        frame(spark, [r for r in data if r[0] // 2 % 4 == part]).coalesce(1).write.parquet(f"{tmp_path}/in/part={part}")
    settings = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "10m",
                "spark.sql.adaptive.coalescePartitions.enabled": "false", "spark.sql.files.maxPartitionBytes": "4k", "spark.sql.files.openCostInBytes": "4k"}
    for name, value in settings.items():
        spark.conf.set(name, value)
    try:
        rows = spark.read.parquet(f"{tmp_path}/in").drop("part")
        found = sorted(r["id"] for r in dedup.drop_repeats(rows, ttl_seconds=60, block_rows=limit).collect())
    finally:
        for name in settings:
            spark.conf.unset(name)
    assert found == kept_by_hand(data, 60)
