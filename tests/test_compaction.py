"""Merged batch folders hold every row once, whatever step a merge breaks off at."""

import pytest
from pyspark.sql import functions as F

from logloom.sinks import compaction, layout, tiers, warm

AS_OF = "2024-05-10 12:00:00"


def events_of(spark, numbers):
    return spark.createDataFrame([(n, "ERROR", f"2024-05-{9 + n % 2:02} 10:00:{n % 60:02}" if n % 7 else None, f"t{n % 5}") for n in numbers],
                                 "id bigint, level string, time string, trace_id string").selectExpr(
        "id", "level", "cast(time as timestamp_ntz) as timestamp", "trace_id")


def fill(spark, path, batches):
    for number in range(batches):
        warm.append_events(events_of(spark, range(number * 10, number * 10 + 10)), path, number)


def held(spark, path):
    return sorted(r["id"] for r in compaction.stored(spark, path).collect())


def folders(spark, path):
    return {(str(r["date"]), r["batch"]) for r in spark.read.parquet(path).select("date", "batch").distinct().collect()}


class Broken(Exception):
    pass


def breaking(monkeypatch, name, after):
    """Let the function of the module work ``after`` times and then fail."""
    real, calls = getattr(compaction, name), []

    def run(*args):
        calls.append(1)
        if len(calls) > after:
            raise Broken
        return real(*args)

    monkeypatch.setattr(compaction, name, run)


@pytest.mark.parametrize(("name", "after"), [("move_folder", 0), ("move_folder", 1), ("drop_partitions", 0), ("drop_partitions", 1), ("drop_partitions", 3)])
def test_a_merge_that_breaks_off_is_finished_by_the_next(spark, tmp_path, monkeypatch, name, after):
    path = str(tmp_path / "warm")
    fill(spark, path, 6)
    with monkeypatch.context() as broken:
        breaking(broken, name, after)
        with pytest.raises(Broken):
            compaction.compact_warm(spark, path, 5)
    assert held(spark, path) == list(range(60))
    warm.append_events(events_of(spark, range(60, 70)), path, 6)
    assert held(spark, path) == list(range(70))
    compaction.compact_warm(spark, path, 6)
    assert held(spark, path) == list(range(70)) == sorted(r["id"] for r in spark.read.parquet(path).collect())
    assert {batch for _, batch in folders(spark, path)} == {5, 6}
    assert not layout.list_folder(spark, f"{path}/{compaction.NOTES}") and not layout.list_folder(spark, f"{path}/{compaction.COPIES}")


def test_a_copy_without_note_is_undone(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "warm")
    fill(spark, path, 3)
    spark.range(5).withColumn("date", F.lit("2024-05-09")).write.partitionBy("date").parquet(f"{path}/{compaction.COPIES}/run1")
    assert held(spark, path) == list(range(30))
    assert compaction.compact_warm(spark, path, 1) is False
    assert not layout.list_folder(spark, f"{path}/{compaction.COPIES}")
    assert held(spark, path) == list(range(30))


def test_fewer_files_and_upsert_and_retention_go_on(spark, tmp_path):
    path = str(tmp_path / "warm")
    fill(spark, path, 8)
    before = len(spark.read.parquet(path).inputFiles())
    assert compaction.compact_warm(spark, path, 7)
    after = len(spark.read.parquet(path).inputFiles())
    assert before >= 3 * after
    assert [len(r["merged"]) for r in compaction.due_folders(spark, path, 8).collect()] == [2, 2, 2]
    changed = events_of(spark, [1, 2, 75]).withColumns({"level": F.lit("INFO"), "processed_at": F.lit(AS_OF).cast("timestamp_ntz")})
    warm.upsert_events(changed, path)
    stored = compaction.stored(spark, path)
    assert sorted(r["id"] for r in stored.where("level = 'INFO'").collect()) == [1, 2, 75] and stored.count() == 80
    expired = stored.where("timestamp < timestamp_ntz'2024-05-10 00:00:00'").count()
    assert warm.apply_retention(spark, path, "2024-05-11 00:00:00", days=1) == expired > 0
    assert compaction.stored(spark, path).count() == 80 - expired


def test_hot_tier_keeps_the_last_write(spark, tmp_path):
    base = str(tmp_path)
    for number, ids in enumerate(([5, 6], [10, 11], [15], [20])):
        rows = events_of(spark, ids).withColumn("timestamp", F.lit("2024-05-10 11:00:00").cast("timestamp_ntz"))
        tiers.store_batch(rows, base, AS_OF, number)

    def hot():
        return sorted(tiers.read_hot(spark, f"{base}/hot", AS_OF).selectExpr("get_json_object(document, '$.id') as id").toPandas().id)

    assert hot() == ["11", "20"]
    assert compaction.compact_hot(spark, f"{base}/hot", 3)
    assert spark.read.parquet(f"{base}/hot").count() == 3 and hot() == ["11", "20"]
    assert compaction.compact_cold(spark, f"{base}/cold", 4)
    lines = compaction.stored(spark, f"{base}/cold", ["level", "date"], "text")
    assert lines.count() == 6 and {r["batch"] for r in lines.collect()} == {3}
