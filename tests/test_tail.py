"""Growing files by seeking: ranges, appended, truncated and replaced files, rounds and a stream."""

import random

import pytest
from pyspark.sql import functions as F

from logloom.sources import tail
from logloom.sources.collector import collect_round


def by_hand(data, begin=0):
    found, at = [], 0
    for line in data.split(b"\n"):
        if line and at >= begin:
            found.append((at, line.removesuffix(b"\r").decode()))
        at += len(line) + 1
    return found


def read(spark, before, now, split=tail.SPLIT_BYTES):
    rows = tail.read_between(spark, before, now, split).where("byte_length > 0").collect()
    return sorted((r["file_offset"], r["content"]) for r in rows), sum(r["read_bytes"] for r in rows)


@pytest.mark.parametrize("split", [1, 7, 64, 1000, 1 << 20])
def test_any_split_gives_each_line_once(tmp_path, split, monkeypatch):
    monkeypatch.setattr(tail, "READ_BYTES", 50)
    rng = random.Random(split)
    data = b"\n".join(rng.choice([b"", b"x", "é".encode() * 9, b"line\r", b"y" * 170]) for _ in range(150))
    for number, content in enumerate((data, data + b"\n", b"\n\n", b"one", b"\xef\xbb\xbfab\ncd")):
        path = str(tmp_path / f"{number}.log")
        (tmp_path / f"{number}.log").write_bytes(content)
        for begin in (0, len(content) // 3):
            parts = tail.ranges({path: [begin, 0, 0]} if begin else {}, {path: [len(content), 0, 0]}, split)
            rows = [row for part in parts for batch in tail.read_part(part) for row in batch.to_pylist()]
            got = sorted((r["file_offset"], r["content"]) for r in rows if r["byte_length"])
            expected = by_hand(content)
            if content.startswith(b"\xef\xbb\xbf"):
                expected = [(at + 3, line[1:]) if not at else (at, line) for at, line in expected]
            if begin:  # the line that was read in part comes again, whole
                line = content.rfind(b"\n", 0, begin) + 1 if content[begin : begin + 1] != b"\n" else begin + 1
                expected = [row for row in expected if row[0] >= line]
            assert got == expected


def test_only_new_bytes_are_read(spark, tmp_path):
    log, path = tmp_path / "a.log", str(tmp_path / "a.log")
    log.write_bytes(b"old line\n" * 200_000)
    first = tail.marks_now([str(tmp_path)], "*.log", {}, whole_lines=True)
    assert read(spark, {}, first)[1] == 1_800_000
    with log.open("ab") as file:
        file.write(b"one\ntwo\nthr")
    second = tail.marks_now([str(tmp_path)], "*.log", first, whole_lines=True)
    assert second[path][0] == 1_800_008  # not the line that is still being written
    lines, bytes_read = read(spark, first, second)
    assert lines == [(1_800_000, "one"), (1_800_004, "two")] and bytes_read <= 11
    with log.open("ab") as file:
        file.write(b"ee\n")
    third = tail.marks_now([str(tmp_path)], "*.log", second, whole_lines=True)
    assert read(spark, second, third)[0] == [(1_800_008, "three")]
    assert tail.ranges(third, tail.marks_now([str(tmp_path)], "*.log", third, whole_lines=True), 10) == []
    log.write_bytes(b"other\n" * 400_000)  # longer than before, and another file
    fourth = tail.marks_now([str(tmp_path)], "*.log", third, whole_lines=True)
    assert len(read(spark, third, fourth, 100_000)[0]) == 400_000


def test_many_small_files_share_a_task(tmp_path):
    for number in range(50):
        (tmp_path / f"{number}.log").write_bytes(b"x\n" * number)
    (tmp_path / "_hidden").mkdir()
    (tmp_path / "_hidden/a.log").write_bytes(b"x\n")
    now = tail.marks_now([f"file:{tmp_path}"], "*.log", {}, whole_lines=True)
    assert len(now) == 50
    parts = tail.ranges({}, now, tail.SPLIT_BYTES)
    assert len(parts) == 1 and len(parts[0].ranges) == 49


def test_rounds_read_on_where_they_ended(spark, tmp_path):
    logs, store = tmp_path / "logs", str(tmp_path / "store")
    logs.mkdir()
    (logs / "a.log").write_bytes(b"one\ntwo\nthr")
    (logs / "b.log").write_bytes(b"still\n")

    def round_(minute):
        return sorted(r["content"] for r in collect_round(spark, str(logs), store, f"2024-06-01 10:{minute}:00").collect())

    assert round_("00") == ["one", "still", "thr", "two"]
    assert round_("01") == []
    (logs / "a.log").write_bytes(b"one\ntwo\nthree\nfour\n")
    assert round_("02") == ["four", "three"]
    (logs / "a.log").write_bytes(b"new\n")
    assert round_("03") == ["new"]
    assert round_("04") == []
    (logs / "b.log").write_bytes(b"still\nmore\n")
    assert round_("05") == ["more"]
    commits = spark.read.parquet(f"{store}/commits/round=5").collect()
    assert sorted((r["file_path"].rsplit("/")[-1], r["committed_offset"]) for r in commits) == [("a.log", 3), ("b.log", 10)]


def test_stream_over_growing_truncated_and_replaced_files(spark, tmp_path):
    logs, out, checkpoint = tmp_path / "logs", str(tmp_path / "out"), str(tmp_path / "checkpoint")
    logs.mkdir()

    def run():
        lines = tail.tail_stream(spark, str(logs), split_bytes=40)
        (lines.writeStream.format("parquet").option("path", out).option("checkpointLocation", checkpoint)
         .trigger(availableNow=True).start().awaitTermination())
        return sorted(r["content"] for r in spark.read.parquet(out).collect())

    (logs / "a.log").write_bytes(b"".join(b"a%d\n" % k for k in range(30)) + b"par")
    got = run()
    assert got == sorted(f"a{k}" for k in range(30))
    with (logs / "a.log").open("ab") as file:
        file.write(b"tial\nnext\n")
    (logs / "b.log").write_bytes(b"b0\n\nb1\n")
    got += ["partial", "next", "b0", "b1"]
    assert run() == sorted(got)
    assert run() == sorted(got)
    (logs / "a.log").write_bytes(b"short\n")
    (logs / "b.log").write_bytes(b"c0\nc1\nc2\nc3\n")
    got += ["short", "c0", "c1", "c2", "c3"]
    assert run() == sorted(got)
    assert spark.read.parquet(out).where(F.col("file_offset") < 0).isEmpty()
