import random

import pytest

from logloom.operators.enrich import stamp_file_event
from logloom.sources import files

AS_OF = "2024-06-01 12:00:00"


def by_hand(data: bytes):
    """(offset, text) of every line that is not blank."""
    found, at = [], 0
    for line in data.split(b"\n"):
        text = line.removesuffix(b"\r").decode()
        if text.strip(" \t\r"):
            found.append((at, text))
        at += len(line) + 1
    return found


@pytest.fixture
def small_splits(spark):
    saved = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    spark.conf.set("spark.sql.files.maxPartitionBytes", "1000")
    spark.conf.set("spark.sql.files.openCostInBytes", "10")
    yield
    for key, value in saved.items():
        spark.conf.set(key, value)


def write_logs(tmp_path):
    rng = random.Random(4)
    contents = {}
    for name in ("one/a.log", "one/deep/b.log", "two/c.log"):
        lines = []
        for i in range(rng.randrange(150, 400)):
            text = rng.choice(["", "  ", "é" * rng.randrange(9), f"line {i} " + "x" * rng.randrange(60)])
            lines.append((text + rng.choice(["", "\r"])).encode())
        path = tmp_path / name
        path.parent.mkdir(parents=True, exist_ok=True)
        path.write_bytes(b"\n".join(lines) + rng.choice([b"", b"\n"]))
        contents[name] = path.read_bytes()
    (tmp_path / "one/notes.txt").write_text("not a log\n")
    return contents


def placed(spark, where):
    rows = files.read_placed_lines(spark, where).collect()
    out = {}
    for r in rows:
        out.setdefault(r["file_path"].split("/", 3)[-1], []).append((r["file_offset"], r["content"]))
    return {k: sorted(v) for k, v in out.items()}


def test_offsets_over_many_splits(spark, tmp_path, small_splits):
    contents = write_logs(tmp_path)
    found = placed(spark, f"{tmp_path}/one, {tmp_path}/two")
    assert len(found) == 3
    for name, data in contents.items():
        key, = [k for k in found if k.endswith(name)]
        assert found[key] == by_hand(data)


def test_offsets_of_unsplit_files(spark, tmp_path):
    contents = write_logs(tmp_path)
    found = placed(spark, [f"{tmp_path}/two"])
    assert list(found.values()) == [by_hand(contents["two/c.log"])]


def test_reading_without_offsets_and_sizes(spark, tmp_path):
    contents = write_logs(tmp_path)
    lines = files.read_lines(spark, str(tmp_path))
    assert lines.count() >= sum(len(by_hand(c)) for c in contents.values())
    sizes = {r["file_path"].rsplit("/", 1)[1]: r["file_size"] for r in files.file_sizes(spark, str(tmp_path)).collect()}
    assert sizes == {name.rsplit("/", 1)[1]: len(data) for name, data in contents.items()}


class Tail:
    def __init__(self, spark, where):
        self.spark, self.where = spark, str(where)
        self.commits = spark.createDataFrame(
            [], "file_path string, committed_offset bigint, committed_at timestamp_ntz")

    def round(self, as_of):
        lines = files.read_placed_lines(self.spark, self.where)
        new = files.after_offsets(lines, files.current_offsets(self.commits, as_of))
        out = sorted((r["file_offset"], r["content"]) for r in new.collect())
        rows = self.commits.unionByName(files.commit_rows(lines, as_of)).collect()
        self.commits = self.spark.createDataFrame(rows, self.commits.schema)
        return [text for _, text in out]


def test_tail_reads_each_new_line_once(spark, tmp_path):
    log = tmp_path / "app.log"
    tail = Tail(spark, tmp_path)
    log.write_bytes(b"one\ntwo\n")
    assert tail.round("2024-06-01 10:00:00") == ["one", "two"]
    assert tail.round("2024-06-01 10:01:00") == []
    log.write_bytes(b"one\ntwo\n\nthr")
    assert tail.round("2024-06-01 10:02:00") == ["thr"]
    log.write_bytes(b"one\ntwo\n\nthr\n")
    assert tail.round("2024-06-01 10:03:00") == []  # only the line end was added
    log.write_bytes(b"one\ntwo\n\nthr\nfo")
    assert tail.round("2024-06-01 10:04:00") == ["fo"]
    log.write_bytes(b"one\ntwo\n\nthr\nfour\nfive\n")
    assert tail.round("2024-06-01 10:05:00") == ["four", "five"]  # a grown line comes whole


def test_tail_starts_over_after_a_replaced_file_and_after_a_day(spark, tmp_path):
    log = tmp_path / "app.log"
    tail = Tail(spark, tmp_path)
    log.write_bytes(b"aaaa\nbbbb\n")
    tail.round("2024-06-01 10:00:00")
    log.write_bytes(b"new\n")
    assert tail.round("2024-06-01 11:00:00") == ["new"]
    assert tail.round("2024-06-02 10:59:00") == []
    assert tail.round("2024-06-03 11:00:00") == ["new"]  # the commit has expired


def test_a_byte_order_mark_counts(spark, tmp_path):
    log = tmp_path / "app.log"
    tail = Tail(spark, tmp_path)
    for data, new in ((b"\xef\xbb\xbfab\ncd\n", ["ab", "cd"]), (b"\xef\xbb\xbfab\ncd\nx\n", ["x"]), (b"\xef\xbb\xbfab\ncd\nx\ny", ["y"])):
        log.write_bytes(data)
        assert tail.round("2024-06-01 10:00:00") == new
    rows = files.read_placed_lines(spark, str(tmp_path)).collect()
    assert sorted((r["file_offset"], r["content"]) for r in rows) == [(3, "ab"), (6, "cd"), (9, "x"), (11, "y")]


def test_a_line_that_comes_after_the_read_is_not_covered(spark, tmp_path):
    log = tmp_path / "app.log"
    log.write_bytes(b"one\n")
    read = spark.createDataFrame(files.read_placed_lines(spark, str(tmp_path)).collect())
    log.write_bytes(b"one\ntwo\n")
    covered = files.commit_rows(read, AS_OF)
    again = files.after_offsets(files.read_placed_lines(spark, str(tmp_path)), files.current_offsets(covered, "2024-05-10 01:00:00"))
    assert [r["content"] for r in again.collect()] == ["two"]


def test_modified_after_skips_files(spark, tmp_path):
    (tmp_path / "a.log").write_bytes(b"x\n")
    assert files.read_placed_lines(spark, str(tmp_path), modified_after="2000-01-01").count() == 1
    assert files.read_placed_lines(spark, str(tmp_path), modified_after="2100-01-01").count() == 0


def test_file_event_stamps(spark, tmp_path):
    (tmp_path / "a.log").write_bytes(b"hello\nhello\n")
    rows = stamp_file_event(files.read_placed_lines(spark, str(tmp_path)), AS_OF, "host7").collect()
    assert {r["hostname"] for r in rows} == {"host7"} and {r["service_name"] for r in rows} == {"log-collector"}
    assert len({r["content_hash"] for r in rows}) == 1 and len({r["id"] for r in rows}) == 2


def test_directories():
    assert files.directories(" /a, /b ,,") == ["/a", "/b"]
