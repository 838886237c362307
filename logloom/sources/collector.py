"""Rounds of a log collector: read what is new, drop repeats, store, and commit the end of what was read."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..functions.text import not_blank
from ..functions.time import Moment
from ..operators.dedup import REPEAT_SECONDS, drop_seen, remember
from ..operators.enrich import stamp_file_event
from ..session import settle, settled_here
from ..sinks.layout import drop_partitions, list_folder, table_exists, with_day, write_partitions
from . import tail
from .files import LOG_PATTERN, commit_rows, current_offsets, directories

COMMITS = "file_path string, committed_offset bigint, committed_at timestamp_ntz"
SEEN = "content_hash string, timestamp timestamp_ntz"


def _done(spark: SparkSession, base: str) -> int:
    """Number of finished rounds: those whose commits are complete."""
    numbers = [int(path.rpartition("round=")[2]) for path in list_folder(spark, f"{base}/commits") if table_exists(spark, f"{path}/_SUCCESS")]
    return max(numbers, default=-1) + 1


def collect_round(spark: SparkSession, where: str | list[str], base: str, as_of: Moment, pattern: str = LOG_PATTERN,
                  ttl_seconds: int = REPEAT_SECONDS) -> DataFrame:
    """One round over the files below ``where``; gives the events that it stored in ``base/events``.

    Files are read from where the last round ended, so a round costs what is new. Its commits name every file, so only those of the
    round before are read. The commit is the last thing a round writes. A round that broke off before has the same number when it is run
    again and overwrites what it left, so no line is lost or stored twice. One collector works on a ``base`` at a time.
    """
    number = _done(spark, base)
    with settled_here(spark):
        commits = spark.read.schema(COMMITS).parquet(f"{base}/commits/round={number - 1}") if number else spark.createDataFrame([], COMMITS)
        seen = spark.read.schema(SEEN).parquet(f"{base}/seen/round={number - 1}") if number else spark.createDataFrame([], SEEN)
        current = current_offsets(commits, as_of)
        read = {row["file_path"]: [row["committed_offset"], 0, 0] for row in current.collect()}  # a row a file, not a line
        found = tail.matching_files(directories(where), pattern)
        lines = settle(tail.read_between(spark, read, {path: [size, 0, 0] for path, size in found.items()}).drop("read_bytes"))
        events = stamp_file_event(lines.where(not_blank(F.col("content"))).select("file_path", "content", "file_offset"), as_of)
        kept = settle(drop_seen(events, seen, ttl_seconds=ttl_seconds))
        write_partitions(with_day(kept), f"{base}/events", ["date"], batch_id=number)
        remember(seen, kept, as_of, ttl_seconds=ttl_seconds).write.mode("overwrite").parquet(f"{base}/seen/round={number}")
        ends = commit_rows(lines, as_of)
        # A file without new lines keeps its place, unless it has gone.
        kept_places = spark.createDataFrame([(path, mark[0], 0) for path, mark in read.items() if path in found], "file_path string, file_offset bigint, byte_length int")
        unchanged = commit_rows(kept_places, as_of).join(ends, "file_path", "left_anti")
        ends.union(unchanged).write.mode("overwrite").parquet(f"{base}/commits/round={number}")
        drop_partitions(spark, f"{base}/seen", [f"round={number - 2}"])
    stored = spark.read.parquet(f"{base}/events")
    return stored.where(stored["batch"] == number).drop("batch")
