"""Log files as tables of lines with exact byte offsets, and reading on from a committed offset."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window as W, functions as F

from ..functions.text import not_blank
from ..functions.time import Moment, before, moment

# Which files are logs, and how long a committed offset is remembered.
LOG_PATTERN = "*.log"
OFFSET_HOURS = 24
# Fixed value: bytes of a UTF-8 byte-order mark.
MARK_BYTES = 3

PLACED = ("file_path string, block_start bigint, file_size bigint, modified timestamp, "
          "content string, byte_length bigint, in_block bigint")


def directories(text: str | list[str]) -> list[str]:
    """Comma-separated directories, or a list of them."""
    parts = text.split(",") if isinstance(text, str) else text
    return [part.strip() for part in parts if part.strip()]


def _reader(spark: SparkSession, pattern: str):
    return (spark.read.option("recursiveFileLookup", True).option("pathGlobFilter", pattern)
            .option("lineSep", "\n"))


def read_lines(spark: SparkSession, where: str | list[str], pattern: str = LOG_PATTERN) -> DataFrame:
    """All lines of all matching files below the directories, as ``file_path, content``."""
    return _reader(spark, pattern).text(directories(where)).select(
        F.col("_metadata.file_path").alias("file_path"), _without_return(F.col("value")).alias("content"))


def _without_return(line: Column) -> Column:
    return F.regexp_replace(line, F.lit(r"\r\z"), F.lit(""))


def _offsets_in_block(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Running byte position of each line inside its file block.

    Runs right on the scan: a task reads its blocks one after the other, in file order.
    """
    open_block, carried = None, 0
    for batch in batches:
        if batch.num_rows == 0:
            continue
        blocks = batch.column("block").to_numpy(zero_copy_only=False)
        sizes = batch.column("byte_length").to_numpy(zero_copy_only=False) + 1
        ends = np.cumsum(sizes)
        begins = ends - sizes
        opens = np.flatnonzero(np.r_[True, blocks[1:] != blocks[:-1]])
        base = begins[opens]
        if open_block is not None and blocks[0] == open_block:
            base[0] -= carried
        position = begins - np.repeat(base, np.diff(np.r_[opens, batch.num_rows]))
        open_block, carried = blocks[-1], int(position[-1] + sizes[-1])
        kept = [n for n in batch.schema.names if n != "block"]
        yield pa.RecordBatch.from_arrays(
            [*[batch.column(n) for n in kept], pa.array(position, pa.int64())], [*kept, "in_block"])


def read_placed_lines(spark: SparkSession, where: str | list[str], pattern: str = LOG_PATTERN,
                      modified_after: Moment | None = None) -> DataFrame:
    """Lines with ``file_offset``, the byte at which each starts, and the size of their file.

    Files are split as usual, so a file of any size is read by many tasks. Every split
    knows where its lines start relative to each other; the bytes of the earlier splits
    of the file, one number per split, are added to get the place in the file. Blank
    lines count for the offset and are dropped afterwards. ``modified_after`` skips
    files by their listing entry.
    """
    raw = _reader(spark, pattern).text(directories(where))
    if modified_after is not None:
        raw = raw.filter(F.col("_metadata.file_modification_time") > moment(modified_after).cast("timestamp"))
    blocks = raw.select(
        F.col("_metadata.file_path").alias("file_path"),
        F.col("_metadata.file_block_start").alias("block_start"),
        F.col("_metadata.file_size").alias("file_size"),
        F.col("_metadata.file_modification_time").alias("modified"),
        F.col("value").alias("content"),
        F.octet_length("value").cast("bigint").alias("byte_length"),
    )
    bytes_per_block = blocks.groupBy("file_path", "file_size", "block_start").agg(
        F.sum(F.col("byte_length") + 1).alias("_bytes"))
    of_file = W.partitionBy("file_path")
    earlier = of_file.orderBy("block_start").rowsBetween(W.unboundedPreceding, -1)
    # The reader skips a byte-order mark; its bytes are what lines and line ends leave of the file.
    unread = F.col("file_size") - F.sum("_bytes").over(of_file)
    mark = F.when(unread >= MARK_BYTES - 1, F.lit(MARK_BYTES)).otherwise(F.lit(0))
    starts = bytes_per_block.select(
        F.col("file_path").alias("_path"), F.col("block_start").alias("_start"),
        (F.coalesce(F.sum("_bytes").over(earlier), F.lit(0)) + mark).alias("_before"))
    marked = blocks.withColumn("block", F.xxhash64("file_path", "block_start"))
    placed = marked.mapInArrow(_offsets_in_block, PLACED)
    joined = placed.join(
        starts, (placed["file_path"] == starts["_path"]) & (placed["block_start"] == starts["_start"]), "left")
    # Both scans must have cut the files alike; if not, stop instead of losing lines.
    start = F.coalesce(F.col("_before"), F.raise_error(F.lit("file splits changed between two scans; run again")))
    lines = joined.select(
        "file_path", _without_return(F.col("content")).alias("content"),
        (start + F.col("in_block")).alias("file_offset"), "byte_length", "file_size", "modified")
    return lines.filter(not_blank(F.col("content")))


def file_sizes(spark: SparkSession, where: str | list[str], pattern: str = LOG_PATTERN) -> DataFrame:
    """Path, size and change time of the matching files; their content is not read."""
    files = (spark.read.format("binaryFile").option("recursiveFileLookup", True)
             .option("pathGlobFilter", pattern).load(directories(where)))
    return files.select(F.col("path").alias("file_path"), F.col("length").alias("file_size"),
                        F.col("modificationTime").alias("modified"))


def current_offsets(commits: DataFrame, as_of: Moment) -> DataFrame:
    """Last commit per file, unless it is older than a day."""
    live = commits.filter(F.col("committed_at") > moment(before(as_of, hours=OFFSET_HOURS)))
    latest = live.groupBy("file_path").agg(
        F.max(F.struct("committed_at", "committed_offset")).alias("_last"))
    return latest.select("file_path", F.col("_last.committed_offset").alias("committed_offset"))


def after_offsets(lines: DataFrame, offsets: DataFrame) -> DataFrame:
    """Lines not yet covered by a committed offset, each once.

    A file shorter than its committed offset was replaced and is read from its start.
    A line that was committed while still being written comes again once it has grown.
    """
    known = offsets.select(F.col("file_path").alias("_path"), F.col("committed_offset").alias("_committed"))
    joined = lines.join(known, lines["file_path"] == known["_path"], "left")
    covered = F.when(F.col("file_size") < F.col("_committed"), F.lit(0)).otherwise(
        F.coalesce(F.col("_committed"), F.lit(0)))
    return joined.filter(F.col("file_offset") + F.col("byte_length") > covered).drop("_path", "_committed")


def commit_rows(lines: DataFrame, as_of: Moment) -> DataFrame:
    """Rows to append to the commit table after a round: every file is covered up to the end of the last of the ``lines`` read.

    Bytes that came after the read are not covered, so the next round finds them. Settle the lines first, so that
    what is stored and what is committed are one reading.
    """
    ends = lines.groupBy("file_path").agg(F.max(F.col("file_offset") + F.col("byte_length")).alias("committed_offset"))
    return ends.select("file_path", "committed_offset", moment(as_of).alias("committed_at"))


def stream_lines(spark: SparkSession, where: str | list[str], pattern: str = LOG_PATTERN,
                 files_per_trigger: int | None = None) -> DataFrame:
    """New files below the directories as a stream of lines. Files that grow in place need offsets instead."""
    reader = (spark.readStream.option("recursiveFileLookup", True).option("pathGlobFilter", pattern)
              .option("lineSep", "\n"))
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    streams = [
        reader.text(path).select(
            F.col("_metadata.file_path").alias("file_path"), _without_return(F.col("value")).alias("content"))
        for path in directories(where)
    ]
    lines = streams[0]
    for other in streams[1:]:
        lines = lines.unionByName(other)
    return lines.filter(not_blank(F.col("content")))
