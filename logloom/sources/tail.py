"""Growing log files by seeking: only the bytes behind the last read are read.

A Spark data source whose partitions are byte ranges of files, for batches and for streams. How far each file was read is
a map from its path to a mark: the end of what was read, and a check sum of the file's first bytes, which tells a file that grew
from another one under its name. A stream's offset is that map; it has one entry per file, like Spark's own file sources.
The files are opened with ``pyarrow.fs``, which knows local paths and the common stores by their scheme.
"""

from __future__ import annotations

import fnmatch
import json
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, InputPartition

from ..functions.text import not_blank
from .files import LOG_PATTERN, MARK_BYTES, directories

FORMAT = "logloom_tail"
SCHEMA = "file_path string, content string, file_offset bigint, byte_length bigint, read_bytes bigint"
_MARK = b"\xef\xbb\xbf"
#: Bytes of a partition, of one read, of a file's beginning that tells whether it is still the same file, and that opening a file counts for.
SPLIT_BYTES, READ_BYTES, HEAD_BYTES, OPEN_BYTES = 64 << 20, 1 << 20, 256, 1 << 18

#: For each file: end of what was read, bytes of its beginning that were summed, and their check sum.
Marks = dict[str, list[int]]


@dataclass
class Range:
    """Lines of ``path`` that begin from byte ``begin`` on and before ``end``.

    ``start`` says what ``begin`` is: the beginning of a "line", a place "inside" the file that a range before ends at, or how far the
    file was "read" before.
    """

    path: str
    begin: int
    end: int
    start: str


@dataclass
class Part(InputPartition):
    """Ranges that one task reads."""

    ranges: list[Range]


def file_system(path: str) -> tuple[pafs.FileSystem, str, str]:
    """The file system of a path or URI, the path inside it, and what a URI has before that."""
    scheme, colon, inner = path.partition(":")
    if not colon or "/" in scheme or scheme == "file":
        return pafs.LocalFileSystem(), "/" + (inner if scheme == "file" and colon else path).lstrip("/"), ""
    files, inner = pafs.FileSystem.from_uri(path)
    return files, inner, path.removesuffix("/").removesuffix(inner.removesuffix("/"))


def _opened(path: str) -> pa.NativeFile:
    files, inner, _ = file_system(path)
    return files.open_input_file(inner)


def matching_files(where: list[str], pattern: str) -> dict[str, int]:
    """Path and size of the files below the directories; as in Spark, names with ``_`` or ``.`` in front are hidden."""
    found = {}
    for place in where:
        files, inner, prefix = file_system(place)
        for entry in files.get_file_info(pafs.FileSelector(inner, allow_not_found=True, recursive=True)):
            below = entry.path[len(inner):].split("/")
            if entry.type == pafs.FileType.File and fnmatch.fnmatch(entry.base_name, pattern) and not any(name[:1] in ("_", ".") for name in below if name):
                found[prefix + entry.path] = entry.size
    return found


def _head(file: pa.NativeFile, size: int) -> list[int]:
    size = min(size, HEAD_BYTES)
    return [size, zlib.crc32(file.read_at(size, 0)) if size else 0]


def _line_begin(file: pa.NativeFile, at: int) -> int:
    """Behind the last line end before ``at``."""
    while at:
        begin = max(0, at - READ_BYTES)
        found = file.read_at(at - begin, begin).rfind(b"\n")
        if found >= 0:
            return begin + found + 1
        at = begin
    return 0


def marks_now(where: list[str], pattern: str, before: Marks, whole_lines: bool) -> Marks:
    """How far the files can be read now; with ``whole_lines`` up to the last line end. Files without news are not opened."""
    marks = {}
    for path, size in matching_files(where, pattern).items():
        known = before.get(path)
        if known and known[0] == size:
            marks[path] = known
            continue
        with _opened(path) as file:
            marks[path] = [_line_begin(file, size) if whole_lines else size, *_head(file, size)]
    return marks


def ranges(before: Marks, now: Marks, split_bytes: int) -> list[Part]:
    """What to read to come from one state to the other, in parts of about ``split_bytes``.

    A file that is shorter than it was, or begins otherwise, is another one and read from its start. A line that was read before it
    was complete is read again.
    """
    parts: list[Part] = []
    room = 0
    for path, (end, *_) in sorted(now.items()):
        begin, start, known = 0, "line", before.get(path)
        if known == now[path]:
            continue
        if known and 0 < known[0] <= end and _same_file(path, known):
            begin, start = known[0], "read"
        for at in range(begin, end, split_bytes):
            piece = Range(path, at, min(end, at + split_bytes), start if at == begin else "inside")
            if not parts or room < piece.end - piece.begin:
                parts.append(Part([]))
                room = split_bytes
            parts[-1].ranges.append(piece)
            room -= piece.end - piece.begin + OPEN_BYTES
    return parts


def _same_file(path: str, known: list[int]) -> bool:
    if not known[1]:
        return True
    with _opened(path) as file:
        return _head(file, known[1]) == known[1:]


def _begin_after(file: pa.NativeFile, read: int) -> int:
    """Where to go on in a file that was read up to ``read``: behind a line end, or where the line begins that has grown since."""
    if file.read_at(1, read) == b"\n":
        return read + 1
    return _line_begin(file, read)


def _lines(file: pa.NativeFile, size: int, part: Range) -> Iterator[tuple[bytes, int, int]]:
    """(line, place, bytes read for it) of a range; the last line may end behind the range."""
    at, end, rest, read = part.begin, part.end, b"", 0
    if part.start == "inside":  # the line that holds the byte before belongs to the range before
        at -= 1
    elif part.start == "read":
        at = _begin_after(file, at) if at < size else size
    if at == 0 and file.read_at(MARK_BYTES, 0) == _MARK:
        at, end = MARK_BYTES, max(end, MARK_BYTES + 1)
    skip, place = part.start == "inside", at
    while place < end:
        data = file.read_at(READ_BYTES, at)
        read += len(data)
        if not data:
            if rest and not skip:
                yield rest, place, read
            return
        at += len(data)
        *whole, rest = (rest + data).split(b"\n")
        for line in whole:
            if skip:
                skip = False
            elif place < end:
                yield line, place, read
                read = 0
            place += len(line) + 1
        if skip:  # of a line that belongs to another range only the length matters
            place, rest = place + len(rest), b""


def read_part(part: Part) -> Iterator[pa.RecordBatch]:
    """The lines of all ranges of a part as batches of bounded size; ``read_bytes`` adds up to what was read from the files for them."""
    for piece in part.ranges:
        with _opened(piece.path) as file:
            rows: list[tuple[bytes, int, int]] = []
            held = 0
            for row in _lines(file, file.size(), piece):
                rows.append(row)
                held += len(row[0]) + 16
                if held > READ_BYTES:
                    yield _batch(piece.path, rows)
                    rows, held = [], 0
            if rows:
                yield _batch(piece.path, rows)


def _batch(path: str, rows: list[tuple[bytes, int, int]]) -> pa.RecordBatch:
    lines = [line for line, _, _ in rows]
    return pa.RecordBatch.from_arrays([
        pa.array([path]).take(pa.array(np.zeros(len(rows), np.int64))),
        pa.array([line.removesuffix(b"\r").decode("utf-8", "replace") for line in lines]),
        pa.array([place for _, place, _ in rows], pa.int64()), pa.array([len(line) for line in lines], pa.int64()),
        pa.array([read for _, _, read in rows], pa.int64())], ["file_path", "content", "file_offset", "byte_length", "read_bytes"])


class _Reader(DataSourceReader):
    def __init__(self, options: dict):
        self.parts = ranges(json.loads(options["before"]), json.loads(options["now"]), int(options.get("split_bytes", SPLIT_BYTES)))

    def partitions(self) -> list[InputPartition]:
        return self.parts

    def read(self, partition: Part | None) -> Iterator[pa.RecordBatch]:
        if isinstance(partition, Part):
            yield from read_part(partition)


class _StreamReader(DataSourceStreamReader):
    def __init__(self, options: dict):
        self.where, self.pattern = json.loads(options["where"]), options["pattern"]
        self.split_bytes, self.last = int(options.get("split_bytes", SPLIT_BYTES)), {}

    def initialOffset(self) -> dict:
        return {}

    def latestOffset(self) -> dict:
        self.last = marks_now(self.where, self.pattern, self.last, whole_lines=True)
        return self.last

    def partitions(self, start: dict, end: dict) -> list[InputPartition]:
        return ranges(start, end, self.split_bytes)

    def read(self, partition: Part) -> Iterator[pa.RecordBatch]:
        yield from read_part(partition)

    def commit(self, end: dict) -> None:
        """What was read is kept in the stream's checkpoint; the files are left alone."""


class TailSource(DataSource):
    """Options of a batch: ``before`` and ``now``, marks as JSON; of a stream: ``where``, a JSON list of folders, and ``pattern``."""

    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> DataSourceReader:
        return _Reader(self.options)

    def streamReader(self, schema) -> DataSourceStreamReader:
        return _StreamReader(self.options)


def read_between(spark: SparkSession, before: Marks, now: Marks, split_bytes: int = SPLIT_BYTES) -> DataFrame:
    """The lines that lie between two states of the files, also blank ones."""
    spark.dataSource.register(TailSource)
    return (spark.read.format(FORMAT).option("before", json.dumps(before)).option("now", json.dumps(now))
            .option("split_bytes", split_bytes).load())


def tail_stream(spark: SparkSession, where: str | list[str], pattern: str = LOG_PATTERN, split_bytes: int = SPLIT_BYTES) -> DataFrame:
    """Complete lines of growing files as a stream, each once, as ``file_path, content, file_offset, byte_length``.

    New files are found at every trigger; a file that was replaced is read from its start.
    """
    spark.dataSource.register(TailSource)
    lines = (spark.readStream.format(FORMAT).option("where", json.dumps(directories(where))).option("pattern", pattern)
             .option("split_bytes", split_bytes).load())
    return lines.drop("read_bytes").filter(not_blank(F.col("content")))
