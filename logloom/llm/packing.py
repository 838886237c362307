"""Packing of tokenized documents into sequences of equal capacity by differencing.

A document's full windows are sequences of their own. What is left of it is cut into pieces and waits for
others; as soon as the pieces of a batch of windows are there, differencing deals them out to windows of nearly equal
length, a little below the capacity. If a window still exceeds the capacity, the batch gets one more. The document that
crosses the end of a batch is cut there, so batches leave little padding. Tasks hold one batch and do not exchange rows.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

from .blocks import flat_of, in_arrow, pick, sliced
from .differencing import differenced
from .token_ids import word_ids

CAPACITY = 2048
#: Windows dealt out together.
WINDOWS = 512
#: Longest piece that is dealt out, and the tokens by which windows stay below the capacity on average.
PIECE, MARGIN = 512, 2
#: Sequences of one task are numbered from its number times this.
NUMBERS = 1 << 40
#: Rows of one result batch, and somewhat more where a window ends.
ROWS = 4096

SCHEMA = "doc_id bigint, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, sequence_id bigint, offset bigint"
_KIND = pa.schema([(name, pa.int64()) for name in SCHEMA.replace(" bigint", "").split(", ")])


@dataclass(slots=True)
class Piece:
    doc_id: int | None
    start: int
    ids: np.ndarray
    tokens: int


def windows_of(pieces: list[Piece], capacity: int = CAPACITY) -> list[list[Piece]]:
    """As few windows as differencing can fill without exceeding the capacity; neighbouring pieces are joined."""
    sizes = np.array([len(p.ids) for p in pieces], np.int64)
    ways = max(1, -(-int(sizes.sum()) // capacity))
    while True:
        groups = differenced(sizes, ways)
        if all(sizes[group].sum() <= capacity for group in groups):
            break
        ways += 1
    windows = []
    for group in groups:
        window: list[Piece] = []
        for k in group:
            piece, last = pieces[k], window[-1] if window else None
            if last and last.doc_id == piece.doc_id and last.tokens == piece.tokens and last.start + len(last.ids) == piece.start and group[group.index(k) - 1] == k - 1:
                window[-1] = Piece(last.doc_id, last.start, np.concatenate([last.ids, piece.ids]), last.tokens)
            else:
                window.append(piece)
        if window:
            windows.append(window)
    return windows


class Packer:
    """Takes documents one by one; gives finished windows."""

    def __init__(self, capacity: int = CAPACITY, windows: int = WINDOWS, piece: int = PIECE, margin: int = MARGIN):
        self.capacity, self.piece, self.room = capacity, piece, windows * (capacity - margin)
        self.waiting: list[Piece] = []
        self.held = 0

    def add(self, doc_id: int | None, ids: np.ndarray) -> Iterator[list[Piece]]:
        full = len(ids) - len(ids) % self.capacity
        for start in range(0, full, self.capacity):
            yield [Piece(doc_id, start, ids[start : start + self.capacity], len(ids))]
        at = full
        while at < len(ids):
            to = min(at + self.piece, len(ids), at + self.room - self.held)
            self.waiting.append(Piece(doc_id, at, ids[at:to], len(ids)))
            self.held += to - at
            at = to
            if self.held == self.room:
                yield from self.finish()

    def finish(self) -> Iterator[list[Piece]]:
        if self.waiting:
            yield from windows_of(self.waiting, self.capacity)
        self.waiting, self.held = [], 0


def packed(docs: DataFrame, definition: str, end_id: int = 1, capacity: int = CAPACITY, with_ids: bool = False) -> DataFrame:
    """One row per piece of each row of ``docs`` (doc_id, text); each token lies in exactly one piece.

    ``definition`` is the text of a tokenizer file. doc_id, start (the document's tokens before the piece), length,
    ids_crc32 (of the ids as little-endian unsigned 32-bit numbers), doc_tokens (with the end id), sequence_id and
    offset (place in the sequence); with ``with_ids`` also ``ids``. A null text is empty: its document has the end id only. Rows
    that repeat are packed as often as they are there; null ids stay null; an empty table gives no rows; other columns are not read.
    """
    end = np.array([end_id], "<u4")

    def rows(window: list[Piece], number: int) -> Iterator[tuple]:
        offset = 0
        for p in window:
            yield (p.doc_id, p.start, len(p.ids), zlib.crc32(np.ascontiguousarray(p.ids)), p.tokens, number, offset, p.ids)
            offset += len(p.ids)

    def table(made: list[tuple]) -> pa.RecordBatch:
        columns = list(zip(*made, strict=True))
        arrays = [pa.array(column, pa.int64()) for column in columns[:7]]
        if not with_ids:
            return pa.RecordBatch.from_arrays(arrays, schema=_KIND)
        ids = pa.array([i.astype(np.int64) for i in columns[7]], pa.list_(pa.int64()))
        return pa.RecordBatch.from_arrays([*arrays, ids], [*_KIND.names, "ids"])

    def windows(batches: Iterator[pa.RecordBatch]) -> Iterator[list[Piece]]:
        tokenizer, packer = word_ids(definition), Packer(capacity)
        for batch in sliced(batches):
            flat = flat_of(batch)
            texts = [flat.data[a:b].tobytes() for a, b in zip(flat.offsets[:-1], flat.offsets[1:], strict=True)]
            for doc_id, ids in zip(batch.column("doc_id").to_pylist(), tokenizer.ids(texts), strict=True):
                yield from packer.add(doc_id, np.concatenate([ids, end]))
        yield from packer.finish()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made: list[tuple] = []
        for number, window in enumerate(windows(batches), TaskContext.get().partitionId() * NUMBERS):
            made += rows(window, number)
            if len(made) >= ROWS:
                yield table(made)
                made = []
        if made:
            yield table(made)

    return in_arrow(pick(docs, "doc_id", "text"), run, SCHEMA + (", ids array<bigint>" if with_ids else ""))
