"""Conversations formatted by a compiled template, at any length of a single one.

Rows are dealt out by ranges of (conversation, turn), so a conversation with a third of all rows lies on many
machines, in order. Each task renders its conversations piece by piece. A conversation that surely begins and ends
inside a task is done there; pieces of the others, at most two a task unless they are long, meet once more and
are read in order, one piece at a time.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .blocks import pick
from .chat_template import TURNS, Template, read_turns, unescape

#: Characters and turns of one piece, and pieces that wait for a conversation's end.
PIECE_CHARS, PIECE_TURNS, PIECES_HELD = 1 << 18, 256, 16

_SPANS = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
_PIECES = pa.schema([("conv_id", pa.int64()), ("part", pa.int64()), ("piece", pa.int64()), ("text", pa.string()), ("spans", _SPANS)])


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int | None, str, str]]:
    for batch in batches:
        for conv_id, role, text in zip(*(batch.column(c).to_pylist() for c in ("conv_id", "role", "text")), strict=True):
            yield conv_id, role or "", text or ""


def _pieces(rows: Iterator[tuple[int | None, str, str]], template: Template) -> Iterator[tuple[int | None, str, list]]:
    """(conversation, text, spans), in order; a piece holds turns of one conversation."""
    messages: list[dict] = []
    held, size = None, 0
    for conv_id, role, text in rows:
        if messages and (conv_id != held or size > PIECE_CHARS or len(messages) == PIECE_TURNS):
            yield held, *template.render(messages=messages)
            messages, size = [], 0
        held = conv_id
        messages.append({"role": role, "text": text})
        size += len(role) + len(text)
    if messages:
        yield held, *template.render(messages=messages)


def _dealt(conversations: DataFrame) -> DataFrame:
    """Rows in order of conversation and turn, over as many tasks as shuffles have."""
    rows = pick(conversations, "conv_id", "turn", "role", "text").withColumn("_row", F.monotonically_increasing_id())
    order = ["conv_id", "turn", "role", "text", "_row"]
    count = int(conversations.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return rows.repartitionByRange(count, *order).sortWithinPartitions(*order).select("conv_id", "role", "text")


def _compiled(source: str) -> Template:
    template = Template(source)
    if not template.by_turn:
        raise ValueError("the template must be one loop over messages whose body uses the message only")
    return template


def formatted(conversations: DataFrame, source: str = TURNS) -> DataFrame:
    """The rendered conversations: conv_id, part, piece, text and spans, the generated stretches of that text.

    Pieces of a conversation follow each other by (part, piece). Rows are ordered by turn, role and text, nulls first;
    a null role or text is empty; rows without conv_id make one conversation; repeated rows are repeated turns;
    an empty table gives no rows; other columns are not read.
    """
    _compiled(source)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        for k, (conv_id, text, spans) in enumerate(_pieces(_rows(batches), Template(source))):
            yield pa.RecordBatch.from_pylist([{"conv_id": conv_id, "part": part, "piece": k, "text": text, "spans": [{"start": s, "end": e} for s, e in spans]}], _PIECES)

    return _dealt(conversations).mapInArrow(run, "conv_id bigint, part bigint, piece bigint, text string, spans array<struct<start: bigint, end: bigint>>")


class _Digest:
    """What a reader finds in the pieces of one conversation."""

    def __init__(self, conv_id: int | None):
        self.conv_id, self.turns, self.loss_chars, self.chars = conv_id, 0, 0, 0
        self.all, self.loss = hashlib.sha256(), hashlib.sha256()

    def read(self, text: str, spans: list[tuple[int, int]]) -> None:
        for role, said in read_turns(text):
            self.turns += 1
            self.all.update(f"{role}\n{said}\n".encode())
        for start, end in spans:
            learned = unescape(text[start:end])
            self.loss_chars += len(learned)
            self.loss.update(learned.encode())
        self.chars += len(text)

    def row(self) -> dict:
        return {"conv_id": self.conv_id, "n_turns": self.turns, "turns_sha256": self.all.hexdigest(), "loss_chars": self.loss_chars,
                "loss_sha256": self.loss.hexdigest(), "formatted_chars": self.chars}


_FOUND = pa.schema([("conv_id", pa.int64()), ("n_turns", pa.int64()), ("turns_sha256", pa.string()), ("loss_chars", pa.int64()),
                    ("loss_sha256", pa.string()), ("formatted_chars", pa.int64())])
_FOUND_SQL = "conv_id bigint, n_turns bigint, turns_sha256 string, loss_chars bigint, loss_sha256 string, formatted_chars bigint"
_MIXED = pa.schema([*_PIECES, *list(_FOUND)[1:]])
_MIXED_SQL = ("conv_id bigint, part bigint, piece bigint, text string, spans array<struct<start: bigint, end: bigint>>, "
              + _FOUND_SQL.partition(", ")[2])


def digests(conversations: DataFrame) -> DataFrame:
    """For each conversation what is read back from its formatted text: see :class:`_Digest`. Cases as in :func:`formatted`."""

    def partly(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, begun, current, waiting = TaskContext.get().partitionId(), 0, None, []

        def open_rows() -> list[dict]:
            return [{"conv_id": c, "part": part, "piece": k, "text": t, "spans": [{"start": s, "end": e} for s, e in spans]} for k, c, t, spans in waiting]

        def out(rows: list[dict]) -> pa.RecordBatch:
            return pa.RecordBatch.from_pylist(rows, _MIXED)

        complete = False
        done: list[dict] = []
        for k, (conv_id, text, spans) in enumerate(_pieces(_rows(batches), Template(TURNS))):
            if begun == 0 or conv_id != current:
                if complete:
                    digest = _Digest(current)
                    for _, _, own, marks in waiting:
                        digest.read(own, marks)
                    done.append({"part": part, "piece": k, **digest.row()})
                elif waiting:
                    yield out(open_rows())
                waiting, complete, current, begun = [], begun > 0, conv_id, begun + 1
            waiting.append((k, conv_id, text, spans))
            if len(waiting) >= PIECES_HELD:
                yield out(open_rows())
                waiting, complete = [], False
            if len(done) >= 1000:
                yield out(done)
                done = []
        if done:
            yield out(done)
        if waiting:
            yield out(open_rows())

    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        digest = None
        for batch in batches:
            done = []
            for row in batch.to_pylist():
                if row["text"] is None:
                    done.append({name: row[name] for name in _FOUND.names})
                    continue
                if digest is None or digest.conv_id != row["conv_id"]:
                    if digest is not None:
                        done.append(digest.row())
                    digest = _Digest(row["conv_id"])
                digest.read(row["text"], [(s["start"], s["end"]) for s in row["spans"]])
            yield pa.RecordBatch.from_pylist(done, _FOUND)
        if digest is not None:
            yield pa.RecordBatch.from_pylist([digest.row()], _FOUND)

    mixed = _dealt(conversations).mapInArrow(partly, _MIXED_SQL)
    return mixed.repartition("conv_id").sortWithinPartitions("conv_id", "part", "piece").mapInArrow(finish, _FOUND_SQL)
