"""Arrow batches cut into slices of bounded text, and words of a slice as numpy arrays."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

#: Bytes of text in one slice, unless a single text is longer.
SLICE_BYTES = 2 << 20
ASCII_SPACE = bytes([0x20, *range(0x09, 0x0E)])


def pick(docs: DataFrame, *names: str) -> DataFrame:
    """Only the columns that an operator reads, so that no other column can clash or travel."""
    return docs.select(*(docs[name] for name in names))


#: Ids that are sent to all executors; a larger set is joined by a shuffle.
IDS_SENT = 500_000


def rows_by_id(docs: DataFrame, ids: DataFrame, how: str) -> DataFrame:
    """``docs`` joined with the distinct ``ids`` (doc_id); texts are only shuffled for more than ``IDS_SENT`` ids."""
    few = ids.limit(IDS_SENT + 1).count() <= IDS_SENT
    return docs.join(F.broadcast(ids) if few else ids.hint("shuffle_merge"), "doc_id", how)


def sliced(batches: Iterator[pa.RecordBatch], column: str = "text", most: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of at most ``most`` bytes of ``column``, or of one row."""
    for batch in batches:
        ends = np.cumsum(pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False).astype(np.int64))
        at = 0
        while at < batch.num_rows:
            before = ends[at - 1] if at else 0
            to = max(at + 1, int(np.searchsorted(ends, before + most, "right")))
            yield batch.slice(at, to - at)
            at = to


#: Bytes of the Arrow batches in which rows go to Python; with long texts the usual 10,000 rows take too much of an executor.
BATCH_BYTES = "4m"


def in_arrow(df: DataFrame, run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema: str | StructType) -> DataFrame:
    """``df.mapInArrow``, in a session whose Arrow batches are bounded by ``BATCH_BYTES``."""
    df.sparkSession.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)
    return df.mapInArrow(run, schema)


def map_slices(df: DataFrame, work: Callable[[pa.RecordBatch], pa.RecordBatch], schema: str, column: str = "text") -> DataFrame:
    """``work`` on each slice of ``df``; the memory a task holds is a few times one slice or one text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches, column):
            yield work(batch)
        pa.default_memory_pool().release_unused()  # the worker goes on to other tasks

    return in_arrow(df, run, schema)


def keep_slices(df: DataFrame, wanted: Callable[[pa.RecordBatch], np.ndarray], column: str = "text") -> DataFrame:
    """The rows of ``df`` that ``wanted`` says yes to, with all their columns; tasks work slice by slice, as in :func:`map_slices`."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches, column):
            yield batch.filter(pa.array(wanted(batch), pa.bool_()))
        pa.default_memory_pool().release_unused()

    return in_arrow(df, run, df.schema)


def texts_of(batch: pa.RecordBatch, column: str = "text") -> list[str]:
    return pc.fill_null(batch.column(column), "").to_pylist()


@dataclass
class Flat:
    """Texts of a slice end to end: ``data[offsets[i]:offsets[i + 1]]`` is text ``i`` in UTF-8."""

    data: np.ndarray
    offsets: np.ndarray

    def __len__(self) -> int:
        return len(self.offsets) - 1


def flat_of(batch: pa.RecordBatch, column: str = "text") -> Flat:
    """The texts of a slice without copies per row; a null text is empty."""
    texts = pc.fill_null(batch.column(column), "").cast(pa.large_string())
    if len(texts) == 0:
        return Flat(np.zeros(0, np.uint8), np.zeros(1, np.int64))
    _, offsets, data = texts.buffers()
    offsets = np.frombuffer(offsets, np.int64)[texts.offset : texts.offset + len(texts) + 1]
    whole = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return Flat(whole[offsets[0] : offsets[-1]], offsets - offsets[0])


@dataclass
class Words:
    """Words of a slice: bytes ``starts[k]`` to ``ends[k]``; text ``i`` has words ``first[i]`` to ``first[i + 1]``."""

    starts: np.ndarray
    ends: np.ndarray
    first: np.ndarray


def words_of(flat: Flat, separators: bytes = ASCII_SPACE) -> Words:
    """Maximal runs of bytes that are no separators; a word never spans two texts."""
    apart = np.zeros(256, bool)
    apart[list(separators)] = True
    inside = ~apart[flat.data]
    edge = np.zeros(len(inside) + 1, bool)
    edge[flat.offsets] = True
    begins, finishes = inside.copy(), inside
    begins[1:] &= ~inside[:-1] | edge[1:-1]
    starts = np.flatnonzero(begins)
    finishes = inside.copy()
    finishes[:-1] &= ~inside[1:] | edge[1:-1]
    return Words(starts, np.flatnonzero(finishes) + 1, np.searchsorted(starts, flat.offsets))


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers in which every input bit reaches every output bit."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def seeds(count: int, salt: int) -> np.ndarray:
    return mix(np.arange(1, count + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(salt))


_BASE = 0x2545F4914F6CDD1D
_POWERS: dict[str, np.ndarray] = {}


def _powers(count: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd base and of its inverse modulo 2**64."""
    if len(_POWERS.get("up", ())) < count:
        for name, base in (("up", _BASE), ("down", pow(_BASE, -1, 1 << 64))):
            steps = np.full(count, base, np.uint64)
            steps[0] = 1
            _POWERS[name] = np.cumprod(steps)
    kept = _POWERS["up"][:count], _POWERS["down"][:count]
    if count > 2 * SLICE_BYTES:
        _POWERS.clear()
    return kept


def word_hashes(flat: Flat, words: Words, lower: bool = True) -> np.ndarray:
    """A 64-bit hash of each word's bytes, with A-Z as a-z if ``lower``; the same on every machine."""
    table = seeds(256, 7)
    if lower:
        table[65:91] = table[97:123]
    up, down = _powers(len(flat.data) + 1)
    sums = np.zeros(len(flat.data) + 1, np.uint64)
    np.cumsum(table[flat.data] * up[:-1], out=sums[1:])
    raw = (sums[words.ends] - sums[words.starts]) * down[words.starts]
    return mix(raw + (words.ends - words.starts).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
