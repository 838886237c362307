"""Benchmark decontamination: test items found in documents within a budget of edits.

An item is compared as lower-case words with single spaces. Items of two or more units of ``UNIT`` characters are cut into units.
Besides, every ``STRIDE`` characters a shorter unit of ``SPAN`` begins, so that any unchanged part of ``SURE`` characters holds a
whole unit and is found. A unit of ``m`` characters may differ by ``m // PER_EDIT`` edits. It is split into one
piece more than that: by the pigeonhole principle one piece of any occurrence is unchanged. The beginnings of all pieces
are one sorted table of numbers, in which every place of the documents is looked up; where a whole piece stands, Myers' bit-parallel algorithm
computes the edit distance of the unit to the best stretch of text around it.
"""

from __future__ import annotations

import re
import unicodedata
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .blocks import keep_slices, map_slices, mix, pick, texts_of

#: Characters of a unit at least, and characters that allow one edit.
UNIT, PER_EDIT = 80, 12
#: Characters of the overlapping units, and from one's begin to the next; a part of an item of ``SURE`` characters holds one.
SPAN, STRIDE = 59, 30
SURE = SPAN + STRIDE - 1
#: A shorter item has no edits and counts where it stands on word boundaries, and one of fewer than ``LEAST_WORDS`` words
#: only where it is the whole document. Two characters of a script without spaces are a word.
LEAST, LEAST_WORDS = 24, 3
#: Bytes of test items that one pass over the documents holds.
BLOCK_BYTES = 8 << 20

_APART = bytes(b if b >= 128 or chr(b).isalnum() else 32 for b in range(256))


#: Thai, Lao, Tibetan, Burmese, Khmer; Japanese and Chinese; Korean, where endings join the words.
_UNSPACED = re.compile("[\u0e00-\u0fff\u1000-\u109f\u1780-\u17ff\u3040-\u9fff\uac00-\ud7af\uf900-\ufaff\U00020000-\U0003ffff]")


def plain_bytes(text: str) -> bytes:
    """Lower case, with single spaces for all that is in ASCII no letter and no digit; in UTF-8."""
    return b" ".join(text.lower().encode("utf-8", "replace").translate(_APART).split())


def plain(text: str) -> str:
    return plain_bytes(text).decode()


def words_in(text: str) -> int:
    """Words of a plain text; two characters of a script without spaces count as one."""
    return len(_UNSPACED.sub(" ", text).split()) + len(_UNSPACED.findall(text)) // 2


def joined(text: str, at: int) -> bool:
    """Whether the characters before and at ``at`` are of one word."""
    if not 0 < at < len(text):
        return False
    pair = text[at - 1 : at + 1]
    return not _UNSPACED.search(pair) and all(unicodedata.category(char)[0] in "LMN" for char in pair)


@dataclass(frozen=True)
class Unit:
    item_id: int | None
    text: str
    whole: bool
    exact: bool = False

    @property
    def edits(self) -> int:
        return 0 if self.whole or self.exact else len(self.text) // PER_EDIT


def places_of(text: str) -> Iterator[tuple[int, int]]:
    """Begin and end of the units of a plain text: the whole or its consecutive parts of ``UNIT`` to twice as many characters, and the overlapping parts of ``SPAN``."""
    parts = max(1, len(text) // UNIT)
    cuts = [len(text) * k // parts for k in range(parts + 1)]
    spans = list(zip(cuts[:-1], cuts[1:], strict=True))
    if len(text) > SPAN:
        spans += [(begin, begin + SPAN) for begin in (*range(0, len(text) - SPAN, STRIDE), len(text) - SPAN)]
    for begin, end in spans:
        if part := text[begin:end].strip():
            begin = text.index(part, begin, end)
            yield begin, begin + len(part)


def units_of(item_id: int | None, text: str | None) -> Iterator[Unit]:
    """The units of an item; none for one without words."""
    text = plain(text or "")
    short = len(text) < LEAST
    whole = short and words_in(text) < LEAST_WORDS
    for begin, end in places_of(text):
        yield Unit(item_id, text[begin:end], whole, short and not whole)


def pieces_of(size: int, edits: int) -> list[int]:
    """Where the pieces of a unit of ``size`` characters begin, and its end."""
    return [size * k // (edits + 1) for k in range(edits + 2)]


def best_match(pattern: str, text: str) -> tuple[int, int]:
    """Myers: the least edit distance of ``pattern`` to any stretch of ``text``, and the end of the first such stretch."""
    masks: dict[str, int] = {}
    for k, char in enumerate(pattern):
        masks[char] = masks.get(char, 0) | 1 << k
    full, top = (1 << len(pattern)) - 1, 1 << len(pattern) - 1
    more, less, score = full, 0, len(pattern)
    best, end = score, 0
    for at, char in enumerate(text, 1):
        same = masks.get(char, 0)
        diagonal = (((same & more) + more) ^ more) | same | less
        up = less | full & ~(diagonal | more)
        down = more & diagonal
        if up & top:
            score += 1
        elif down & top:
            score -= 1
        up, down = up << 1 & full, down << 1 & full
        more = down | full & ~(diagonal | up)
        less = up & diagonal
        if score < best:
            best, end = score, at
    return best, end


def least_distances(patterns: list[str], texts: list[str]) -> np.ndarray:
    """:func:`best_match`'s distances of many pairs at once, for patterns of at most 64 characters."""
    sizes = np.array([len(p) for p in patterns], np.uint64)
    rows = np.zeros((len(patterns), 64), np.uint32)
    for row, pattern in zip(rows, patterns, strict=True):
        row[: len(pattern)] = np.frombuffer(pattern.encode("utf-32-le"), np.uint32)
    width = max(map(len, texts), default=0)
    signs = np.zeros((width, len(texts)), np.uint32)
    for k, text in enumerate(texts):
        signs[: len(text), k] = np.frombuffer(text.encode("utf-32-le"), np.uint32)
    one, top = np.uint64(1), sizes - np.uint64(1)
    full = ((one << top) - one) << one | one
    more, less = full.copy(), np.zeros(len(patterns), np.uint64)
    score, best = sizes.astype(np.int64), sizes.astype(np.int64)
    for column in signs:
        same = np.packbits(rows == column[:, None], axis=1, bitorder="little").view(np.uint64)[:, 0] & full
        diagonal = (((same & more) + more) ^ more) | same | less
        up, down = less | full & ~(diagonal | more), more & diagonal
        score += (up >> top & one).astype(np.int64) - (down >> top & one).astype(np.int64)
        up, down = up << one & full, down << one & full
        more, less = down | full & ~(diagonal | up), up & diagonal
        best = np.minimum(best, score)  # signs behind a text's end only take from the score what they add
    return best


#: Bytes at the beginning of a piece that are looked up: ``LONG`` as a hash, of shorter pieces all up to 8 as they are.
LONG = 11
#: Bytes of items, or of documents, that are looked at together.
AT_ONCE = 1 << 20
#: Stretches that are measured side by side.
PAIRS = 2000


def _windows(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The 8 bytes from each place on as a number, and a hash of ``LONG`` bytes."""
    size, ahead = len(data), LONG - 8
    padded = np.concatenate([data, np.zeros(LONG, np.uint8)])
    eight = np.zeros(size + ahead, np.uint64)
    for k in range(8):
        eight |= padded[k : k + size + ahead].astype(np.uint64) << np.uint64(8 * k)
    return eight[:size], mix(eight[:size]) ^ (eight[ahead:] * np.uint64(0x9E3779B97F4A7C15))


def _begun(windows: tuple[np.ndarray, np.ndarray], size: int) -> np.ndarray:
    """What is looked up for pieces of ``size`` bytes, at each place."""
    eight, many = windows
    return many if size >= LONG else eight & np.uint64((1 << 8 * min(size, 8)) - 1)


class _Table:
    """Pieces by what they begin with: sorted numbers, and a bit field that rules most other numbers out."""

    def __init__(self, keys: np.ndarray, units: np.ndarray, begins: np.ndarray):
        order = np.argsort(keys, kind="stable")
        self.units, self.begins = units[order], begins[order]
        self.keys, first = np.unique(keys[order], return_index=True)
        self.first = np.append(first, len(keys))
        self.shift = np.uint64(64 - min(24, max(12, int(8 * len(self.keys)).bit_length())))
        self.filter = np.zeros(1 << 64 - int(self.shift), bool)
        self.filter[self._place(self.keys)] = True

    def _place(self, numbers: np.ndarray) -> np.ndarray:
        return (numbers * np.uint64(0xD6E8FEB86659FD93)) >> self.shift

    def places(self, numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places whose number is in the table, and which it is."""
        places = np.flatnonzero(self.filter[self._place(numbers)])
        at = np.minimum(np.searchsorted(self.keys, numbers[places]), len(self.keys) - 1)
        same = self.keys[at] == numbers[places]
        return places[same], at[same]


class Searcher:
    """Units of items (id, plain text) and tables of their pieces. ``found(text)`` gives for each item its least distance and where it is."""

    def __init__(self, items: list[tuple[int | None, str]]):
        self.items = items
        rows: list[tuple[int, int, int, bool]] = []
        self.whole: dict[str, list[int | None]] = {}
        parts: dict[int, list[tuple[np.ndarray, np.ndarray, np.ndarray]]] = {}
        for number, (item_id, text) in enumerate(items):
            short = len(text) < LEAST
            if short and words_in(text) < LEAST_WORDS:
                if text:
                    self.whole.setdefault(text, []).append(item_id)
                continue
            units = [(number, begin, end, short) for begin, end in places_of(text)]
            windows, to_byte = _windows(np.frombuffer(text.encode(), np.uint8)), None
            if not text.isascii():
                to_byte = np.concatenate([[0], np.cumsum([len(char.encode()) for char in text])])
            owners, begins, sizes, places = [], [], [], []
            for k, (_, begin, end, exact) in enumerate(units, len(rows)):
                cuts = pieces_of(end - begin, 0 if exact else (end - begin) // PER_EDIT)
                for cut, after in zip(cuts[:-1], cuts[1:], strict=True):
                    first, stop = (begin + cut, begin + after) if to_byte is None else (to_byte[begin + cut], to_byte[begin + after])
                    owners.append(k)
                    begins.append(cut)
                    sizes.append(min(LONG, stop - first) if stop - first >= LONG else min(8, stop - first))
                    places.append(first)
            rows += units
            owners, begins, sizes, places = (np.array(column, np.int32) for column in (owners, begins, sizes, places))
            for size in np.unique(sizes).tolist():
                own = sizes == size
                parts.setdefault(size, []).append((_begun(windows, size)[places[own]], owners[own], begins[own]))
        self.unit = np.array(rows, np.int32).reshape(-1, 4)
        self.tables = {size: _Table(*map(np.concatenate, zip(*own, strict=True))) for size, own in parts.items()}

    def found(self, text: str) -> dict[int | None, tuple[int, int, int]]:
        return self.found_in([text])[0]

    def found_in(self, texts: list[str]) -> list[dict[int | None, tuple[int, int, int]]]:
        """For each text item to (distance, first word, last word); the least distance, then the first place."""
        result, held, size = [], [], 0
        for text in texts:
            held.append(plain_bytes(text))
            size += len(held[-1])
            if size > AT_ONCE:
                result += self._found(held)
                held, size = [], 0
        return result + self._found(held) if held else result

    def _found(self, texts: list[bytes]) -> list[dict[int | None, tuple[int, int, int]]]:
        found: list[dict[int | None, tuple[int, int, int]]] = [{} for _ in texts]
        if self.whole:
            for best, text in zip(found, texts, strict=True):
                if len(text) < 4 * LEAST:
                    best.update((item_id, (0, 0, text.count(b" "))) for item_id in self.whole.get(text.decode(), ()))
        offsets = np.cumsum([0, *(len(text) + 1 for text in texts)])
        windows = _windows(np.frombuffer(b"\n".join(texts), np.uint8))
        hits: dict[int, list[tuple[int, int, int]]] = {}
        for size, table in self.tables.items():
            places, rows = table.places(_begun(windows, size))
            owner = np.searchsorted(offsets, places, "right") - 1
            for k, at, row in zip(owner.tolist(), (places - offsets[owner]).tolist(), rows.tolist(), strict=True):
                hits.setdefault(k, []).append((at, row, size))
        near = [(texts[k].decode(), unit, slot, found[k]) for k, own in hits.items() for unit, slot in self._near(texts[k], own, found[k])]
        for at in range(0, len(near), PAIRS):
            some = near[at : at + PAIRS]
            for (text, unit, slot, best), close in zip(some, self._close(some).tolist(), strict=True):
                if close:
                    self._measured(text, unit, slot, best)
        return found

    def _close(self, near: list[tuple[str, int, int, dict]]) -> np.ndarray:
        """Whether stretches may hold their units. Of a long unit in parts of at most 64 characters one part must have its share of the edits or fewer."""
        owners, patterns, stretches, most = [], [], [], []
        for k, (text, unit, slot, _) in enumerate(near):
            pattern, stretch = self._pattern(unit), text[slice(*self._stretch(unit, slot))]
            parts = -(-len(pattern) // 64)
            cuts = [len(pattern) * j // parts for j in range(parts + 1)]
            for begin, end in zip(cuts[:-1], cuts[1:], strict=True):
                owners.append(k)
                patterns.append(pattern[begin:end])
                stretches.append(stretch)
                most.append(len(pattern) // PER_EDIT // parts)
        close = np.zeros(len(near), bool)
        close[np.array(owners)[least_distances(patterns, stretches) <= np.array(most)]] = True
        return close

    def _pattern(self, unit: int) -> str:
        number, begin, end, _ = self.unit[unit].tolist()
        return self.items[number][1][begin:end]

    def _stretch(self, unit: int, slot: int) -> tuple[int, int]:
        """The part of a text that occurrences may lie in that begin in ``slot``, give or take the budget."""
        length = int(self.unit[unit, 2] - self.unit[unit, 1])
        room = length // PER_EDIT
        return max(0, slot * (room + 1) - room), max(0, (slot + 1) * (room + 1) + length + room)

    def _measured(self, text: str, unit: int, slot: int, best: dict[int | None, tuple[int, int, int]]) -> None:
        pattern, item_id = self._pattern(unit), self.items[self.unit[unit, 0]][0]
        length, room = len(pattern), len(pattern) // PER_EDIT
        left, right = self._stretch(unit, slot)
        distance, stop = best_match(pattern, text[left:right])
        if distance <= room:
            stop += left
            back, size_back = best_match(pattern[::-1], text[max(0, stop - length - room) : stop][::-1])
            first = stop - (size_back if back == distance else length)
            match = (distance, text.count(" ", 0, max(0, first)), text.count(" ", 0, stop))
            best[item_id] = min(best.get(item_id, match), match)

    def _near(self, data: bytes, hits: list[tuple[int, int, int]], best: dict[int | None, tuple[int, int, int]]) -> Iterator[tuple[int, int]]:
        """Units and slots that a piece stands in; what stands there as it is goes to ``best`` at once."""
        text = data.decode()
        to_char = None if len(text) == len(data) else np.cumsum((np.frombuffer(data, np.uint8) & 0xC0) != 0x80) - 1
        checked: set[tuple[int, int]] = set()
        for at, row, size in sorted(hits):
            at, table = at if to_char is None else int(to_char[at]), self.tables[size]
            for k in range(table.first[row], table.first[row + 1]):
                unit, cut = int(table.units[k]), int(table.begins[k])
                number, begin, end, exact = self.unit[unit].tolist()
                item_id, item = self.items[number]
                length = end - begin
                if exact:
                    stop = at + length
                    if text.startswith(item[begin:end], at) and not joined(text, at) and not joined(text, stop):
                        match = (0, text.count(" ", 0, at), text.count(" ", 0, stop))
                        best[item_id] = min(best.get(item_id, match), match)
                    continue
                # stretches that begin within the budget of this diagonal; neighbouring diagonals share a window
                room = length // PER_EDIT
                slot = (at - cut) // (room + 1)
                after = next(c for c in pieces_of(length, room) if c > cut)
                if (unit, slot) in checked or not text.startswith(item[begin + cut : begin + after], at):
                    continue
                checked.add((unit, slot))
                first = at - cut
                if first >= 0 and text.startswith(item[begin:end], first):
                    match = (0, text.count(" ", 0, first), text.count(" ", 0, first + length))
                    best[item_id] = min(best.get(item_id, match), match)
                else:
                    yield unit, slot


_SEARCHERS: dict[str, Searcher] = {}


def searcher_of(shipped: Broadcast) -> Searcher:
    """The searcher of a block of items, made once in each worker; one block is held at a time."""
    key, items = shipped.value
    if key not in _SEARCHERS:
        _SEARCHERS.clear()
        _SEARCHERS[key] = Searcher(items)
    return _SEARCHERS[key]


def item_blocks(items: DataFrame) -> Iterator[Broadcast]:
    """All items (item_id, text), those without id too, as plain texts in blocks that a worker can hold.

    A block has up to twice ``BLOCK_BYTES``, or one item; the driver holds one block at a time.
    """
    context = items.sparkSession.sparkContext
    items = pick(items, "item_id", "text").where("text is not null").distinct()
    sized = items.withColumn("bytes", F.octet_length("text").cast("bigint"))
    blocks = max(1, -(-(sized.agg(F.sum("bytes")).first()[0] or 0) // BLOCK_BYTES))
    while True:
        cut = sized.withColumn("block", F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)))
        sizes = cut.groupBy("block").agg(F.sum("bytes").alias("bytes"), F.count("*").alias("items"))
        if sizes.where((F.col("bytes") > 2 * BLOCK_BYTES) & (F.col("items") > 1)).isEmpty():
            break
        blocks *= 2
    for block in range(blocks):
        rows = cut.where(F.col("block") == block).orderBy("item_id", "text").collect()
        yield context.broadcast((uuid.uuid4().hex, [(row.item_id, plain(row.text)) for row in rows]))


def leaks(docs: DataFrame, items: DataFrame) -> DataFrame:
    """One row for each row of ``docs`` (doc_id, text) and each item that it holds: doc_id, item_id, distance, first_word, last_word.

    ``distance`` is the least of the item's units, the words (from 0) are those of the plain text. Null and empty texts and
    items hold and match nothing; items without id are left out; rows that repeat are searched as often as they are there; with no
    documents or no items there are no rows; other columns are not read.
    """
    result = None
    for shipped in item_blocks(pick(items, "item_id", "text").where("item_id is not null")):

        def work(batch: pa.RecordBatch, shipped: Broadcast = shipped) -> pa.RecordBatch:
            found = searcher_of(shipped).found_in(texts_of(batch))
            rows = [(doc_id, item, *match) for doc_id, own in zip(batch.column("doc_id").to_pylist(), found, strict=True)
                    for item, match in sorted(own.items())]
            columns = zip(*rows, strict=True) if rows else [[]] * 5
            return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], ["doc_id", "item_id", "distance", "first_word", "last_word"])

        found = map_slices(pick(docs, "doc_id", "text"), work,
                           "doc_id bigint, item_id bigint, distance bigint, first_word bigint, last_word bigint")
        result = found if result is None else result.union(found)
    return result


def without_leaks(docs: DataFrame, items: DataFrame) -> DataFrame:
    """``docs`` without the rows that hold a test item, with or without id; all columns stay."""
    result = docs
    for units in item_blocks(items):
        def clean(batch: pa.RecordBatch, units: list[Unit] = units) -> list[bool]:
            searcher = searcher_of(units)
            return [not searcher.found(text) for text in texts_of(batch)]

        result = keep_slices(result, clean)
    return result
