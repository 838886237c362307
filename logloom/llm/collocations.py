"""Phrases of two and three words that stand together more often than their parts would by chance, for each language.

Words are counted first. The most frequent ones get their frequency ranks as numbers, so that the pairs of frequent words lie close together
in the square of first and second number. The square is cut into tiles: a tile that gets many pairs is an array that the pair addresses
directly, counted by ``bincount``; the pairs of all other tiles, and those with a word beyond the ranked ones, are kept as sorted coordinates
with counts. The same is done again for three words: the most frequent pairs are ranked anew, and pair number and word number span the
tiles. A phrase can only be frequent if its parts are; a bit table of frequent words and pairs, of fixed size, keeps most others out of
the counting (some get by, which changes no result).
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from logloom.session import settle

from .blocks import in_arrow, pick, sliced

#: Occurrences of a phrase at least; a shorter phrase goes if a longer one around it has so many hundredths of its occurrences; phrases of a language.
LEAST, COVERED, TOP = 10, 50, 2000
UNKNOWN = "und"
#: Words, and pairs, that are ranked and sent to all tasks; the others are counted all the same.
RANKED = 1 << 16
#: Numbers of one side of a tile as a power of two; pairs of one slice from which a tile becomes an array; arrays of a task.
TILE, CROWDED, ARRAYS = 9, 4096, 32
#: Words that a task keeps numbers for, coordinates and languages it holds, and rows of a batch it gives out.
HELD_WORDS, HELD_COORDINATES, HELD_LANGUAGES, GIVEN = 300_000, 1_000_000, 500, 100_000
#: Parts of a language whose first phrases are ranked before those of the whole.
PARTS = 64
#: Bytes of text that are cut into words at a time.
AT_ONCE = 1 << 20
#: Bits of the table of what is frequent.
BITS = 1 << 26
#: How the parts of a phrase are added up to its bit.
_LANG, _FIRST, _SECOND = 127, 1_000_003, 8_191

_BREAK = b"\xff"
_TABLE = bytes(0xFF if chr(b) in ".,;:!?\n\v\f\r" else 0x20 if b == 9 else b for b in range(256))
_APART = re.compile(b"[ \xff]")
ROWS = "lang string, phrase string, n bigint"


def tokens_of(data: bytes, overlap: int) -> Iterator[list[bytes]]:
    """Words of ``data`` and breaks between pieces, some at a time; each list begins with the last ``overlap`` of the one before."""
    data, at, kept = data.lower().translate(_TABLE), 0, []
    while at < len(data):
        found = _APART.search(data, at + AT_ONCE)
        to = found.start() if found else len(data)
        own = kept + data[at:to].replace(_BREAK, b" \xff ").split()
        yield own
        at, kept = to, own[len(own) - overlap :] if overlap and len(own) > overlap else own if overlap else []


def texts_by_language(batch: pa.RecordBatch) -> Iterator[tuple[str, bytes]]:
    """For each language of a slice its texts, with breaks between them."""
    langs = pc.fill_null(batch.column("lang").cast(pa.string()), UNKNOWN).dictionary_encode()
    texts = pc.fill_null(batch.column("text"), "").cast(pa.large_binary())
    for code, lang in enumerate(langs.dictionary.to_pylist()):
        yield lang, _BREAK.join(texts.filter(pc.equal(langs.indices, code)).to_pylist())


@dataclass
class Frequent:
    """What a task knows about frequent words and pairs: ranked words by language, ranked pairs (as ranks of words) and bits."""

    words: dict[str, list[bytes]]
    word_bits: np.ndarray
    pairs: dict[str, np.ndarray] = field(default_factory=dict)
    pair_bits: np.ndarray | None = None


def _set(bits: np.ndarray, places: np.ndarray) -> np.ndarray:
    return (bits[places >> 6] >> (places & 63).astype(np.uint64)) & np.uint64(1) == 1


class Lexicon:
    """Numbers of words of one language: 0 for a break, then ranked words in their order, then others as they come."""

    def __init__(self, lang: str, known: Frequent | None):
        self.lang, self.known, self.base = zlib.crc32(lang.encode()), known, _LANG * zlib.crc32(lang.encode())
        self.number: dict[bytes, int] = {_BREAK: 0}
        self.crc, self.good = np.zeros(1, np.int64), np.zeros(1, bool)
        self._learn(known.words.get(lang, []) if known else [])
        self.ranked = len(self.number)

    def _learn(self, new: list[bytes]) -> None:
        self.number.update(zip(new, range(len(self.number), len(self.number) + len(new)), strict=True))
        crc = np.fromiter(map(zlib.crc32, new), np.int64, len(new))
        self.crc = np.concatenate([self.crc, crc])
        if self.known is not None:
            self.good = np.concatenate([self.good, _set(self.known.word_bits, (self.base + _FIRST * crc) % BITS)])

    def numbers(self, tokens: list[bytes]) -> np.ndarray:
        new = set(tokens).difference(self.number)
        if new:
            self._learn(list(new))
        return np.fromiter(map(self.number.__getitem__, tokens), np.int64, len(tokens))

    def spelled(self, columns: list[np.ndarray]) -> pa.Array:
        """Phrases of the words with these numbers, joined by spaces."""
        words = pa.array(list(self.number), pa.binary())
        return pc.binary_join_element_wise(*(words.take(pa.array(c)) for c in columns), b" ")


def merged(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """Sorted coordinates and counts of several such lists."""
    keys, counts = (np.concatenate(side) for side in zip(*parts, strict=True))
    order = np.argsort(keys, kind="stable")
    keys, counts = keys[order], counts[order]
    heads = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
    return keys[heads], np.add.reduceat(counts, heads)


class Tiles:
    """Counts of (left, right) for the phrases of one language and length, by arrays for crowded tiles and sorted coordinates elsewhere."""

    def __init__(self):
        self.arrays: dict[tuple[int, int], np.ndarray] = {}
        self.parts: list[tuple[np.ndarray, np.ndarray]] = []
        self.held = 0

    def add(self, left: np.ndarray, right: np.ndarray, keys: np.ndarray, may_open: bool) -> None:
        """``left`` and ``right`` are ranks, or -1; ``keys`` are the same phrases as coordinates."""
        ranked = np.flatnonzero((left >= 0) & (right >= 0))
        row, column = left[ranked] >> TILE, right[ranked] >> TILE
        tiles = (row << 20) | column
        found, counts = np.unique(tiles, return_counts=True)
        loose = np.ones(len(keys), bool)
        for tile, count in zip(found.tolist(), counts.tolist(), strict=True):
            name = tile >> 20, tile & 0xFFFFF
            if name not in self.arrays:
                if count < CROWDED or not may_open:
                    continue
                self.arrays[name] = np.zeros(1 << 2 * TILE, np.int64)
                may_open = len(self.arrays) < ARRAYS
            own = ranked[tiles == tile]
            inside = (left[own] & (1 << TILE) - 1) << TILE | right[own] & (1 << TILE) - 1
            self.arrays[name] += np.bincount(inside, minlength=1 << 2 * TILE)
            loose[own] = False
        if loose.any():
            self.parts.append(np.unique(keys[loose], return_counts=True))
            self.held += len(self.parts[-1][0])

    def merge(self) -> None:
        self.parts = [merged(self.parts)]
        self.held = len(self.parts[0][0])


class Counter:
    """Counts phrases of ``size`` words in one task and gives them out as rows; what it holds is bounded."""

    def __init__(self, size: int, known: Frequent | None):
        self.size, self.known = size, known
        self.forget()

    def forget(self) -> None:
        self.lexicons: dict[str, Lexicon] = {}
        self.tiles: dict[str, Tiles] = {}
        self.words: dict[str, np.ndarray] = {}

    def add(self, lang: str, tokens: list[bytes]) -> None:
        if lang not in self.lexicons:
            self.lexicons[lang], self.tiles[lang], self.words[lang] = Lexicon(lang, self.known), Tiles(), np.zeros(1, np.int64)
        lexicon, tiles = self.lexicons[lang], self.tiles[lang]
        own = lexicon.numbers(tokens)
        if self.size == 1:
            counts = np.bincount(own, minlength=len(lexicon.number))
            counts[: len(self.words[lang])] += self.words[lang]
            self.words[lang] = counts
            return
        begin = np.flatnonzero(lexicon.good[own[:-1]] & lexicon.good[own[1:]])
        if self.size == 3:
            first, second = own[begin], own[begin + 1]
            begin = begin[_set(self.known.pair_bits, (lexicon.base + _FIRST * lexicon.crc[first] + _SECOND * lexicon.crc[second]) % BITS)]
            begin = begin[:-1][np.diff(begin) == 1]
        if not len(begin):
            return
        words = [own[begin + k] for k in range(self.size)]
        keys = words[0]
        for more in words[1:]:
            keys = keys << 21 | more
        left = np.where(words[0] < lexicon.ranked, words[0], -1) if self.size == 2 else self._pair_ranks(lang, words[0], words[1])
        right = np.where(words[-1] < lexicon.ranked, words[-1], -1)
        tiles.add(left, right, keys, sum(len(t.arrays) for t in self.tiles.values()) < ARRAYS)

    def _pair_ranks(self, lang: str, first: np.ndarray, second: np.ndarray) -> np.ndarray:
        ranked = self.known.pairs.get(lang)
        if ranked is None or not len(ranked):
            return np.full(len(first), -1)
        keys, ranks = ranked[:, 0], ranked[:, 1]
        wanted = first << 21 | second
        at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
        return np.where(keys[at] == wanted, ranks[at], -1)

    def full(self) -> bool:
        if sum(t.held for t in self.tiles.values()) > HELD_COORDINATES:
            for tiles in self.tiles.values():
                if tiles.parts:
                    tiles.merge()
        return (sum(t.held for t in self.tiles.values()) > HELD_COORDINATES // 2
                or sum(len(x.number) - x.ranked for x in self.lexicons.values()) > HELD_WORDS or len(self.lexicons) > HELD_LANGUAGES)

    def given(self) -> Iterator[pa.RecordBatch]:
        """All counts so far, which are forgotten then; single words come with their total, without a phrase."""
        for lang, lexicon in self.lexicons.items():
            if self.size == 1:
                counts = self.words[lang]
                counts[0] = 0
                yield pa.RecordBatch.from_arrays([pa.array([lang]), pa.array([None], pa.string()), pa.array([int(counts.sum())])], ["lang", "phrase", "n"])
                yield from self._batches(lang, [np.flatnonzero(counts)], counts[counts > 0])
                continue
            tiles = self.tiles[lang]
            for (row, column), array in tiles.arrays.items():
                held = np.flatnonzero(array)
                left, right = (row << TILE) + (held >> TILE), (column << TILE) + (held & (1 << TILE) - 1)
                yield from self._batches(lang, [left, right] if self.size == 2 else [*self._pair_words(lang, left), right], array[held])
            if tiles.parts:
                keys, counts = merged(tiles.parts)
                yield from self._batches(lang, [keys >> 21 * k & (1 << 21) - 1 for k in reversed(range(self.size))], counts)
        self.forget()

    def _pair_words(self, lang: str, ranks: np.ndarray) -> list[np.ndarray]:
        ranked = self.known.pairs[lang]
        keys = ranked[np.argsort(ranked[:, 1]), 0][ranks]
        return [keys >> 21, keys & (1 << 21) - 1]

    def _batches(self, lang: str, columns: list[np.ndarray], counts: np.ndarray) -> Iterator[pa.RecordBatch]:
        for at in range(0, len(counts), GIVEN):
            phrases = self.lexicons[lang].spelled([c[at : at + GIVEN] for c in columns]).cast(pa.string())
            langs = pa.array([lang]).take(pa.array(np.zeros(len(phrases), np.int64)))
            yield pa.RecordBatch.from_arrays([langs, phrases, pa.array(counts[at : at + GIVEN])], ["lang", "phrase", "n"])


def _counted(docs: DataFrame, size: int, known: Frequent | None) -> DataFrame:
    """(lang, phrase, n) of the phrases of ``size`` words that occur ``LEAST`` times or more; for single words also all words together."""
    shipped = docs.sparkSession.sparkContext.broadcast(known)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = Counter(size, shipped.value)
        for batch in sliced(batches):
            for lang, data in texts_by_language(batch):
                for tokens in tokens_of(data, size - 1):
                    counter.add(lang, tokens)
                    if counter.full():
                        yield from counter.given()
        yield from counter.given()

    parts = in_arrow(pick(docs, "lang", "text"), run, ROWS)
    return parts.groupBy("lang", "phrase").agg(F.sum("n").alias("n")).where((F.col("n") >= LEAST) | F.col("phrase").isNull())


def _most(phrases: DataFrame) -> dict[str, list[str]]:
    """The most frequent phrases, at most ``RANKED``, by language, in order of frequency.

    Frequencies are told apart in steps of an eleventh; of a step that does not fit whole none is taken. So only the rows that are
    ranked reach the driver, however many tasks hold them.
    """
    step = F.floor(F.log2("n") * 8)
    taken, least = 0, None
    for row in sorted(phrases.groupBy(step.alias("step")).count().collect(), reverse=True):
        taken += row["count"]
        if taken > RANKED:
            break
        least = row.step
    found: dict[str, list[str]] = {}
    if least is not None:
        for row in sorted(phrases.where(step >= least).collect(), key=lambda r: (-r.n, r.lang, r.phrase)):
            found.setdefault(row.lang, []).append(row.phrase)
    return found


def _crc(text: Column) -> Column:
    return F.crc32(text.cast("binary"))


def _bits(place: Column, phrases: DataFrame) -> np.ndarray:
    """A table of ``BITS`` bits in which the ``place`` of every phrase is set."""
    places = phrases.select(F.pmod(place, F.lit(BITS)).alias("place"))
    slots = places.selectExpr("cast(place div 64 as int) as slot", "shiftleft(1L, cast(place % 64 as int)) as bit")
    found = slots.groupBy("slot").agg(F.bit_or("bit").alias("bit")).toArrow()
    bits = np.zeros(BITS // 64, np.uint64)
    bits[found["slot"].to_numpy()] = found["bit"].to_numpy().view(np.uint64)
    return bits


def phrase_counts(docs: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Written tables (lang, phrase, n) of words, pairs and triples that occur ``LEAST`` times; the words' also has a row without phrase
    for each language, with all its words."""
    words = settle(_counted(docs, 1, None))
    named = words.where("phrase is not null")
    ranked = {lang: [w.encode() for w in own] for lang, own in _most(named).items()}
    base = F.lit(_LANG) * _crc(F.col("lang"))
    known = Frequent(ranked, _bits(base + F.lit(_FIRST) * _crc(F.col("phrase")), named))
    pairs = settle(_counted(docs, 2, known))
    ranks = {lang: {w: k for k, w in enumerate(own, 1)} for lang, own in ranked.items()}
    for lang, own in _most(pairs).items():
        numbers = [[ranks.get(lang, {}).get(w) for w in phrase.encode().split(b" ")] for phrase in own]
        keys = np.array(sorted((a << 21 | b, at) for at, (a, b) in enumerate((n for n in numbers if None not in n))), np.int64)
        known.pairs[lang] = keys.reshape(-1, 2)
    first, second = (F.split_part("phrase", F.lit(" "), F.lit(k)) for k in (1, 2))
    known.pair_bits = _bits(base + F.lit(_FIRST) * _crc(first) + F.lit(_SECOND) * _crc(second), pairs)
    return words, pairs, settle(_counted(docs, 3, known))


def phrases(docs: DataFrame, top: int = TOP) -> DataFrame:
    """The ``top`` phrases of each language of ``docs`` (lang, text): lang, rank, phrase, a, l, r, n, score.

    A null text is empty, a null language is ``und``; words are counted in every row, repeated rows too; a language without frequent phrases,
    or an empty table, gives no rows; other columns are not read. Equal scores go by ``a`` and then by the phrase's bytes.
    Memory of a task is bounded for texts of any length, but for a single word, which it holds whole.
    """
    words, pairs, triples = phrase_counts(docs)
    named = words.where("phrase is not null")
    split = pairs.union(triples).select("lang", "phrase", F.col("n").alias("a"), F.split("phrase", " ").alias("own"))
    cuts = split.select("lang", "phrase", "a", F.explode(F.sequence(F.lit(1), F.size("own") - 1)).alias("k"), "own").selectExpr(
        "lang", "phrase", "a", "k", "array_join(slice(own, 1, k), ' ') as left", "array_join(slice(own, k + 1, size(own) - k), ' ') as right")
    parts = named.union(pairs)
    for side, name in (("left", "l"), ("right", "r")):
        cuts = cuts.join(parts.select("lang", F.col("phrase").alias(side), F.col("n").alias(name)), ["lang", side])
    exact = "cast({0} as decimal(17, 0))"
    score = f"(cast(1000000 as decimal(7, 0)) * {exact.format('a')} * {exact.format('a')}) div ({exact.format('l')} * {exact.format('r')})"
    best = cuts.withColumn("score", F.expr(score)).groupBy("lang", "phrase", "a").agg(F.min(F.struct("score", "k", "l", "r")).alias("best"))
    around = triples.select("lang", F.split("phrase", " ").alias("own"), F.col("n").alias("longer")).selectExpr(
        "lang", "longer", "explode(array(concat_ws(' ', own[0], own[1]), concat_ws(' ', own[1], own[2]))) as phrase")
    covered = around.groupBy("lang", "phrase").agg(F.max("longer").alias("longer"))
    covered = covered.join(pairs, ["lang", "phrase"]).where(100 * F.col("longer") >= COVERED * F.col("n")).select("lang", "phrase")
    kept = best.join(covered, ["lang", "phrase"], "left_anti").select("lang", "phrase", "a", "best.l", "best.r", "best.score")
    order = [F.desc("score"), F.desc("a"), "phrase"]
    # Each of some parts of a language gives its first ones, so that one task ranks few rows.
    part = Window.partitionBy("lang", F.pmod(F.xxhash64("phrase"), F.lit(PARTS))).orderBy(*order)
    best = kept.withColumn("place", F.row_number().over(part)).where(F.col("place") <= top).drop("place")
    first = best.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("bigint")).where(F.col("rank") <= top)
    totals = words.where("phrase is null").select("lang", "n")
    return first.join(totals, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
