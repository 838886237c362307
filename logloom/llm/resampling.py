"""Drawing documents that look like a target text, by importance weights of hashed runs of words.

Every run of one or two words falls into a bucket by the CRC-32 of its bytes. A bucket's gain is the logarithm of how much more often
the target has it; a document's weight is the mean gain of its runs, read from one array. A draw without replacement in proportion to the
exponentials of the weights keeps the highest scores, weight plus a Gumbel number made from the document's id.

The place of the cutoff is found without sorting the scores: a quantile sketch brackets it, exact counts of the rows outside show
whether the bracket holds it, else it is widened, and only the rows of the last, narrow bracket are sorted.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from logloom.session import settle

from .blocks import Flat, Words, flat_of, in_arrow, map_slices, pick, sliced, words_of

BUCKETS = 10_000
#: Documents with fewer words are not drawn; hundredths of the others that are.
LEAST_WORDS, PERCENT = 20, 25
#: What stands before an id where its Gumbel number is made.
SEED = "7"
#: Half the width of a first bracket, as a share of its rows, and how much wider the next is when the cutoff is not inside.
MARGIN, WIDER = 0.001, 8
#: Rows of a bracket that is sorted.
SORTED = 5_000
#: Bytes of a word that are read in step with those of other words; what is longer is read by itself.
IN_STEP = 64

#: Word characters are digits, a-z and everything beyond ASCII.
SEPARATORS = bytes([*range(0x30), *range(0x3A, 0x61), *range(0x7B, 0x80)])
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def _register_table() -> np.ndarray:
    """What each byte does to a register of the reflected CRC-32."""
    table = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        table = np.where(table & 1, (table >> 1) ^ np.uint32(0xEDB88320), table >> 1).astype(np.uint32)
    return table


_TABLE = _register_table()
_START = np.uint32(0xFFFFFFFF)


def _through(state: np.ndarray, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Registers ``state`` after reading ``data[starts[k]:ends[k]]`` each; all words go forward one byte at a time, long ones first."""
    lengths = ends - starts
    order = np.argsort(-np.minimum(lengths, IN_STEP + 1), kind="stable")
    at, now = starts[order], state[order]
    still = len(order) - np.cumsum(np.bincount(np.minimum(lengths, IN_STEP), minlength=IN_STEP + 1))
    for step in range(IN_STEP):
        n = still[step]
        if not n:
            break
        now[:n] = _TABLE[(now[:n] ^ data[at[:n] + step]) & np.uint32(255)] ^ (now[:n] >> np.uint32(8))
    for k in range(int((lengths > IN_STEP).sum())):
        rest = data[at[k] + IN_STEP : ends[order[k]]].tobytes()
        now[k] = zlib.crc32(rest, int(now[k]) ^ 0xFFFFFFFF) ^ 0xFFFFFFFF
    back = np.empty_like(now)
    back[order] = now
    return back


def word_runs(flat: Flat) -> Words:
    """The words of lower-case texts."""
    return words_of(Flat(_LOWER[flat.data], flat.offsets), SEPARATORS)


def run_buckets(flat: Flat, words: Words) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of all single words, and of all pairs of consecutive words of one text, with word ``k`` first in pair ``k``; -1 where
    the text ends."""
    data = _LOWER[flat.data]
    single = _through(np.full(len(words.starts), _START), data, words.starts, words.ends)
    pairs = np.full(len(single), -1, np.int64)
    last = words.first[1:][np.diff(words.first) > 0] - 1
    inner = np.ones(len(single), bool)
    inner[last] = False
    left = np.flatnonzero(inner)
    spaced = _TABLE[(single[left] ^ np.uint32(32)) & np.uint32(255)] ^ (single[left] >> np.uint32(8))
    pairs[left] = (~_through(spaced, data, words.starts[left + 1], words.ends[left + 1])) % np.uint32(BUCKETS)
    return ((~single) % np.uint32(BUCKETS)).astype(np.int64), pairs


def bucket_counts(texts: DataFrame) -> np.ndarray:
    """How many runs of words of all ``texts`` (text) fall into each bucket; tasks add up before anything is shuffled."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(BUCKETS, np.int64)
        for batch in sliced(batches):
            flat = flat_of(batch)
            single, pairs = run_buckets(flat, word_runs(flat))
            total += np.bincount(single, minlength=BUCKETS) + np.bincount(pairs[pairs >= 0], minlength=BUCKETS)
        held = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(held), pa.array(total[held])], ["bucket", "n"])

    found = in_arrow(pick(texts, "text"), run, "bucket bigint, n bigint").groupBy("bucket").agg(F.sum("n").alias("n")).collect()
    counts = np.zeros(BUCKETS, np.int64)
    for row in found:
        counts[row.bucket] = row.n
    return counts


def gains(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """For each bucket the thousandfold logarithm of the target's share over the source's, each count one higher, rounded down."""
    held, wanted = int(source.sum()) + BUCKETS, int(target.sum()) + BUCKETS
    return np.array([math.floor(1000 * math.log(float(t + 1) * float(held) / (float(s + 1) * float(wanted))))
                     for s, t in zip(source.tolist(), target.tolist(), strict=True)], np.int64)


def weights_of(flat: Flat, by_bucket: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For each text its words, its runs and the mean gain of the runs, rounded down; 0 without runs."""
    words = word_runs(flat)
    single, pairs = run_buckets(flat, words)
    own = by_bucket[single] + np.where(pairs >= 0, by_bucket[pairs], 0)
    sums = np.concatenate([[0], np.cumsum(own)])
    n_words = np.diff(words.first)
    runs = np.maximum(0, 2 * n_words - 1)
    return n_words, runs, (sums[words.first[1:]] - sums[words.first[:-1]]) // np.maximum(1, runs)


def gumbel(doc_id: Column, seed: str = SEED) -> Column:
    """The thousandfold Gumbel number of an id, rounded down; a null id is the empty text."""
    digits = F.substring(F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit(""))), 256), 1, 8)
    share = (F.conv(digits, 16, 10).cast("bigint") + F.lit(0.5)) / F.lit(4294967296.0)
    return F.floor(F.lit(-1000.0) * F.ln(-F.ln(share))).cast("bigint")


@dataclass
class Bracket:
    """Rows between two values of a column, ends included (None: open), and how many rows come before them."""

    low: int | None
    high: int | None
    before: int
    inside: int

    def of(self, column: str) -> Column:
        kept = F.lit(True)
        if self.low is not None:
            kept &= F.col(column) >= self.low
        if self.high is not None:
            kept &= F.col(column) <= self.high
        return kept


def narrowed(rows: DataFrame, column: str, wanted: int, bracket: Bracket) -> Bracket:
    """A smaller bracket that holds the row at place ``wanted``, from a sketch; exact counts of what lies outside prove it."""
    held, margin = rows.where(bracket.of(column)), MARGIN
    place = (wanted - bracket.before) / bracket.inside
    while True:
        shares = [max(0.0, place - margin), min(1.0, place + margin)]
        low, high = held.agg(F.percentile_approx(column, shares, F.lit(10_000)).alias("ends")).first()["ends"]
        counts = held.agg(*(F.count_if(condition).alias(name) for name, condition in {
            "below": F.col(column) < low, "at_low": F.col(column) == low,
            "upto": F.col(column) <= high, "at_high": F.col(column) == high}.items())).first()
        below, upto = bracket.before + counts["below"], bracket.before + counts["upto"]
        if below < wanted <= below + counts["at_low"]:
            return Bracket(low, low, below, counts["at_low"])
        if upto - counts["at_high"] < wanted <= upto:
            return Bracket(high, high, upto - counts["at_high"], counts["at_high"])
        if below < wanted <= upto:
            inner = below + counts["at_low"]
            return Bracket(low + 1, high - 1, inner, upto - counts["at_high"] - inner)
        margin *= WIDER


def cutoff(rows: DataFrame, columns: list[str], wanted: int, held: int) -> dict[str, int]:
    """Values of ``columns`` (whole numbers, no nulls) in the row at place ``wanted``, from 1, of the ``held`` rows in ascending order."""
    fixed: dict[str, int] = {}
    for column in columns:
        bracket = Bracket(None, None, 0, held)
        while bracket.low is None or (bracket.low < bracket.high and bracket.inside > SORTED):
            bracket = narrowed(rows, column, wanted, bracket)
        rows, wanted, held = rows.where(bracket.of(column)), wanted - bracket.before, bracket.inside
        if bracket.low < bracket.high:
            found = rows.orderBy(*columns).offset(wanted - 1).limit(1).first()
            return fixed | {name: found[name] for name in columns[len(fixed):]}
        fixed[column] = bracket.low
    return fixed


def numbered(rows: DataFrame, columns: list[str], name: str) -> DataFrame:
    """``rows`` with their places, from 1, in ascending order of ``columns``: sorted in ranges, the ranges counted, each numbered by itself."""
    ranged = settle(rows.repartitionByRange(*columns).withColumn("part", F.spark_partition_id()))
    sizes = ranged.groupBy("part").agg(F.count("*").alias("size"))
    before = F.sum("size").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    begins = sizes.select("part", F.coalesce(before, F.lit(0)).alias("begin"))
    own = F.row_number().over(Window.partitionBy("part").orderBy(*columns))
    return ranged.join(F.broadcast(begins), "part").withColumn(name, F.col("begin") + own).drop("part", "begin")


def weighted(docs: DataFrame, by_bucket: np.ndarray) -> DataFrame:
    """For each row of ``docs`` (doc_id, text): doc_id, n_words, n_features, weight."""
    shipped = docs.sparkSession.sparkContext.broadcast(by_bucket)

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        found = weights_of(flat_of(batch), shipped.value)
        return pa.RecordBatch.from_arrays([batch.column("doc_id").cast(pa.int64()), *(pa.array(f.astype(np.int64)) for f in found)],
                                          ["doc_id", "n_words", "n_features", "weight"])

    return map_slices(pick(docs, "doc_id", "text"), work, "doc_id bigint, n_words bigint, n_features bigint, weight bigint")


def resampled(docs: DataFrame, target: DataFrame, percent: int = PERCENT, least: int = LEAST_WORDS, seed: str = SEED) -> DataFrame:
    """For each row of ``docs`` (doc_id, text): doc_id, n_features, weight, score and rank, drawn towards the texts of ``target`` (text).

    A null text has no words; a text without words has weight 0. Ranks go by score, highest first, then by doc_id; a null id counts
    as the largest, and rows that are equal in all of this have any order among them. Rows that are not drawn have a null rank. Repeated
    rows are separate rows; an empty table gives no rows, and without a target text the weights favour rare buckets; other columns
    are not read.
    """
    by_bucket = gains(bucket_counts(docs), bucket_counts(target))
    found = weighted(docs, by_bucket).withColumn("score", F.col("weight") + gumbel(F.col("doc_id"), seed))
    scored = settle(found.withColumn("falling", -F.col("score")).withColumn("last_id", F.coalesce("doc_id", F.lit((1 << 63) - 1))))
    columns, shown = ["falling", "last_id"], ["doc_id", "n_features", "weight", "score"]
    long_enough = scored.where(F.col("n_words") >= least)
    held = long_enough.count()
    wanted = percent * held // 100
    if not wanted:
        return scored.select(*shown, F.lit(None).cast("bigint").alias("rank"))
    last = cutoff(long_enough, columns, wanted, held)
    upto = (F.col("falling") < last["falling"]) | ((F.col("falling") == last["falling"]) & (F.col("last_id") <= last["last_id"]))
    chosen = (F.col("n_words") >= least) & upto
    drawn = numbered(scored.where(chosen), columns, "place").withColumn("rank", F.when(F.col("place") <= wanted, F.col("place")))
    return drawn.select(*shown, "rank").union(scored.where(~chosen).select(*shown, F.lit(None).cast("bigint").alias("rank")))
