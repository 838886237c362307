"""Chains of times: the first time of a key, then always the first one at least a life time after the last.

One aggregate gives the first and last time of every key and its rows. A key whose times span less than a life time keeps its first
time, and nothing else is done for it. The times of other keys are sorted, and a task follows the chains of all keys of an Arrow batch at once:
a pointer from each time to the next one that may be kept is doubled until every chain has ended.

A key with more rows than a block is cut into blocks of whole life-time slices, with numbers that follow from counts per slice
alone. What happens before a block matters to it only by the earliest time that may be kept next, which lies in
the block's first life time. One pass over each block says for each such time when the chain leaves the block. A pass over
these few rows, key by key, gives every block its entry. No task holds more than a block, whatever a key's share of the rows.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window as W, functions as F, types as T

from ..session import settle

#: Rows of a block, up to one slice more. It changes no result.
BLOCK_ROWS = 500_000
_FIRST = -(1 << 62)


def micros(df: DataFrame, ts: str) -> Column:
    """Microseconds since 1970 on the time's own clock."""
    if isinstance(df.schema[ts].dataType, T.TimestampNTZType):
        return F.expr(f"timestampdiff(MICROSECOND, timestamp_ntz'1970-01-01 00:00:00', `{ts}`)")
    return F.unix_micros(F.col(ts))


def _heads(batch: pa.RecordBatch, names: list[str]) -> np.ndarray:
    """Places of the rows whose ``names`` differ from those of the row before."""
    change = np.zeros(batch.num_rows, bool)
    change[:1] = True
    for name in names:
        column = batch.column(name)
        change[1:] |= pc.not_equal(column.slice(1), column.slice(0, batch.num_rows - 1)).to_numpy(zero_copy_only=False)
    return np.flatnonzero(change)


def whole_groups(batches: Iterator[pa.RecordBatch], names: list[str]) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    """The sorted rows again, in batches that cut no group of equal ``names``, each with the places where its groups begin."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        last = int(_heads(batch, names)[-1])
        if held and (last or any(held[-1].column(n)[0] != batch.column(n)[0] for n in names)):
            before = [*held, batch.slice(0, last)] if last else held
            held = [batch.slice(last)]
            whole = _joined(before)
            yield whole, _heads(whole, names)
        elif held:
            held.append(batch)
        else:
            if last:
                whole = batch.slice(0, last)
                yield whole, _heads(whole, names)
            held = [batch.slice(last)]
    if held:
        whole = _joined(held)
        yield whole, _heads(whole, names)


def _joined(parts: list[pa.RecordBatch]) -> pa.RecordBatch:
    return parts[0] if len(parts) == 1 else pa.Table.from_batches(parts).combine_chunks().to_batches()[0]


def first_from(heads: np.ndarray, times: np.ndarray, groups: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    """For each (group, wanted time) the place of the group's first time that is not earlier, or of the end of the group."""
    values = np.unique(np.concatenate([times, wanted]))
    own = np.repeat(np.arange(len(heads)), np.diff(np.append(heads, len(times))))
    keys = own * (len(values) + 1) + np.searchsorted(values, times)
    return np.searchsorted(keys, groups * (len(values) + 1) + np.searchsorted(values, wanted))


def _pointers(heads: np.ndarray, times: np.ndarray, ttl: int) -> np.ndarray:
    """The place of the next time that may be kept after each, or the number of all times; one more entry points to itself."""
    sizes = np.diff(np.append(heads, len(times)))
    own, ends = np.repeat(np.arange(len(heads)), sizes), np.repeat(heads + sizes, sizes)
    found = first_from(heads, times, own, times + ttl)
    return np.append(np.where(found < ends, found, len(times)), len(times))


def exits_of(heads: np.ndarray, times: np.ndarray, ttl: int) -> np.ndarray:
    """For each time the earliest time that may be kept after a chain from there has left its group."""
    following, last = _pointers(heads, times, ttl), np.arange(len(times) + 1)
    while (following[:-1] < len(times)).any():
        inside = following < len(times)
        last[inside] = last[following[inside]]
        following = following[following]
    return times[last[:-1]] + ttl


def kept_of(heads: np.ndarray, times: np.ndarray, ttl: int, earliest: np.ndarray | None = None) -> np.ndarray:
    """Places of the times that the chains keep; the chain of a group begins at its first time that is not before ``earliest``."""
    starts, ends = heads, np.append(heads, len(times))[1:]
    if earliest is not None:
        starts = first_from(heads, times, np.arange(len(heads)), earliest)
        starts = starts[starts < ends]
    following, kept = _pointers(heads, times, ttl), np.zeros(len(times) + 1, bool)
    kept[starts] = True
    while (following[:-1] < len(times)).any():
        kept[following[kept]] = True
        following = following[following]
    return np.flatnonzero(kept[:-1])


def _leaving(names: list[str], ttl: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """The rows of a block at which a chain may enter it, with the time at which it leaves."""

    def leave(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, heads in whole_groups(batches, names):
            block, at = rows.column("_block").to_numpy(), rows.column("_at").to_numpy()
            exits = exits_of(heads, at, ttl)
            own = np.repeat(np.arange(len(heads)), np.diff(np.append(heads, len(at))))
            # an entry lies before the first life time is over, or is the first time after it; a first block has one entry
            chosen = (at <= (at[heads] // ttl + 1)[own] * ttl) & (block > 0)
            chosen[1:] |= chosen[:-1] & (own[1:] == own[:-1]) & (block[1:] > 0)
            chosen[heads] = True
            places = np.flatnonzero(chosen)
            again = (own[places][1:] == own[places][:-1]) & (exits[places][1:] == exits[places][:-1])
            places = places[~np.append(again, False)]
            found = rows.take(pa.array(places))
            yield pa.RecordBatch.from_arrays([*found.columns, pa.array(exits[places])], [*found.schema.names, "_exit"])

    return leave


def _entering(key: str) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """The entry of each block of a key, from the exits of its blocks in order."""

    def enter(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, heads in whole_groups(batches, [key]):
            block, at, exits = (rows.column(c).to_numpy() for c in ("_block", "_at", "_exit"))
            change = np.diff(block, prepend=block[0] - 1) != 0
            change[heads] = True
            firsts, fresh = np.flatnonzero(change), set(heads.tolist())
            entries, earliest = [], _FIRST
            for begin, end in zip(firsts.tolist(), [*firsts[1:].tolist(), len(block)], strict=True):
                if begin in fresh:
                    earliest = _FIRST
                entries.append(earliest)
                found = begin + int(np.searchsorted(at[begin:end], earliest))
                if found < end:
                    earliest = int(exits[found])
            found = rows.take(pa.array(firsts))
            yield pa.RecordBatch.from_arrays([found.column(key), found.column("_block"), pa.array(entries, pa.int64())], [key, "_block", "_entry"])

    return enter


def _following(names: list[str], ttl: int, key: str) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """The kept times of sorted groups."""

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, heads in whole_groups(batches, names):
            entry = rows.column("_entry").fill_null(_FIRST).to_numpy()[heads] if "_entry" in rows.schema.names else None
            kept = kept_of(heads, rows.column("_at").to_numpy(), ttl, entry)
            yield rows.take(pa.array(kept)).select([key, "_at"])

    return keep


def _gathered(df: DataFrame, names: list[str]) -> DataFrame:
    """Each group of equal ``names`` whole in one task, sorted by them and by time.

    The rows are dealt by a hash of the names. Dealt by the names themselves after a join on them, Spark leaves the second shuffle out, and when it then
    turns the join into a broadcast join, its tasks read the first shuffle by its writers, which cuts the groups.
    """
    return df.repartition(F.xxhash64(*names)).sortWithinPartitions(*names, "_at")


def _in_blocks(times: DataFrame, key: str, ttl: int, block_rows: int) -> DataFrame:
    """The kept times of keys with more rows than a block."""
    times = times.distinct().withColumn("_slice", F.floor(F.col("_at") / F.lit(ttl)).cast("bigint"))
    counts = times.groupBy(key, "_slice").agg(F.count("*").alias("_rows"))
    earlier = W.partitionBy(key).orderBy("_slice").rowsBetween(W.unboundedPreceding, -1)
    numbered = counts.select(key, "_slice", F.floor(F.coalesce(F.sum("_rows").over(earlier), F.lit(0)) / F.lit(block_rows)).cast("bigint").alias("_block"))
    placed = settle(times.join(numbered, [key, "_slice"]).select(key, "_block", "_at"))
    names, long, schema = [key, "_block"], T.LongType(), placed.schema
    exits = (_gathered(placed, names)
             .mapInArrow(_leaving(names, ttl), T.StructType([*schema, T.StructField("_exit", long)])))
    entries = (exits.repartition(key).sortWithinPartitions(*names, "_at")
               .mapInArrow(_entering(key), T.StructType([schema[key], schema["_block"], T.StructField("_entry", long)])))
    ready = _gathered(placed.join(entries, names, "left"), names)
    return ready.mapInArrow(_following(names, ttl, key), T.StructType([schema[key], schema["_at"]]))


def chain_times(df: DataFrame, key: str, ts: str, ttl_seconds: int, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """The kept times of every key as distinct (``key``, ``_at``), in microseconds; rows without key or time have none."""
    ttl, name = ttl_seconds * 1_000_000, "_key"
    times = df.select(F.col(key).alias(name), micros(df, ts).alias("_at")).where(F.col(name).isNotNull() & F.col("_at").isNotNull())
    spans = settle(times.groupBy(name).agg(F.min("_at").alias("_at"), F.max("_at").alias("_last"), F.count("*").alias("_rows")))
    chained = F.col("_last") - F.col("_at") >= ttl
    kept = spans.where(~chained).select(name, "_at")
    longer = settle(spans.where(chained).select(name, "_rows"))  # a table of its own, so that its true size decides how it is joined
    sizes = longer.agg(F.count_if(F.col("_rows") <= block_rows).alias("few"), F.count_if(F.col("_rows") > block_rows).alias("many")).first()
    if sizes["few"]:
        own = times.join(longer.where(F.col("_rows") <= block_rows).select(name), name, "left_semi")
        kept = kept.union(_gathered(own, [name]).mapInArrow(_following([name], ttl, name), own.schema))
    if sizes["many"]:
        own = times.join(longer.where(F.col("_rows") > block_rows).select(name), name, "left_semi")
        kept = kept.union(_in_blocks(own, name, ttl, block_rows))
    return kept.withColumnRenamed(name, key)
