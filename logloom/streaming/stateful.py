"""Operators of streams that remember a little of each key: repeats within a life time, and the last calls of an instance.

What is remembered is keyed state of Spark (``transformWithState``). Repeats keep the state of many keys together, so a batch costs what it brings
and the keys still alive in the buckets it meets. The state of a repeat goes when the watermark has passed its life time. Spark keeps such state with the RocksDB provider only, which
:func:`keep_state` chooses for a session.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from ..functions.names import unused
from ..operators.chains import kept_of
from ..operators.dedup import REPEAT_SECONDS
from ..operators.rolling import CALLS, MIN_CALLS, RATE_THRESHOLD

PROVIDER = "spark.sql.streaming.stateStore.providerClass"
ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
#: How late a row may come, by default, before the watermark drops it.
LATE = "1 hour"
#: Buckets of keys in the state of repeats. It changes no result.
BUCKETS = 2048
_NEVER, _OWN = -(1 << 62), "_logloom_key"


def keep_state(spark: SparkSession) -> None:
    """Keyed state in RocksDB, for the streams that this session starts from now on."""
    spark.conf.set(PROVIDER, ROCKS)


def _micros(times: pd.Series) -> np.ndarray:
    return times.to_numpy("datetime64[us]").astype(np.int64)


class _Repeats(StatefulProcessor):
    """Holds, in one Arrow table for a bucket of keys, the last kept time of each of them."""

    def __init__(self, key: str, ts: str, tie: str, ttl_seconds: int, given: list[str], columns: list[str]):
        self.key, self.ts, self.tie, self.ttl, self.given, self.columns = key, ts, tie, ttl_seconds * 1_000_000, given, columns

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle, self.seen = handle, handle.getValueState("seen", "ends bigint, entries binary")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        batch = pd.concat(list(rows), ignore_index=True).set_axis(self.given, axis=1)  # Spark numbers columns that begin with an underscore
        ends, entries = self.seen.get() if self.seen.exists() else (None, None)
        keys, remembered = batch[self.key], np.empty(0, np.int64)
        if entries is not None:
            held = pa.ipc.open_stream(bytes(entries)).read_all()
            keys, remembered = pd.concat([held["key"].to_pandas(), keys], ignore_index=True), held["at"].to_numpy()
        codes, names = pd.factorize(keys, use_na_sentinel=False)
        last = np.full(len(names), _NEVER)
        last[:len(remembered)] = remembered
        batch = batch.assign(**{_OWN: codes[len(remembered):]}).sort_values([_OWN, self.ts, self.tie])
        own, at = batch[_OWN].to_numpy(), _micros(batch[self.ts])
        fresh = np.flatnonzero((at < last[own]) | (at >= last[own] + self.ttl))
        if len(fresh):
            heads = np.flatnonzero(np.diff(own[fresh], prepend=-1))
            kept = fresh[kept_of(heads, at[fresh], self.ttl)]
            np.maximum.at(last, own[kept], at[kept])
            self._remember(ends, names, last, timerValues.getCurrentWatermarkInMs() * 1000)
            yield batch.iloc[kept][self.columns]

    def _remember(self, ends: int | None, names: pd.Index, last: np.ndarray, watermark: int) -> None:
        """The keys whose life time goes on, and a timer for the end of the longest."""
        alive = last + self.ttl > watermark
        until = -(-(int(last[alive].max()) + self.ttl) // 1000) if alive.any() else None
        if ends is not None and ends != until:
            self.handle.deleteTimer(ends)
        if until is None:
            self.seen.clear()
            return
        table = pa.table({"key": pa.Array.from_pandas(names[alive]), "at": last[alive]})
        sink = pa.BufferOutputStream()
        with pa.ipc.new_stream(sink, table.schema) as out:
            out.write_table(table)
        self.seen.update((until, sink.getvalue().to_pybytes()))
        if until != ends:
            self.handle.registerTimer(until)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        self.seen.clear()
        return iter(())

    def close(self) -> None:
        pass


def drop_repeats_stream(events: DataFrame, key: str = "content_hash", ts: str = "timestamp", tie: str = "id",
                        ttl_seconds: int = REPEAT_SECONDS, late: str = LATE, buckets: int = BUCKETS) -> DataFrame:
    """Rows that are no repeat of a kept row within its life time, as :func:`logloom.operators.dedup.drop_seen` decides batch by batch.

    Input comes in time order from batch to batch. Rows later than ``late`` are dropped by the watermark; rows without key or time are kept. Keys
    are dealt by their hash to ``buckets``, and Python is called once for a bucket and batch, not for each key. A task holds the rows that one
    batch brings of a bucket and the last kept times of its keys still alive, so bound the batches of the source. A checkpoint goes with its number of
    buckets. ``ts`` is a timestamp with zone.
    """
    judged = F.col(key).isNotNull() & F.col(ts).isNotNull()
    bucket, own = unused("_bucket", events), key
    dealt = events.where(judged).withColumn(bucket, F.pmod(F.xxhash64(key), F.lit(buckets)))
    if isinstance(events.schema[key].dataType, (T.ArrayType, T.StructType)):
        own = unused("_text", events)
        dealt = dealt.withColumn(own, F.to_json(F.struct(key)))
    kept = (dealt.withWatermark(ts, late).groupBy(bucket)
            .transformWithStateInPandas(_Repeats(own, ts, tie, ttl_seconds, dealt.columns, events.columns), events.schema, "Append", "EventTime"))
    return kept.unionByName(events.where(~judged))


class _Calls(StatefulProcessor):
    """Holds, oldest first, whether the last calls of an instance were bad."""

    def __init__(self, bad: str, order: list[str], window: int):
        self.bad, self.order, self.window = bad, order, window

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.ring = handle.getValueState("ring", "bits string")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        batch = pd.concat(list(rows)).sort_values(self.order, kind="stable")
        held = self.ring.get()[0] if self.ring.exists() else ""
        marks = np.concatenate([np.frombuffer(held.encode(), np.uint8) - ord("0"), batch[self.bad].fillna(False).to_numpy(bool)]).astype(np.int64)
        ends = np.arange(len(held) + 1, len(marks) + 1)
        begins = np.maximum(0, ends - self.window)
        sums = np.concatenate([[0], np.cumsum(marks)])
        self.ring.update(("".join(map(str, marks[-(self.window - 1):])) if self.window > 1 else "",))
        yield batch.assign(calls=ends - begins, bad_calls=sums[ends] - sums[begins])

    def close(self) -> None:
        pass


def bad_call_rate_stream(calls: DataFrame, bad: str, instance: str = "instance", order: list[str] | None = None,
                         window: int = CALLS, min_calls: int = MIN_CALLS, threshold: float = RATE_THRESHOLD) -> DataFrame:
    """Each call with the share of bad ones among the last ``window`` of its instance, as in :func:`logloom.operators.rolling.bad_call_rate`.

    Calls come in order from batch to batch; inside a batch they are put in ``order``. The boolean column ``bad`` says which are bad, null counts as not.
    """
    schema = T.StructType([*calls.schema.fields, T.StructField("calls", T.LongType()), T.StructField("bad_calls", T.LongType())])
    framed = calls.groupBy(instance).transformWithStateInPandas(_Calls(bad, order or ["timestamp", "id"], window), schema, "Append", "None")
    rate = F.col("bad_calls") / F.col("calls")
    return framed.withColumns({"rate": rate, "tripped": (F.col("calls") >= min_calls) & (rate >= threshold)})
