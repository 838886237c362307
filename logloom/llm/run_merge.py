"""Exact repeats by a tree-merge of sorted digest runs.

Every input partition gives one run: its (digest, row) pairs in digest order. A run is cut into
slices by digest, as many slices as there are runs, so that the part of a slice that reaches the
root of its tree is no larger than one input partition, whatever the size of the input. In each
round the runs ``i * FAN`` to ``i * FAN + FAN - 1`` of a slice meet, are merged in digest order, and
of equal digests only the smallest identifier and the number of rows go on. A text that makes up a
third of all rows is therefore one entry per run after the first merge. The answer goes down the same
tree: at each level an entry looks up its one parent, so no join key is hot.

Equality is SHA-256 of the normalised text, verified at every merge by the number of bytes and
a second, unrelated 64-bit hash: entries that agree in the digest only are never merged.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from logloom.functions.names import unused
from logloom.session import settle

from .blocks import IDS_SENT

#: Runs that meet in one round.
FAN = 16

_ENTRY = ["slice", "run", "digest", "bytes", "check"]
_ROW = ["unnamed", "doc_id", "place"]
_SCHEMA = ("slice bigint, run bigint, digest binary, bytes bigint, check bigint, "
           "unnamed boolean, doc_id bigint, place bigint, rows bigint")


def normalised(text):
    """Null as empty, each run of ASCII white space as one space."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), r"[ \x09-\x0D]{2,}|[\x09-\x0D]", " ")


def _merge_sorted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of equal neighbouring entries the first, with the sum of their rows; holds one batch."""
    held = None
    for batch in batches:
        table = pa.Table.from_batches([batch] if held is None else [held, batch.cast(held.schema)]).combine_chunks()
        if table.num_rows == 0:
            continue
        other = np.zeros(table.num_rows, bool)
        other[0] = True
        for name in _ENTRY:
            column = table.column(name)
            other[1:] |= pc.not_equal(column.slice(1), column.slice(0, table.num_rows - 1)).to_numpy()
        firsts = np.flatnonzero(other)
        rows = np.add.reduceat(table.column("rows").to_numpy(), firsts)
        merged = table.take(pa.array(firsts)).drop_columns(["rows"]).append_column("rows", pa.array(rows))
        merged = merged.combine_chunks().to_batches()[0]
        yield merged.slice(0, merged.num_rows - 1)
        held = merged.slice(merged.num_rows - 1)
    if held is not None:
        yield held


def _meet(entries: DataFrame) -> DataFrame:
    """One round: ``FAN`` neighbouring runs of a slice become one."""
    shared = entries.withColumn("run", F.expr(f"run div {FAN}")).repartition("slice", "run")
    return shared.sortWithinPartitions(*_ENTRY, *_ROW).mapInArrow(_merge_sorted, _SCHEMA)


def exact_groups(docs: DataFrame) -> DataFrame:
    """For each row of ``docs`` (doc_id, text): doc_id, keep_id, group_size, kept, text_sha256.

    Texts are equal when they are the same after normalisation; a null text is empty, and all empty
    texts are equal. The row with the smallest doc_id stays; a row without doc_id stays only if its
    group has no other; of rows that repeat id and text exactly one stays. An empty table gives no rows.
    Other columns of ``docs`` are not read.
    """
    text = normalised(docs["text"])
    rows = settle(docs.select(
        docs["doc_id"].cast("bigint").alias("doc_id"), F.sha2(text, 256).alias("text_sha256"),
        F.octet_length(text).cast("bigint").alias("bytes"), F.xxhash64(text).alias("check"),
        F.spark_partition_id().cast("bigint").alias("run"), F.monotonically_increasing_id().alias("place")))
    last = rows.agg(F.max("run")).first()[0] or 0
    entries = rows.select(
        F.pmod("check", F.lit(last + 1)).alias("slice"), "run", F.unhex("text_sha256").alias("digest"), "bytes", "check",
        F.col("doc_id").isNull().alias("unnamed"), "doc_id", "place", F.lit(1).cast("bigint").alias("rows"))
    levels = [settle(_meet(entries))]
    while last >= FAN:
        last //= FAN
        if last:
            levels.append(settle(_meet(levels[-1])))
    found = _named(levels.pop())
    while levels:
        child = levels.pop()
        found = (child.drop("rows", *_ROW).withColumnRenamed("run", "own")
                 .withColumn("run", F.expr(f"own div {FAN}")).join(found, _ENTRY).drop("run").withColumnRenamed("own", "run"))
    child = entries.withColumn("run", F.expr(f"run div {FAN}")).drop("rows")
    return child.join(found, _ENTRY).select(
        "doc_id", "keep_id", "group_size", (F.col("place") == F.col("keep_place")).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"))


def _named(root: DataFrame) -> DataFrame:
    return root.select(*_ENTRY, F.col("doc_id").alias("keep_id"), F.col("place").alias("keep_place"),
                       F.col("rows").alias("group_size"))


def keep_first(docs: DataFrame) -> DataFrame:
    """``docs`` without the rows that :func:`exact_groups` drops; all columns stay as they are.

    Rows are looked up by id and digest; only those that have both in common with another row are told apart, by a hash of all columns.
    """
    pair, copies, rank = (unused(name, docs) for name in ("_pair", "_copies", "_rank"))
    both = lambda doc_id, digest: F.sha2(F.concat(digest, F.lit(":"), F.coalesce(doc_id.cast("string"), F.lit("null"))), 256)
    found = exact_groups(docs).groupBy(both(F.col("doc_id"), F.col("text_sha256")).alias(pair)).agg(
        F.count("*").alias(copies), F.max("kept").alias("kept"))
    notable = settle(found.where(~F.col("kept") | (F.col(copies) > 1)))
    marked = docs.withColumn(pair, both(docs["doc_id"], F.sha2(normalised(docs["text"]), 256)))
    alone = _by_key(marked, notable.select(pair), pair, "left_anti")
    same = Window.partitionBy(pair).orderBy(F.xxhash64(*docs.columns))
    repeated = _by_key(marked, notable.where("kept").select(pair), pair, "left_semi").withColumn(rank, F.row_number().over(same))
    return alone.select(*docs.columns).union(repeated.where(F.col(rank) == 1).select(*docs.columns))


def _by_key(rows: DataFrame, keys: DataFrame, key: str, how: str) -> DataFrame:
    """``rows`` whose ``key`` is, or is not, among the settled ``keys``; the rows are only shuffled for more than ``IDS_SENT`` keys."""
    few = keys.limit(IDS_SENT + 1).count() <= IDS_SENT
    return rows.join(F.broadcast(keys) if few else keys.hint("shuffle_merge"), key, how)
