"""Windows over a key that may hold a large share of all rows.

A window partitioned by such a key would put all its rows into one task. Here the rows
are range-partitioned by key *and* order, which spreads a hot key over many tasks, and
the few facts that must cross a task border are carried separately.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window as W, functions as F
from pyspark.sql.window import WindowSpec

from ..functions.names import unused
from ..session import settle

BLOCK_ROWS = 500_000


def positioned(df: DataFrame, order: list[Column | str], name: str) -> DataFrame:
    """Rows with ``name``, their gapless position from 0 in the global ``order``.

    The rows are cut into ranges of similar size and sorted there; ``order`` should end in a unique column, then no range is too
    big. They are written once, so the sizes of the ranges, one number each, and the rows agree; that table has one row
    per range, which is why it may be broadcast.
    """
    place, part, start = (unused(column, df) for column in ("_place", "_part", "_start"))
    ranged = settle(df.repartitionByRange(*order).sortWithinPartitions(*order)
                    .withColumns({place: F.monotonically_increasing_id(), part: F.spark_partition_id()}))
    sizes = ranged.groupBy(part).agg(F.count(F.lit(1)).alias("rows"), F.min(place).alias("first"))
    before = F.sum("rows").over(W.orderBy(part).rowsBetween(W.unboundedPreceding, -1))
    starts = sizes.select(part, (F.coalesce(before, F.lit(0)) - F.col("first")).alias(start))
    return ranged.join(F.broadcast(starts), part).withColumn(name, F.col(place) + F.col(start)).drop(place, part, start)


def in_blocks(df: DataFrame, keys: list[str], order: list[str], block_rows: int, position: str = "_pos", home: str = "_home") -> DataFrame:
    """Rows in global (keys, order) order with their ``position`` and ``home``, their block of ``block_rows``.

    This spreads a hot key over many tasks.
    """
    placed = positioned(df, [*keys, *order], position)
    return placed.withColumn(home, F.floor(F.col(position) / block_rows).cast("bigint"))


def over_last_rows(df: DataFrame, keys: list[str], order: list[str], rows: int,
                   columns: dict[str, Callable[[WindowSpec], Column]],
                   block_rows: int = BLOCK_ROWS) -> DataFrame:
    """Window columns over the current and the ``rows - 1`` preceding rows of a key.

    The globally ordered rows are cut into blocks; the last ``rows - 1`` rows of a block
    are copied to the next one. The rows of a key follow each other, so every frame is
    complete inside one block, and no window group is longer than a block and its copies.
    """
    halo = rows - 1
    if halo >= block_rows:
        raise ValueError("a block must be longer than the frame")
    position, home, block = (unused(name, df) for name in ("_pos", "_home", "_block"))
    blocks = in_blocks(df, keys, order, block_rows, position, home)
    at_end = F.col(position) % block_rows >= block_rows - halo
    copied = blocks.withColumn(
        block, F.explode(F.when(at_end, F.array(home, F.col(home) + 1)).otherwise(F.array(home))))
    frame = W.partitionBy(*keys, block).orderBy(position).rowsBetween(-halo, W.currentRow)
    framed = copied.withColumns({name: make(frame) for name, make in columns.items()})
    return framed.filter(F.col(block) == F.col(home)).drop(position, home, block)


def running_sum_before(df: DataFrame, keys: list[str], order: list[str], value: Column,
                       out: str, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """Sum of ``value`` over all earlier rows of the key, 0 for the first.

    Summed inside each block, plus the sums of the key's earlier blocks: one number per
    key and block.
    """
    position, home, added, key, local, before = (unused(name, df) for name in ("_pos", "_home", "_v", "_key", "_local", "_before"))
    blocks = in_blocks(df, keys, order, block_rows, position, home).withColumns({added: value, key: F.struct(*keys)})
    sums = blocks.groupBy(key, home).agg(F.sum(added).alias("sum"))
    earlier = W.partitionBy(key).orderBy(home).rowsBetween(W.unboundedPreceding, -1)
    starts = sums.select(key, home, F.coalesce(F.sum("sum").over(earlier), F.lit(0)).alias(before))
    inside = W.partitionBy(key, home).orderBy(position).rowsBetween(W.unboundedPreceding, -1)
    summed = blocks.withColumn(local, F.coalesce(F.sum(added).over(inside), F.lit(0)))
    return summed.join(starts, [key, home]).select(
        *df.columns, (F.col(before) + F.col(local)).cast("bigint").alias(out))
