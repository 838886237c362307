"""Latest row per key."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window as W, functions as F, types as T

from ..functions.names import unused


#: The longest rank limit that Spark itself applies before a shuffle.
_CUT_BEFORE_SHUFFLE = 1000


def _first_rows(df: DataFrame, keys: list[Column | str], order: list[Column | str], limit: int) -> DataFrame:
    rank = unused("_rank", df)
    numbered = df.withColumn(rank, F.row_number().over(W.partitionBy(*keys).orderBy(*order)))
    return numbered.filter(F.col(rank) <= limit).drop(rank)


def first_of_each(df: DataFrame, keys: list[Column | str], order: list[Column | str], limit: int) -> DataFrame:
    """The first ``limit`` rows of each key in ``order``.

    The rank filter is planned as a limit inside each group that already runs before
    the shuffle, so a key with very many rows sends at most ``limit`` of them per task. Spark does so up to a
    limit of 1000; for a longer one the rows of each input task are cut first, by a shuffle that splits a key by its tasks.
    """
    if limit > _CUT_BEFORE_SHUFFLE:
        task = unused("_task", df)
        df = _first_rows(df.withColumn(task, F.spark_partition_id()), [*keys, task], order, limit).drop(task)
    return _first_rows(df, keys, order, limit)


def latest_per_key(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """One row per key: the first in ``order``."""
    return first_of_each(df, keys, order, 1)


def newest(df: DataFrame, keys: list[str], ts: str = "timestamp", tie: str | None = None) -> DataFrame:
    order = [F.col(ts).desc_nulls_last()]
    if tie is not None:
        order.append(F.col(tie).desc_nulls_last())
    return latest_per_key(df, keys, order)


def upsert(existing: DataFrame, batch: DataFrame, key: str = "id", version: str = "processed_at",
           arrival: str | None = None) -> DataFrame:
    """Existing rows overlaid by a batch: last write wins, and writing a batch twice changes nothing.

    On equal versions the later ``arrival`` wins (a topic offset, say), without one the batch, as it was
    written later; what is equal in all of this is decided by the other columns, so the order of the input never matters. Rows
    without key are no versions of each other; each of them stays.
    """
    late = unused("_late", existing, batch)
    both = existing.withColumn(late, F.lit(0)).unionByName(
        batch.withColumn(late, F.lit(1)), allowMissingColumns=True)
    order = [version, *([arrival] if arrival else []), late]
    rest = [F.array_sort(F.map_entries(f.name)) if isinstance(f.dataType, T.MapType) else F.col(f.name)
            for f in both.schema.fields if f.name not in (key, *order)]
    ranked = latest_per_key(both.filter(F.col(key).isNotNull()), [key],
                            [*[F.col(c).desc_nulls_last() for c in order], *[c.desc_nulls_last() for c in rest]])
    return ranked.unionByName(both.filter(F.col(key).isNull())).drop(late)
