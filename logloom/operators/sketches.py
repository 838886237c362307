"""Latency percentiles that can be rolled up: one small sketch per window, stored as binary and merged into longer windows."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..functions.time import bucket, from_epoch_seconds

#: Size of a sketch: a quantile's rank is off by less than 0.7 % of the calls, with a chance of 99 %.
SIZE = 400


def latency_sketches(df: DataFrame, duration: str = "response_time", width_seconds: int = 300, ts: str = "timestamp",
                     size: int = SIZE) -> DataFrame:
    """``window_start, calls, sketch`` for each window; rows without time or duration are not counted. Tasks combine before the shuffle."""
    measured = df.filter(F.col(duration).isNotNull() & F.col(ts).isNotNull())
    found = measured.groupBy(bucket(F.col(ts), width_seconds).alias("w")).agg(
        F.count(F.lit(1)).alias("calls"), F.kll_sketch_agg_double(F.col(duration).cast("double"), size).alias("sketch"))
    return found.select(from_epoch_seconds(F.col("w") * width_seconds).alias("window_start"), "calls", "sketch")


def rolled_up(sketches: DataFrame, width_seconds: int, size: int = SIZE) -> DataFrame:
    """The same for longer windows, from the sketches alone; ``width_seconds`` is a multiple of their width."""
    found = sketches.groupBy(bucket(F.col("window_start"), width_seconds).alias("w")).agg(
        F.sum("calls").alias("calls"), F.kll_merge_agg_double("sketch", size).alias("sketch"))
    return found.select(from_epoch_seconds(F.col("w") * width_seconds).alias("window_start"), "calls", "sketch")


def sketch_percentiles(sketches: DataFrame, percents: tuple[float, ...] = (0.5, 0.95)) -> DataFrame:
    """``window_start, calls`` and a column for each percentile, named as in :func:`logloom.operators.stats.latency_percentiles`."""
    return sketches.select("window_start", "calls", *[
        F.kll_sketch_get_quantile_double("sketch", F.lit(float(p))).alias(f"p{p * 100:g}".replace(".", "_")) for p in percents])
