"""Defaults, stamps and derived columns for incoming events."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.text import content_hash, preview
from ..functions.time import Moment, moment

# Stamps of a collected line.
DEFAULT_HOST = "localhost"
COLLECTOR_SERVICE = "log-collector"


def _with_default(df: DataFrame, name: str, value: Column) -> DataFrame:
    current = F.col(name) if name in df.columns else F.lit(None)
    return df.withColumn(name, F.coalesce(current, value))


def fill_id(df: DataFrame, name: str = "id", from_columns: list[str] | None = None) -> DataFrame:
    """Give rows without id one: random, or the hash of ``from_columns`` so that a replay repeats it."""
    if from_columns is None:
        return _with_default(df, name, F.expr("uuid()"))
    parts = [F.coalesce(F.col(c).cast("string"), F.lit("\x00")) for c in from_columns]
    return _with_default(df, name, F.sha2(F.concat_ws("\x1f", *parts), 256))


def fill_trace_id(df: DataFrame, from_columns: list[str] | None = None) -> DataFrame:
    return fill_id(df, "trace_id", from_columns)


def fill_timestamp(df: DataFrame, as_of: Moment, name: str = "timestamp") -> DataFrame:
    return _with_default(df, name, moment(as_of))


def stamp(df: DataFrame, as_of: Moment, name: str = "processed_at") -> DataFrame:
    return df.withColumn(name, moment(as_of))


def prepare_events(df: DataFrame, as_of: Moment, id_from: list[str] | None = None) -> DataFrame:
    """What ingest does to single events and batches alike: id, trace id and time, where missing."""
    return fill_timestamp(fill_trace_id(fill_id(df, "id", id_from), id_from), as_of)


def stamp_file_event(df: DataFrame, as_of: Moment, hostname: str = DEFAULT_HOST,
                     service_name: str = COLLECTOR_SERVICE) -> DataFrame:
    """Turn ``file_path, content, file_offset`` into a full file event.

    The id joins path hash, offset and read time; the content hash is what repeats
    are recognized by.
    """
    return df.withColumns({
        "timestamp": moment(as_of),
        "hostname": F.lit(hostname),
        "service_name": F.lit(service_name),
        "content_hash": content_hash(F.col("content")),
        "id": F.concat_ws(
            "-",
            F.sha2(F.col("file_path"), 256),
            F.col("file_offset").cast("string"),
            F.date_format(moment(as_of), "yyyy-MM-dd'T'HH:mm:ss")),
        "preview": preview(F.col("content")),
    })


def too_wide(df: DataFrame, widths: dict[str, int]) -> DataFrame:
    """How many values exceed the declared width of their column, one row per column."""
    checked = [(name, width) for name, width in widths.items() if name in df.columns]
    counts = df.agg(*[F.count_if(F.length(name) > width).alias(name) for name, width in checked])
    return counts.select(F.explode(F.array(*[
        F.struct(F.lit(name).alias("column_name"), F.lit(width).alias("width"), F.col(name).alias("too_wide"))
        for name, width in checked
    ])).alias("_row")).select("_row.*")
