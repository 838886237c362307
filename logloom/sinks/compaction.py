"""Merging the batch folders of a stored table, so that a stream's many small writes become few big files.

A stream writes one folder ``.../batch=<n>`` for each batch and partition. :func:`compact` copies the folders of all batches before
a given one into one folder per partition, in four steps: the copy is written out of sight, a note lists the folders that it stands for,
the folders are deleted and the copy is moved to their place, and the note goes. From the committed note on the copy is the table: readers that use
:func:`stored` see every row once at any moment, and whatever was interrupted is completed, or undone if there was no note yet, by the
next run. One process writes to a table at a time; batches that a stream may run again must not be merged, so leave out the last one.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..operators.latest import latest_per_key
from ..sources.files import file_sizes
from .layout import NULL_PARTITION, balanced, drop_partitions, list_folder, lookup_options, move_folder, table_exists

#: Folders of a table that readers of Spark skip: notes of compactions under way, and their copies.
NOTES, COPIES = "_compactions", "_copies"
_NOTE = "folder string, number int, merged array<int>"


def _open_notes(spark: SparkSession, path: str) -> dict[str, list]:
    """Committed notes, by run, with a row for each partition."""
    notes = [note for note in list_folder(spark, f"{path}/{NOTES}") if table_exists(spark, f"{note}/_SUCCESS")]
    return {note.rpartition("/")[2]: spark.read.schema(_NOTE).json(note).collect() for note in notes}


def finish_compactions(spark: SparkSession, path: str) -> None:
    """Complete what has a note, and delete copies without one."""
    notes = _open_notes(spark, path)
    for run, rows in notes.items():
        for row in rows:
            copy, place = f"{path}/{COPIES}/{run}/{row['folder']}/batch={row['number']}", f"{path}/{row['folder']}"
            if table_exists(spark, copy):  # else it was moved, and the others were deleted before
                drop_partitions(spark, place, [f"batch={n}" for n in {*row["merged"], row["number"]}])
                move_folder(spark, copy, f"{place}/batch={row['number']}")
    for run in notes:
        drop_partitions(spark, f"{path}/{NOTES}", [run])
    for left in [*list_folder(spark, f"{path}/{NOTES}"), *list_folder(spark, f"{path}/{COPIES}")]:
        drop_partitions(spark, left, [""])


def _read(spark: SparkSession, path: str, fmt: str, like: DataFrame | None = None) -> DataFrame:
    reader = spark.read.format(fmt)
    return (reader if like is None else reader.schema(like.schema)).load(path)


def _partition_of(folder: str) -> list[str | None]:
    values = [part.partition("=")[2] for part in folder.split("/")]
    return [None if value == NULL_PARTITION else value for value in values]


def stored(spark: SparkSession, path: str, columns: list[str] | None = None, fmt: str = "parquet") -> DataFrame:
    """The table as it is now, also while its folders are being merged; partitioned by ``columns`` (by default ``date``) and ``batch``."""
    columns, table = columns or ["date"], _read(spark, path, fmt)
    for run, rows in _open_notes(spark, path).items():
        hidden = {row["folder"]: table_exists(spark, f"{path}/{COPIES}/{run}/{row['folder']}/batch={row['number']}") for row in rows}
        gone = [(*_partition_of(row["folder"]), n) for row in rows for n in {*row["merged"], row["number"]}
                if hidden[row["folder"]] or n != row["number"]]
        names = [f"{column}_gone" for column in columns]
        left_out = spark.createDataFrame(gone, ", ".join(f"{name} string" for name in names) + ", batch_gone int")
        same = table["batch"] == left_out["batch_gone"]
        for column, name in zip(columns, names, strict=True):
            same &= table[column].cast("string").eqNullSafe(left_out[name])
        kept = table.join(left_out, same, "left_anti")
        table = kept.unionByName(_read(spark, f"{path}/{COPIES}/{run}", fmt, table)) if any(hidden.values()) else kept
    return table


def due_folders(spark: SparkSession, path: str, below: int, least: int = 2) -> DataFrame:
    """Partitions with at least ``least`` folders of batches before ``below``: folder, the batches in it and their bytes. Only listings are read."""
    files = file_sizes(spark, path, "part-*").select(
        F.regexp_extract("file_path", r"((?:[^/]+=[^/]*/)+)batch=-?\d+/[^/]*$", 1).alias("folder"),
        F.regexp_extract("file_path", r"/batch=(-?\d+)/[^/]*$", 1).cast("int").alias("batch"), "file_size")
    found = files.where(F.col("batch") < below).groupBy(F.rtrim("folder", F.lit("/")).alias("folder")).agg(
        F.sort_array(F.collect_set("batch")).alias("merged"), F.sum("file_size").alias("bytes"))
    return found.where(F.size("merged") >= least)


def copy_folders(spark: SparkSession, path: str, below: int, columns: list[str], fmt: str, within: list[str],
                 reduce: Callable[[DataFrame], DataFrame] | None, least: int, **options: str) -> bool:
    """The first two steps of a compaction: the copies and the note. False if there is nothing to merge."""
    due = due_folders(spark, path, below, least).collect()  # a row a partition, not a file
    if not due:
        return False
    run, number = uuid.uuid4().hex, below - 1
    paths = [f"{path}/{row['folder']}/batch={n}" for row in due for n in row["merged"]]
    rows = spark.read.option("basePath", path).format(fmt).load(paths)
    copies = balanced((reduce(rows) if reduce else rows).withColumn("batch", F.lit(number)), *columns)
    if within:
        copies = copies.sortWithinPartitions(*columns, *within)
    copies.write.options(**options).partitionBy(*columns, "batch").format(fmt).save(f"{path}/{COPIES}/{run}")
    note = spark.createDataFrame([(row["folder"], number, row["merged"]) for row in due], _NOTE)
    note.coalesce(1).write.json(f"{path}/{NOTES}/{run}")
    return True


def compact(spark: SparkSession, path: str, below: int, columns: list[str] | None = None, fmt: str = "parquet", within: list[str] | None = None,
            reduce: Callable[[DataFrame], DataFrame] | None = None, least: int = 2, **options: str) -> bool:
    """Merge the folders of all batches before ``below`` in each partition of ``columns`` that has ``least`` or more of them.

    The merged rows get the number ``below - 1``, so later batches are still later. ``reduce`` may leave out rows that no reader needs any
    more; it must keep at least one in each partition. Returns whether there was anything to merge.
    """
    finish_compactions(spark, path)
    done = copy_folders(spark, path, below, columns or ["date"], fmt, within or [], reduce, least, **options)
    finish_compactions(spark, path)
    return done


def compact_warm(spark: SparkSession, path: str, below: int) -> bool:
    """The warm table, sorted and with its filters for lookups as it was written."""
    return compact(spark, path, below, within=["timestamp"], **lookup_options(_read(spark, path, "parquet")))


def compact_hot(spark: SparkSession, path: str, below: int) -> bool:
    """The hot tier: of the documents of a trace id on one day the last one written."""
    written = [F.col("batch").desc(), F.col("timestamp").desc_nulls_last(), F.col("document").desc()]
    return compact(spark, path, below, reduce=lambda rows: latest_per_key(rows, ["date", "trace_id"], written))


def compact_cold(spark: SparkSession, path: str, below: int) -> bool:
    """The cold tier: lines are copied as they are."""
    return compact(spark, path, below, ["level", "date"], "text")
