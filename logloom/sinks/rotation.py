"""Rotation of the cold tier: big or old partitions move to a compressed archive."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..functions.text import parse_size
from ..functions.time import Moment, as_datetime, before, moment
from ..sources.files import file_sizes
from .compaction import finish_compactions
from .layout import balanced, drop_files, drop_partitions, list_folder, table_exists

# The rotation limits and the stamp in a rotated name.
MAX_SIZE = "100MB"
MAX_AGE_HOURS = 24
STAMP = "yyyyMMdd-HHmmss"
STAMP_PY = "%Y%m%d-%H%M%S"
#: Folder of an archive with a note for each rotation that is under way; readers skip it.
NOTES = "_rotations"


def rotation_plan(files: DataFrame, as_of: Moment, max_size: str | int = MAX_SIZE,
                  max_age_hours: int = MAX_AGE_HOURS) -> DataFrame:
    """Files to rotate (``file_name, file_size, modified``) with the reason and the new name."""
    big = F.col("file_size") > parse_size(max_size)
    old = F.col("modified") < moment(before(as_of, hours=max_age_hours))
    suffix = F.concat(F.lit("-"), F.date_format(moment(as_of), STAMP), F.lit(".log.gz"))
    return files.filter(F.endswith(F.col("file_name"), F.lit(".log")) & (big | old)).select(
        "file_name", "file_size", "modified",
        F.when(big, "size").otherwise("age").alias("reason"),
        F.replace(F.col("file_name"), F.lit(".log"), suffix).alias("rotated_name"))


def _cold_files(spark: SparkSession, path: str) -> DataFrame:
    return file_sizes(spark, path, "*.json").withColumns({
        "level": F.regexp_extract("file_path", r"/level=([^/]+)/", 1),
        "date": F.regexp_extract("file_path", r"/date=([^/]+)/", 1),
    })


def _partitions_of(files: DataFrame) -> DataFrame:
    sums = files.groupBy("level", "date").agg(
        F.sum("file_size").alias("file_size"), F.max("modified").alias("_modified"))
    return sums.select(
        "level", "date", F.concat_ws("", "level", F.lit("-"), "date", F.lit(".log")).alias("file_name"),
        "file_size", F.col("_modified").cast("timestamp_ntz").alias("modified"))


def cold_partitions(spark: SparkSession, path: str) -> DataFrame:
    """Cold partitions with total size and last change, from the file listing alone."""
    return _partitions_of(_cold_files(spark, path))


def finish_rotations(spark: SparkSession, archive: str) -> None:
    """Complete or undo rotations that were interrupted, as their notes say.

    A note lists the files of a run before anything is moved. If the run's archive is committed, the listed files go;
    if not, what was written of it goes and the files stay.
    """
    for note in list_folder(spark, f"{archive}/{NOTES}"):
        run = note.rpartition("/")[2]
        if not table_exists(spark, f"{note}/_SUCCESS"):  # nothing was moved yet
            drop_partitions(spark, note, [""])
            continue
        rows = spark.read.schema("stamp string, file string").json(note).collect()
        folder = f"{archive}/rotated={rows[0]['stamp']}/run={run}" if rows else None
        if folder and table_exists(spark, f"{folder}/_SUCCESS"):
            drop_files(spark, [row["file"] for row in rows])
        elif folder:
            drop_partitions(spark, folder, [""])
        drop_partitions(spark, note, [""])


def rotate(spark: SparkSession, path: str, archive: str, as_of: Moment, max_size: str | int = MAX_SIZE,
           max_age_hours: int = MAX_AGE_HOURS, rows_per_file: int = 1_000_000) -> DataFrame:
    """Move due partitions to ``archive/rotated=<stamp>/run=<id>``, gzip-compressed; returns the plan that was applied.

    Lines are copied as they are. Only listed files are read and, once the archive is committed, only these are
    deleted, so a file that is appended meanwhile stays for the next run. A run that was interrupted at any step is
    completed or undone by the next one. One rotation of a table runs at a time.
    """
    finish_rotations(spark, archive)
    finish_compactions(spark, path)
    columns = ["level", "date", "file_name", "rotated_name", "reason"]
    files = spark.createDataFrame(_cold_files(spark, path).collect(), _cold_files(spark, path).schema)  # one listing
    listed = _partitions_of(files)
    due = rotation_plan(listed, as_of, max_size, max_age_hours).select("file_name", "rotated_name", "reason")
    chosen = listed.join(due, "file_name").select(*columns).collect()  # one entry per level and day
    if chosen:
        days = {(r["level"], r["date"]) for r in chosen}
        paths = [f["file_path"] for f in files.collect() if (f["level"], f["date"]) in days]
        run, stamp = uuid.uuid4().hex, as_datetime(as_of).strftime(STAMP_PY)
        spark.createDataFrame([(stamp, p) for p in paths], "stamp string, file string").coalesce(1).write.json(f"{archive}/{NOTES}/{run}")
        lines = spark.read.option("basePath", path).text(paths).select("value", "level", "date")
        (balanced(lines, "level", "date").write.option("compression", "gzip")
         .option("maxRecordsPerFile", rows_per_file).partitionBy("level", "date")
         .text(f"{archive}/rotated={stamp}/run={run}"))
        finish_rotations(spark, archive)
    return spark.createDataFrame(
        [tuple(r) for r in chosen],
        "level string, date string, file_name string, rotated_name string, reason string")
