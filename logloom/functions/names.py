"""Names for helper columns that no column of the caller has."""

from __future__ import annotations

from pyspark.sql import DataFrame


def unused(name: str, *frames: DataFrame) -> str:
    """``name``, or it with underscores behind, so that no column of ``frames`` is called that, in either case."""
    taken = {column.lower() for frame in frames for column in frame.columns}
    while name.lower() in taken:
        name += "_"
    return name
