"""Sorting, pages and limits. Every order ends in a unique column, so pages are defined."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Row, functions as F

from ..functions.names import unused
from .filters import search, select_events
from .frames import positioned

# Default page sizes of the two query APIs and the search limit.
ACCESS_PAGE_SIZE = 20
EVENT_PAGE_SIZE = 50
SEARCH_LIMIT = 100


@dataclass(frozen=True)
class Page:
    """Rows of one page, and a one-row DataFrame with the number of matching rows."""

    content: DataFrame
    total: DataFrame


def sort_columns(df: DataFrame, sort_by: str = "timestamp", direction: str = "desc",
                 tie: str | list[str] = "id") -> list[Column]:
    if sort_by not in df.columns:
        raise ValueError(f"cannot sort by {sort_by!r}; columns are {', '.join(df.columns)}")
    if direction.lower() not in ("asc", "desc"):
        raise ValueError(f"direction is asc or desc, not {direction!r}")
    first = F.col(sort_by).desc() if direction.lower() == "desc" else F.col(sort_by).asc()
    ties = [tie] if isinstance(tie, str) else tie
    return [first, *[F.col(name).asc() for name in ties if name != sort_by]]


def page_of(df: DataFrame, page: int = 0, size: int = EVENT_PAGE_SIZE, sort_by: str = "timestamp",
            direction: str = "desc", tie: str | list[str] = "id") -> DataFrame:
    """Page ``page`` of ``size`` rows.

    Planned as a top-k: each task keeps its first ``(page + 1) * size`` rows. For deep
    pages use :func:`page_after`, whose cost does not grow with the page number.
    """
    if page < 0 or size < 1:
        raise ValueError("page starts at 0 and size at 1")
    return df.orderBy(*sort_columns(df, sort_by, direction, tie)).offset(page * size).limit(size)


def page_after(df: DataFrame, after: tuple[object, object] | None = None, size: int = EVENT_PAGE_SIZE,
               sort_by: str = "timestamp", direction: str = "desc", tie: str = "id") -> DataFrame:
    """The ``size`` rows that follow a known last row, given as (value of ``sort_by``, value of ``tie``); None is the first page.

    Rows without a value come last when descending and first when ascending, as in :func:`page_of`; ``tie`` has a value in every row.
    """
    order = sort_columns(df, sort_by, direction, tie)
    if after is not None:
        value = after[0]
        column, later = F.col(sort_by), F.col(tie) > F.lit(after[1])
        descending = direction.lower() == "desc"
        if value is None:
            beyond = column.isNull() & later
            df = df.filter(beyond if descending else beyond | column.isNotNull())
        else:
            known = F.lit(value).cast(df.schema[sort_by].dataType)
            if descending:
                df = df.filter((column <= known) & ((column < known) | later) | column.isNull())
            else:
                df = df.filter((column >= known) & ((column > known) | later))
    return df.orderBy(*order).limit(size)


def walk(df: DataFrame, size: int = EVENT_PAGE_SIZE, sort_by: str = "timestamp", direction: str = "desc",
         tie: str = "id") -> Iterator[list[Row]]:
    """All pages of ``df`` in order, each fetched after the last row of the page before; the caller holds one page."""
    after = None
    while rows := page_after(df, after, size, sort_by, direction, tie).collect():
        yield rows
        after = (rows[-1][sort_by], rows[-1][tie])


def numbered_pages(df: DataFrame, size: int = EVENT_PAGE_SIZE, sort_by: str = "timestamp", direction: str = "desc",
                   tie: str | list[str] = "id") -> DataFrame:
    """Every row with ``page``, the number of the page of ``size`` rows, from 0, that :func:`page_of` would show it on."""
    position = unused("_position", df)
    placed = positioned(df, sort_columns(df, sort_by, direction, tie), position)
    return placed.withColumn("page", F.floor(F.col(position) / size).cast("bigint")).drop(position)


def total_of(df: DataFrame) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("total"))


def query_events(df: DataFrame, page: int = 0, size: int = EVENT_PAGE_SIZE, sort_by: str = "timestamp",
                 direction: str = "desc", tie: str | list[str] = "id", **conditions) -> Page:
    """Filtered, sorted page together with the total."""
    found = select_events(df, **conditions)
    return Page(page_of(found, page, size, sort_by, direction, tie), total_of(found))


def search_events(df: DataFrame, keyword: str, limit: int = SEARCH_LIMIT, tie: str = "id") -> DataFrame:
    """Newest matches of a keyword."""
    return page_of(search(df, keyword), 0, limit, tie=tie)


def access_by_ip(df: DataFrame, ip_address: str, page: int = 0, size: int = ACCESS_PAGE_SIZE,
                 tie: str | list[str] = "id") -> DataFrame:
    return page_of(select_events(df, ip_address=ip_address), page, size, tie=tie)


def access_by_status(df: DataFrame, status_code: int, page: int = 0, size: int = ACCESS_PAGE_SIZE,
                     tie: str | list[str] = "id") -> DataFrame:
    return page_of(select_events(df, status_code=status_code), page, size, tie=tie)
