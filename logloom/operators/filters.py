"""Predicates of the query API, each a plain filter that Catalyst can push to the scan.

Tables written by this library carry a ``date`` partition column and the time once more
as ``epoch_s``, whole seconds. When the input has them, every time bound is repeated on
them: the first skips whole partitions, the second skips row groups inside files, which
a bound on a zone-less timestamp does not.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.text import contains_ignore_case, like_keyword
from ..functions.time import Moment, as_datetime, as_epoch_seconds, before, moment

DAY, EPOCH = "date", "epoch_s"
# Levels that always go to the cold tier, and the age that makes any event cold.
COLD_LEVELS = ["ERROR", "WARN"]
COLD_AGE_DAYS = 7


def all_of(conditions: list[Column]) -> Column:
    return reduce(lambda a, b: a & b, conditions, F.lit(True))


def time_conditions(df: DataFrame, start: Moment | None = None, end: Moment | None = None,
                    after: Moment | None = None, ts: str = "timestamp") -> list[Column]:
    """``start`` and ``end`` are inclusive, ``after`` is strict."""
    time = F.col(ts)
    bounds = [
        (start, lambda v: time >= moment(v), lambda column, v: column >= v),
        (after, lambda v: time > moment(v), lambda column, v: column >= v),
        (end, lambda v: time <= moment(v), lambda column, v: column <= v),
    ]
    conditions: list[Column] = []
    for value, exact, coarse in bounds:
        if value is None:
            continue
        conditions.append(exact(value))
        if DAY in df.columns:
            conditions.append(coarse(F.col(DAY), F.lit(as_datetime(value).date())))
        if EPOCH in df.columns:
            conditions.append(coarse(F.col(EPOCH), F.lit(as_epoch_seconds(value))))
    return conditions


def select_events(df: DataFrame, *, level: str | None = None, source: str | None = None,
                  organization_id: str | None = None, trace_id: str | None = None,
                  ip_address: str | None = None, status_code: int | None = None,
                  keyword: str | None = None, start: Moment | None = None, end: Moment | None = None,
                  after: Moment | None = None, ts: str = "timestamp") -> DataFrame:
    """Keep the rows that meet every given condition; without conditions keep all rows."""
    equal = {
        "level": level, "source": source, "organization_id": organization_id,
        "trace_id": trace_id, "ip_address": ip_address, "status_code": status_code,
    }
    conditions = [F.col(name) == F.lit(value) for name, value in equal.items() if value is not None]
    conditions += time_conditions(df, start, end, after, ts)
    if keyword is not None:
        conditions.append(contains_ignore_case(F.col("message"), keyword))
    return df.filter(all_of(conditions))


def by_level(df: DataFrame, level: str) -> DataFrame:
    return select_events(df, level=level)


def by_source(df: DataFrame, source: str) -> DataFrame:
    return select_events(df, source=source)


def by_level_and_source(df: DataFrame, level: str, source: str) -> DataFrame:
    return select_events(df, level=level, source=source)


def between(df: DataFrame, start: Moment, end: Moment) -> DataFrame:
    """Both ends inclusive."""
    return select_events(df, start=start, end=end)


def by_organization_between(df: DataFrame, organization_id: str, start: Moment, end: Moment) -> DataFrame:
    return select_events(df, organization_id=organization_id, start=start, end=end)


def by_level_after(df: DataFrame, level: str, after: Moment) -> DataFrame:
    return select_events(df, level=level, after=after)


def by_source_after(df: DataFrame, source: str, after: Moment) -> DataFrame:
    return select_events(df, source=source, after=after)


def recent_by_ip(df: DataFrame, ip_address: str, since: Moment) -> DataFrame:
    """At or after ``since``."""
    return select_events(df, ip_address=ip_address, start=since)


def search(df: DataFrame, keyword: str) -> DataFrame:
    return select_events(df, keyword=keyword)


def like_after(df: DataFrame, keyword: str, after: Moment) -> DataFrame:
    """Case-sensitive, wildcards in the keyword work, strictly after."""
    return df.filter(all_of([like_keyword(F.col("message"), keyword), *time_conditions(df, after=after)]))


def cold_condition(as_of: Moment, ts: str = "timestamp") -> Column:
    """ERROR and WARN always, anything else once it is older than a week.

    Never null: a row without level and time is not eligible.
    """
    old = F.col(ts) < moment(before(as_of, days=COLD_AGE_DAYS))
    return F.coalesce(F.col("level").isin(COLD_LEVELS), F.lit(False)) | F.coalesce(old, F.lit(False))


def cold_eligible(df: DataFrame, as_of: Moment) -> DataFrame:
    return df.filter(cold_condition(as_of))


def error_events(df: DataFrame) -> DataFrame:
    """The branch that raises alerts."""
    return by_level(df, "ERROR")
