"""Time helpers. Whatever depends on "now" takes ``as_of`` so that results can be repeated."""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import Column, functions as F

Moment = datetime | str


def as_datetime(value: Moment) -> datetime:
    return value if isinstance(value, datetime) else datetime.fromisoformat(value)


def as_epoch_seconds(value: Moment) -> int:
    return (as_datetime(value) - datetime(1970, 1, 1)) // timedelta(seconds=1)


def moment(value: Moment) -> Column:
    """A zone-less timestamp literal. It folds to a constant, so comparisons reach the file scan."""
    return F.lit(as_datetime(value).isoformat(sep=" ")).cast("timestamp_ntz")


def before(value: Moment, **span: float) -> datetime:
    """``value`` minus a span, worked out on the driver to keep filters literal."""
    return as_datetime(value) - timedelta(**span)


def seconds(count: int | Column) -> Column:
    """An interval of whole seconds."""
    return F.expr("interval '1' second") * (F.lit(count) if isinstance(count, int) else count)


def epoch_seconds(ts: Column) -> Column:
    """Wall-clock seconds since 1970-01-01, the same under every session time zone."""
    days = F.datediff(F.to_date(ts), F.lit("1970-01-01").cast("date")).cast("bigint")
    return days * 86400 + F.hour(ts) * 3600 + F.minute(ts) * 60 + F.second(ts)


def from_epoch_seconds(value: Column) -> Column:
    """Inverse of :func:`epoch_seconds`."""
    return moment("1970-01-01") + seconds(value)


def bucket(ts: Column, width_seconds: int) -> Column:
    """Number of the fixed-width time bucket that holds ``ts``."""
    return F.floor(epoch_seconds(ts) / F.lit(width_seconds)).cast("bigint")


def bucket_start(ts: Column, width_seconds: int) -> Column:
    """Start of that bucket as a timestamp."""
    return from_epoch_seconds(bucket(ts, width_seconds) * width_seconds)
