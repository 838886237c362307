"""Access-log line parsing as column expressions.

Two line formats are known: the common one, and the combined one that adds referer,
agent and an optional response time. A combined line also fits the common pattern,
so the longer reading wins whenever it fits.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, functions as F

from .text import capture_groups
from .time import Moment, from_epoch_seconds, moment

# The line formats, the time format, labels and failure reasons.
COMMON_PART = r'^(\S+) \S+ \S+ \[([^\]]+)\] "(\S+) (\S+) \S+" (\d+) (\d+|-)'
COMBINED_PART = r'( ")([^"]*)" "([^"]*)"(?:\s+rt=([\d.]+))?'
TIME_FORMAT = "dd/MMM/yyyy:HH:mm:ss Z"
APACHE, NGINX, FAILED = "apache", "nginx", "failed"
UNKNOWN_FORMAT = "Unknown format"
PARSE_ERROR = "Parse error: "
PARSER_VERSION = "1.0"

LINE = COMMON_PART + "(?:" + COMBINED_PART + r")?.*\z"
GROUPS = ["ip", "time", "method", "path", "status", "size", "mark", "referer", "agent", "rt"]


def line_groups(line: Column) -> Column:
    return capture_groups(line, LINE, len(GROUPS))


def wall_clock(text: Column) -> Column:
    """Time of a line as written, zone offset left out; null if it is no valid time.

    The text is read with its offset, which checks it whole, and the offset is added
    back. Going through epoch seconds keeps the session time zone out of it.
    """
    instant = F.unix_seconds(F.try_to_timestamp(text, F.lit(TIME_FORMAT)))
    hhmm = F.right(text, F.lit(5)).try_cast("int")
    offset = (hhmm - hhmm % 100) * 36 + hhmm % 100 * 60
    return from_epoch_seconds(instant + offset)


def failure_reason(groups: Callable[[str], Column], matched: Column) -> Column:
    """Why a line cannot be stored: no known format, or a number that does not fit its type."""

    def unreadable(text: Column, type_name: str) -> Column:
        return F.when(text.isNotNull() & text.try_cast(type_name).isNull(), text)

    text = F.coalesce(
        unreadable(groups("status"), "int"),
        unreadable(F.nullif(groups("size"), F.lit("-")), "bigint"),
        unreadable(F.nullif(groups("rt"), F.lit("")), "double"),
    )
    return F.when(~matched, F.lit(UNKNOWN_FORMAT)).otherwise(
        F.concat(F.lit(PARSE_ERROR + 'For input string: "'), text, F.lit('"')))


def parse_metadata(groups: Callable[[str], Column], reason: Column, as_of: Moment) -> Column:
    """How the line was parsed: version and flags for a good line, reason for a failed one."""
    good, combined = reason.isNull(), groups("mark") != ""
    return F.struct(
        F.when(good, moment(as_of)).alias("parsed_at"),
        F.when(good, F.lit(PARSER_VERSION)).alias("parser_version"),
        F.when(combined, groups("agent") != "-").alias("has_user_agent"),
        F.when(combined, groups("referer") != "-").alias("has_referer"),
        reason.alias("parse_failure_reason"),
        F.when(~good, moment(as_of)).alias("failed_at"),
    )
