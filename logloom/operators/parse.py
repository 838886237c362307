"""Lines to records, and the routing of lines that cannot be read."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, functions as F

from ..functions import access_log as access, app_log
from ..functions.text import fits, not_blank
from ..functions.time import Moment, moment


def _cut_once(lines: DataFrame, keep: list[str], line: str, groups: Callable[[Column], Column]) -> DataFrame:
    """Lines with their capture groups as ``_groups``.

    The groups come out of a generator (of exactly one row). Later filters on parsed
    fields then stop above it; pushed below, they would repeat the regex in the filter.
    """
    return lines.select(*keep, F.col(line).alias("raw_log"), F.explode(F.array(groups(F.col(line)))).alias("_groups"))


def parse_access_lines(lines: DataFrame, as_of: Moment, line: str = "value",
                       keep: list[str] | None = None) -> DataFrame:
    """Parse access-log lines: format, fields, flags and, for a bad line, the reason.

    A narrow transformation: no shuffle, one regex run per line. ``keep`` names input
    columns to carry along. A bad time is replaced by ``as_of`` and flagged.
    """
    keep = keep or []
    cut = _cut_once(lines, keep, line, access.line_groups)

    def of(column: str) -> Callable[[str], Column]:
        return lambda name: F.get(F.col(column), F.lit(access.GROUPS.index(name)))

    matched = fits(F.col("_groups"), len(access.GROUPS))
    checked = cut.select("*", F.explode(F.array(access.failure_reason(of("_groups"), matched))).alias("_reason"))
    # The groups of a failed line are null from here on, and with them all its fields.
    fields = checked.withColumn("_good", F.when(F.col("_reason").isNull(), F.col("_groups")))
    group = of("_good")
    timed = fields.withColumn("_time", access.wall_clock(group("time")))
    combined = group("mark") != ""
    return timed.select(
        *keep,
        F.coalesce(F.col("_time"), moment(as_of)).alias("timestamp"),
        group("ip").alias("ip_address"),
        group("method").alias("http_method"),
        group("path").alias("request_path"),
        group("status").try_cast("int").alias("status_code"),
        F.nullif(group("size"), F.lit("-")).try_cast("bigint").alias("response_size"),
        F.when(combined, group("agent")).alias("user_agent"),
        F.when(combined, group("referer")).alias("referer"),
        F.nullif(group("rt"), F.lit("")).try_cast("double").alias("response_time"),
        F.when(F.col("_reason").isNotNull(), access.FAILED).when(combined, access.NGINX)
        .otherwise(access.APACHE).alias("log_format"),
        F.col("raw_log"),
        (F.col("_reason").isNull() & F.col("_time").isNull()).alias("timestamp_defaulted"),
        access.parse_metadata(group, F.col("_reason"), as_of).alias("metadata"),
    )


def parsed_only(parsed: DataFrame) -> DataFrame:
    return parsed.filter(F.col("log_format") != access.FAILED)


def dead_letters(parsed: DataFrame) -> DataFrame:
    """Failed lines with reason and time."""
    return parsed.filter(F.col("log_format") == access.FAILED).select(
        "raw_log",
        F.coalesce(F.col("metadata.parse_failure_reason"), F.lit("Unknown")).alias("failure_reason"),
        "timestamp",
    )


def parse_app_lines(lines: DataFrame, line: str = "value", keep: list[str] | None = None) -> DataFrame:
    """Parse application log lines; lines of another form give null fields and ``parsed = false``."""
    cut = _cut_once(lines, keep or [], line, app_log.line_groups)
    parsed = fits(F.col("_groups"), len(app_log.GROUPS))
    fields = [
        F.when(parsed, F.get(F.col("_groups"), F.lit(i)).try_cast(app_log.TYPES.get(name, "string"))).alias(name)
        for i, name in enumerate(app_log.GROUPS)
    ]
    return cut.select(*(keep or []), *fields, "raw_log", parsed.alias("parsed"))


def drop_blank_lines(lines: DataFrame, line: str = "value") -> DataFrame:
    return lines.filter(not_blank(F.col(line)))


def fan_in(*formats: DataFrame) -> DataFrame:
    """Lines of several formats as one stream of lines; columns are matched by name."""
    first, *others = formats
    for other in others:
        first = first.unionByName(other)
    return first
