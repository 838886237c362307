"""Application log line: ``[time] LEVEL [service] [req:n] [user:n] Operation 'x' completed in nms``."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from .text import capture_groups

# Fixed value: the line format.
APP_LINE = (
    r"^\[(\d{4}-\d{2}-\d{2} \d{2}:\d{2}:\d{2}\.\d{3})\] (\S+) \[([^\]]+)\] \[req:(\d+)\] \[user:(\d+)\]"
    r" Operation '([^']*)' completed in (\d+)ms\z"
)
GROUPS = ["timestamp", "level", "service_name", "request_id", "user_id", "operation", "response_time_ms"]
TYPES = {"timestamp": "timestamp_ntz", "request_id": "bigint", "user_id": "bigint", "response_time_ms": "bigint"}


def line_groups(line: Column) -> Column:
    return capture_groups(line, APP_LINE, len(GROUPS))


def app_line(timestamp: Column, level: Column, service: Column, request: Column, user: Column,
             operation: Column, millis: Column) -> Column:
    """The same line written from its fields."""
    return F.format_string(
        "[%s] %s [%s] [req:%d] [user:%d] Operation '%s' completed in %dms",
        F.date_format(timestamp, "yyyy-MM-dd HH:mm:ss.SSS"), level, service, request, user,
        operation, millis)
