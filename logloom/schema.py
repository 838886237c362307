"""Canonical record types. Field names follow the stored tables; wire names differ only in JSON."""

from __future__ import annotations

from pyspark.sql import types as T

_STRINGS = T.MapType(T.StringType(), T.StringType())

# Service log event as sent by a producer that belongs to an organization.
ORG_EVENT_WIRE = T.StructType([
    T.StructField("id", T.StringType()),
    T.StructField("organizationId", T.StringType()),
    T.StructField("level", T.StringType()),
    T.StructField("message", T.StringType()),
    T.StructField("source", T.StringType()),
    T.StructField("timestamp", T.TimestampNTZType()),
])

# Correlated event; the only record whose time carries a zone.
CORRELATED_EVENT_WIRE = T.StructType([
    T.StructField("id", T.StringType()),
    T.StructField("correlationId", T.StringType()),
    T.StructField("timestamp", T.TimestampType()),
    T.StructField("level", T.StringType()),
    T.StructField("source", T.StringType()),
    T.StructField("message", T.StringType()),
    T.StructField("metadata", _STRINGS),
    T.StructField("traceId", T.StringType()),
])

# Line collected from a log file.
FILE_EVENT = T.StructType([
    T.StructField("id", T.StringType()),
    T.StructField("file_path", T.StringType()),
    T.StructField("content", T.StringType()),
    T.StructField("file_offset", T.LongType()),
    T.StructField("timestamp", T.TimestampNTZType()),
    T.StructField("hostname", T.StringType()),
    T.StructField("service_name", T.StringType()),
    T.StructField("content_hash", T.StringType()),
])

# Traced event of the tiered store.
TRACED_EVENT_WIRE = T.StructType([
    T.StructField("timestamp", T.TimestampNTZType()),
    T.StructField("level", T.StringType()),
    T.StructField("source", T.StringType()),
    T.StructField("message", T.StringType()),
    T.StructField("metadata", _STRINGS),
    T.StructField("trace_id", T.StringType()),
])

# Union of the service log events: what the warm table holds.
LOG_EVENT = T.StructType([
    T.StructField("id", T.StringType()),
    T.StructField("organization_id", T.StringType()),
    T.StructField("correlation_id", T.StringType()),
    T.StructField("timestamp", T.TimestampNTZType()),
    T.StructField("level", T.StringType()),
    T.StructField("source", T.StringType()),
    T.StructField("message", T.StringType()),
    T.StructField("trace_id", T.StringType()),
    T.StructField("metadata", _STRINGS),
    T.StructField("processed_at", T.TimestampNTZType()),
])

METADATA_ROW = T.StructType([
    T.StructField("log_event_id", T.StringType()),
    T.StructField("key", T.StringType()),
    T.StructField("value", T.StringType()),
])

PARSE_METADATA = T.StructType([
    T.StructField("parsed_at", T.TimestampNTZType()),
    T.StructField("parser_version", T.StringType()),
    T.StructField("has_user_agent", T.BooleanType()),
    T.StructField("has_referer", T.BooleanType()),
    T.StructField("parse_failure_reason", T.StringType()),
    T.StructField("failed_at", T.TimestampNTZType()),
])

# Parsed access-log line.
ACCESS_LOG = T.StructType([
    T.StructField("timestamp", T.TimestampNTZType()),
    T.StructField("ip_address", T.StringType()),
    T.StructField("http_method", T.StringType()),
    T.StructField("request_path", T.StringType()),
    T.StructField("status_code", T.IntegerType()),
    T.StructField("response_size", T.LongType()),
    T.StructField("user_agent", T.StringType()),
    T.StructField("referer", T.StringType()),
    T.StructField("response_time", T.DoubleType()),
    T.StructField("log_format", T.StringType()),
    T.StructField("raw_log", T.StringType()),
])

ACCESS_LOG_WIRE = T.StructType([*ACCESS_LOG.fields, T.StructField("metadata", PARSE_METADATA)])

DEAD_LETTER = T.StructType([
    T.StructField("raw_log", T.StringType()),
    T.StructField("failure_reason", T.StringType()),
    T.StructField("timestamp", T.TimestampNTZType()),
])

# Declared column widths of the stored tables, for the quality check.
DECLARED_WIDTHS = {
    "level": 20,
    "source": 100,
    "trace_id": 100,
    "ip_address": 45,
    "http_method": 10,
    "request_path": 500,
    "user_agent": 1000,
    "referer": 500,
    "log_format": 50,
}
