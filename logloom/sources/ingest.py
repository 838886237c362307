"""Incoming JSON events, single or in batches: decode, fill in what is missing, set bad ones aside."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import DataFrame, functions as F, types as T

from ..functions.json_codec import CORRUPT, decode, decode_each_field
from ..functions.time import Moment, moment
from ..operators.enrich import prepare_events, stamp
from ..schema import ACCESS_LOG


class Decoded(NamedTuple):
    events: DataFrame
    dead: DataFrame


def decode_events(records: DataFrame, schema: T.StructType, value: str = "value",
                  keep: list[str] | None = None) -> DataFrame:
    """Typed columns of each record next to ``_corrupt``, the text of a record that is none."""
    decoded = decode(records, schema, value)
    return decoded.select(*(keep or []), "event.*", CORRUPT)


def split_decoded(decoded: DataFrame, as_of: Moment) -> Decoded:
    """Good events, and dead letters with reason and time."""
    good = decoded.filter(F.col(CORRUPT).isNull()).drop(CORRUPT)
    dead = decoded.filter(F.col(CORRUPT).isNotNull()).select(
        F.col(CORRUPT).alias("raw_log"), F.lit("Invalid JSON").alias("failure_reason"),
        moment(as_of).alias("timestamp"))
    return Decoded(good, dead)


def ingest(records: DataFrame, schema: T.StructType, as_of: Moment, value: str = "value",
           id_from: list[str] | None = None) -> Decoded:
    """Records to storable events: ids, trace ids and times filled in, processing time stamped."""
    return ingested(split_decoded(decode_events(records, schema, value), as_of), as_of, id_from)


def ingested(decoded: Decoded, as_of: Moment, id_from: list[str] | None = None) -> Decoded:
    return Decoded(stamp(prepare_events(decoded.events, as_of, id_from), as_of), decoded.dead)


def decode_access_logs(records: DataFrame, as_of: Moment, value: str = "value",
                       keep: list[str] | None = None) -> DataFrame:
    """Parsed access logs from JSON, field by field; a bad time becomes ``as_of``."""
    read = decode_each_field(records, ACCESS_LOG, value, default_time=moment(as_of))
    return read.select(*(keep or []), *ACCESS_LOG.fieldNames())
