"""Named queries: a Spark function each and, where SQL can say it, the same result in SQL."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

Build = Callable[[SparkSession, str], DataFrame]


@dataclass(frozen=True)
class Query:
    build: Build
    sql: str | None
    operators: str


CATALOG: dict[str, Query] = {}


def query(name: str, operators: str, sql: str | None = None) -> Callable[[Build], Build]:
    """Register a query under ``name``; ``operators`` lists the inventory rows it covers."""

    def register(build: Build) -> Build:
        if name in CATALOG:
            raise ValueError(f"{name} is registered twice")
        CATALOG[name] = Query(build, sql, operators)
        return build

    return register


def load() -> dict[str, Query]:
    from . import access, events, files, limits, streams, tiers  # noqa: F401  (they register on import)

    return CATALOG
