"""Keyed queries over the test tables, each beside its SQL twin."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from strata.queries import (
    capture,
    exports,
    history,
    landing,
    measures,
    metadata,
    quality,
    runs,
    shaping,
    streams,
    validity,
)

Query = Callable[[SparkSession, str], DataFrame]

_MODULES = (
    landing, shaping, quality, capture, history, validity, metadata, streams, runs, measures, exports,
)


def all_queries() -> dict[str, Query]:
    return {name: run for module in _MODULES for name, (run, _) in module.QUERIES.items()}


def all_sql() -> dict[str, str]:
    return {
        name: sql for module in _MODULES for name, (_, sql) in module.QUERIES.items() if sql
    }
