"""Every registered query: a Spark implementation plus, where SQL can say the same
thing, an independent DuckDB statement used as the correctness oracle.

Queries read whole tables; nothing is sampled, capped or filtered by id to make
a check cheaper. A limit appears only where it is the feature (top-n report).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QueryFn = Callable[[SparkSession, str], DataFrame]

_QUERIES: dict[str, QueryFn] = {}
_ORACLES: dict[str, str] = {}


def query(name: str, oracle: str | None = None):
    """Register ``fn(spark, data_dir) -> DataFrame`` under ``name`` with its oracle SQL."""

    def deco(fn: QueryFn) -> QueryFn:
        if name in _QUERIES:
            raise ValueError(f"duplicate query {name}")
        _QUERIES[name] = fn
        if oracle is not None:
            _ORACLES[name] = oracle.strip()
        return fn

    return deco


def queries() -> dict[str, QueryFn]:
    _load()
    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    _load()
    return dict(_ORACLES)


def _load() -> None:
    # Importing the modules registers their queries.
    from .queries import (  # noqa: F401
        relational, text, quality, ml, monitor, io, search,
    )
