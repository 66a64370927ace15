"""The task contract: named sources in, a transform, named outputs written to sinks.

A ``Task`` declares its inputs and outputs; ``run`` reads every source lazily,
calls ``transform``, checks that the outputs match the declared sinks, and
writes each one. Outputs that share an expensive parent can be persisted by the
transform; nothing is collected here except a landed-row count for sinks that require rows.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from typing import Callable

from pyspark.sql import DataFrame, SparkSession

from .session import tune
from .sinks import Sink, write
from .sources.tables import read_table, sql_source

SourceFn = Callable[[SparkSession, dict], DataFrame]


@dataclass
class Source:
    """One input: a table in a data dir, a SQL statement (with named parameters), or a callable."""

    table: str | None = None
    data_dir: str | None = None
    sql: str | None = None
    views: dict[str, str] = field(default_factory=dict)  # view name -> table name in data_dir
    fn: SourceFn | None = None

    def load(self, spark: SparkSession, params: dict) -> DataFrame:
        if self.fn is not None:
            return self.fn(spark, params)
        if self.sql is not None:
            views = {v: read_table(spark, params.get("data_dir", self.data_dir), t) for v, t in self.views.items()}
            sql_params = {k: v for k, v in params.items() if f":{k}" in self.sql}
            return sql_source(spark, self.sql, sql_params or None, views)
        if self.table is not None:
            return read_table(spark, params.get("data_dir", self.data_dir), self.table)
        raise ValueError("a source needs a table, sql or fn")


class Task:
    """Subclass and implement ``transform(sources, params) -> {name: DataFrame}``."""

    inputs: dict[str, Source] = {}
    outputs: dict[str, Sink] = {}
    defaults: dict = {}

    def transform(self, sources: dict[str, DataFrame], params: dict) -> dict[str, DataFrame]:
        raise NotImplementedError


class TaskError(RuntimeError):
    pass


# Spark settings by environment profile; a missing profile is an error, not a silent default.
PROFILES = {
    "DEV": {"spark.sql.shuffle.partitions": "8"},
    # The number of shuffle partitions is the platform's to set; adaptive execution merges small
    # partitions and splits skewed ones. Hand-made broadcasts stay under the bound checked in
    # ``plans.sizing``.
    "PROD": {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
    },
}


def run(task: Task, spark: SparkSession, params: dict | None = None, profile: str = "DEV",
        sinks: dict[str, Sink] | None = None) -> dict[str, int | None]:
    """Read sources, transform, check output names, write. Returns landed rows per output
    (``None`` for sinks that do not require rows)."""
    if profile not in PROFILES:
        raise TaskError(f"unknown profile {profile!r}; expected one of {sorted(PROFILES)}")
    tune(spark)
    for k, v in PROFILES[profile].items():
        spark.conf.set(k, v)
    merged = {**task.defaults, **(params or {})}
    sources = {name: src.load(spark, merged) for name, src in task.inputs.items()}
    outputs = task.transform(sources, merged)
    declared = sinks if sinks is not None else task.outputs
    if set(outputs) != set(declared):
        raise TaskError(f"outputs {sorted(outputs)} do not match declared sinks {sorted(declared)}")
    return {name: write(df, declared[name]) for name, df in outputs.items()}
