"""Model registry as an append-only stage-event log.

Each event is (model_name, version, stage, event_time). Promotion appends a
Production event (the incumbent's later Archived event is implied by being
older); rollback appends a Production event for an older version. The current
production version of a model is the one with the newest Production event
(ties → higher version).
"""

from __future__ import annotations

import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

PRODUCTION, STAGING, ARCHIVED = "Production", "Staging", "Archived"
SCHEMA = "model_name string, version bigint, stage string, event_time timestamp_ntz, reason string"


class NoProductionVersion(RuntimeError):
    pass


def current(log: DataFrame) -> DataFrame:
    """One row per model: the version currently in production.

    A ``max_by`` aggregate (partial per task, then merged), so a model with a very
    long history never lands in one task.
    """
    prod = log.filter(F.col("stage") == PRODUCTION)
    best = F.max_by(F.struct("version", "event_time"), F.struct("event_time", "version"))
    return prod.groupBy("model_name").agg(best.alias("_b")).select("model_name", "_b.version", "_b.event_time")


def event(spark: SparkSession, model: str, version: int, stage: str, reason: str,
          at: datetime.datetime | None = None) -> DataFrame:
    at = at or datetime.datetime.now(datetime.timezone.utc).replace(tzinfo=None)
    return spark.createDataFrame([(model, int(version), stage, at, reason)], SCHEMA)


def next_version(log: DataFrame, model: str) -> int:
    v = log.filter(F.col("model_name") == model).agg(F.max("version")).first()[0]
    return int(v or 0) + 1


def production_version(log: DataFrame, model: str) -> int:
    row = current(log).filter(F.col("model_name") == model).first()
    if row is None:
        raise NoProductionVersion(f"no production version of {model}")
    return int(row["version"])


def promote(spark: SparkSession, model: str, version: int, reason: str = "promoted",
            at: datetime.datetime | None = None) -> DataFrame:
    """Event that makes ``version`` current; the incumbent is archived by being older."""
    return event(spark, model, version, PRODUCTION, reason, at)


def rollback(log: DataFrame, model: str, to_version: int, reason: str = "rollback",
             at: datetime.datetime | None = None) -> DataFrame:
    """Re-promote an older, already registered version."""
    known = log.filter((F.col("model_name") == model) & (F.col("version") == to_version)).limit(1).count()
    if not known:
        raise NoProductionVersion(f"{model} v{to_version} was never registered")
    return event(log.sparkSession, model, to_version, PRODUCTION, reason, at)
