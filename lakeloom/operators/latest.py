"""Newest row(s) per key over an append-only log."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def newest_by_join(log: DataFrame, keys: list[str], ts: str) -> DataFrame:
    """SQL-source form: max timestamp per key, joined back ``USING (keys, ts)``.

    Ties on the newest timestamp keep every tied row, as the SQL does.
    """
    newest = log.groupBy(*keys).agg(F.max(ts).alias(ts))
    return log.join(newest, on=[*keys, ts], how="inner")


def newest_by_rank(log: DataFrame, keys: list[str], ts: str) -> DataFrame:
    """Window form: ``rank() over (partition by keys order by ts desc) = 1``.

    Catalyst turns the rank filter into a per-partition group limit before the
    window, so only the newest candidates of each task reach the final sort.
    """
    w = Window.partitionBy(*keys).orderBy(F.col(ts).desc())
    return log.withColumn("_r", F.rank().over(w)).filter(F.col("_r") == 1).drop("_r")
