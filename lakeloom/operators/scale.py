"""Standardisation fitted on one frame and reused on others.

Mean and *population* standard deviation (a near-zero deviation counts as 1, so
a constant column maps to 0 instead of dividing by zero). The fitted table is
one row; it enters new data as a scalar subquery, so scoring costs no shuffle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MIN_STD = 1e-8


def fit(df: DataFrame, cols: list[str]) -> DataFrame:
    aggs = []
    for c in cols:
        aggs += [F.avg(c).alias(f"{c}__mean"), F.stddev_pop(c).alias(f"{c}__std")]
    stats = df.agg(*aggs)
    return stats.select(*[F.col(f"{c}__mean") for c in cols],
                        *[F.when(F.coalesce(F.col(f"{c}__std"), F.lit(0.0)) < MIN_STD, F.lit(1.0))
                          .otherwise(F.col(f"{c}__std")).alias(f"{c}__std") for c in cols])


def transform(df: DataFrame, stats: DataFrame, cols: list[str], suffix: str = "_z") -> DataFrame:
    """Apply fitted stats. The one-row stats table enters as a scalar subquery (computed
    once, then a constant for every task) — no join, no shuffle."""
    fitted = stats.select(F.struct(*stats.columns).alias("s")).scalar()
    out = df
    for c in cols:
        out = out.withColumn(f"{c}{suffix}", (F.col(c) - fitted[f"{c}__mean"]) / fitted[f"{c}__std"])
    return out
