"""Promotion gates: one row per bar with value, bar, passed and a message.

A bar named ``max_<metric>`` passes when the metric is at most the bar;
``min_<metric>`` when it is at least the bar (both inclusive). Bars apply to
held-out (test) metrics only.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


class GateFailed(RuntimeError):
    pass


def bars_frame(spark: SparkSession, bars: dict[str, float]) -> DataFrame:
    rows = []
    for name, value in bars.items():
        kind, _, metric = name.partition("_")
        if kind not in ("max", "min") or not metric:
            raise ValueError(f"bar {name!r} must be max_<metric> or min_<metric>")
        rows.append((name, kind, metric, float(value)))
    return spark.createDataFrame(rows, "bar string, kind string, metric string, threshold double")


def evaluate(metrics_long: DataFrame, bars: DataFrame) -> DataFrame:
    """``metrics_long`` has (metric, value). A bar whose metric is missing fails."""
    j = bars.join(metrics_long.select("metric", "value"), "metric", "left")
    passed = F.coalesce(
        F.when(F.col("kind") == "max", F.col("value") <= F.col("threshold"))
        .otherwise(F.col("value") >= F.col("threshold")), F.lit(False))
    msg = F.when(F.col("value").isNull(), F.concat(F.lit("metric "), F.col("metric"), F.lit(" missing"))) \
        .otherwise(F.format_string("%s = %.6f %s %.6f", F.col("metric"), F.col("value"),
                                   F.when(passed, F.lit("meets")).otherwise(F.lit("misses")), F.col("threshold")))
    return j.select("bar", "metric", "value", "threshold", passed.alias("passed"), msg.alias("message"))


def enforce(gate_rows: DataFrame) -> None:
    failed = [r["message"] for r in gate_rows.filter(~F.col("passed")).collect()]
    if failed:
        raise GateFailed("; ".join(failed))
