"""Model quality metrics as single distributed aggregates (nothing collected but one row)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def regression_metrics(df: DataFrame, label: str, prediction: str, by: list[str] | None = None) -> DataFrame:
    """rmse, mae, r2 (0 when the target is constant) and row count, optionally per group.

    One pass: Σe², Σ|e| and the population variance of the label.
    """
    e = F.col(prediction) - F.col(label)
    agg = df.groupBy(*(by or [])).agg(
        F.count("*").alias("rows"),
        F.avg(e * e).alias("_mse"),
        F.avg(F.abs(e)).alias("mae"),
        F.var_pop(label).alias("_var"),
    )
    r2 = F.when(F.col("_var") > 0, F.lit(1.0) - F.col("_mse") / F.col("_var")).otherwise(F.lit(0.0))
    return agg.select(*(by or []), F.sqrt("_mse").alias("rmse"), "mae", r2.alias("r2"), "rows")


def classification_metrics(df: DataFrame, label: str, prediction: str) -> DataFrame:
    """Long form: overall accuracy, then recall per class present in the labels."""
    correct = (F.col(prediction) == F.col(label)).cast("double")
    overall = df.agg(F.avg(correct).alias("value"), F.count("*").alias("support")).select(
        F.lit("accuracy").alias("metric"), F.lit(None).cast("int").alias("class_label"), "value", "support")
    per = df.groupBy(F.col(label).cast("int").alias("class_label")).agg(
        F.avg(correct).alias("value"), F.count("*").alias("support")).select(
        F.lit("recall").alias("metric"), "class_label", "value", "support")
    return overall.unionByName(per)


def long_form(wide: DataFrame, id_cols: list[str], metric_cols: list[str], prefix: str = "") -> DataFrame:
    """Wide metric columns → (…, metric, value) rows, via one ``stack``."""
    pairs = ", ".join(f"'{prefix}{c}', CAST(`{c}` AS DOUBLE)" for c in metric_cols)
    return wide.selectExpr(*[f"`{c}`" for c in id_cols], f"stack({len(metric_cols)}, {pairs}) AS (metric, value)")


def rounded(c: str, places: int = 6) -> Column:
    return F.round(F.col(c), places).alias(c)
