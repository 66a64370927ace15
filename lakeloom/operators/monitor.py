"""Model monitoring: candidate evaluation, decay, and the remedy decision.

A *model version* here is anything that adds a ``prediction`` column to a frame.
All versions are scored on the same live rows, their errors brought to long form, and one grouped aggregate gives every version's live
error — nothing is collected but one row per version.
"""

from __future__ import annotations

from typing import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .registry import PRODUCTION

# Allowed error growth before a model counts as decayed, and the
# improvement a challenger needs before a rollback is worth a deployment.
MAX_ERROR_MULTIPLE = 3.0
MIN_IMPROVEMENT = 0.10

Predictor = Callable[[DataFrame], DataFrame]


def candidate_errors(live: DataFrame, versions: dict[int, Predictor], label: str) -> DataFrame:
    """``(version, live_mae, rows)`` for every version on the same live rows."""
    parts = None
    for v, predict in versions.items():
        scored = predict(live).select(F.lit(v).cast("bigint").alias("version"),
                                      F.abs(F.col("prediction") - F.col(label)).alias("abs_err"))
        parts = scored if parts is None else parts.unionByName(scored)
    return parts.groupBy("version").agg(F.avg("abs_err").alias("live_mae"), F.count("*").alias("rows"))


def candidate_errors_columns(live: DataFrame, predictions: dict[int, "Column"], label: str,
                             by: tuple[str, ...] | list[str] = ()) -> DataFrame:
    """Same as :func:`candidate_errors` when every version is an expression over one
    prepared frame: all versions are scored in a single pass, unpivoted with ``stack``;
    with ``by`` (the window of a row, say) for each of its values."""
    pairs = ", ".join(f"{int(v)}L, `_p{int(v)}`" for v in predictions)
    scored = live.select(*by, F.col(label).alias("_y"), *[c.alias(f"_p{int(v)}") for v, c in predictions.items()])
    long = scored.selectExpr(*by, "_y", f"stack({len(predictions)}, {pairs}) AS (version, prediction)")
    return long.groupBy(*by, "version").agg(F.avg(F.abs(F.col("prediction") - F.col("_y"))).alias("live_mae"),
                                            F.count("*").alias("rows"))


def decay(errors: DataFrame, recorded: DataFrame, multiple: float = MAX_ERROR_MULTIPLE) -> DataFrame:
    """Join live error to each version's own recorded test error; decayed when > multiple ×."""
    j = errors.join(recorded, "version", "left")
    decayed = (F.col("test_mae") > 0) & (F.col("live_mae") > F.lit(multiple) * F.col("test_mae"))
    return j.select("version", "test_mae", "live_mae",
                    F.try_divide(F.col("live_mae"), F.col("test_mae")).alias("error_multiple"),
                    F.coalesce(decayed, F.lit(False)).alias("decayed"))


def decide(decay_rows: DataFrame, drift: DataFrame, champion: int, allow_rollback: bool = True,
           min_improvement: float = MIN_IMPROVEMENT) -> DataFrame:
    """One row: champion error, best other version (ties → lowest version), flags, action, diagnosis."""
    champ = decay_rows.filter(F.col("version") == champion).select(
        F.col("live_mae").alias("champion_mae"), F.col("decayed"))
    others = decay_rows.filter(F.col("version") != champion).agg(
        F.min_by("version", F.struct("live_mae", "version")).alias("best_version"),
        F.min("live_mae").alias("best_mae"))
    drifted = drift.agg(F.coalesce(F.max(F.col("breached").cast("int")), F.lit(0)).cast("boolean").alias("breached"),
                        F.array_sort(F.collect_list(F.when(F.col("breached"), F.col("feature")))).alias("drifted_columns"))
    row = _one_row(decay_rows.sparkSession, champ, others, drifted)
    wins = F.coalesce(F.col("best_mae") < F.col("champion_mae") * F.lit(1 - min_improvement), F.lit(False))
    action = (F.when(~F.col("breached") & ~F.col("decayed") & ~wins, F.lit("none"))
              .when(wins & F.lit(not allow_rollback), F.lit("alert_only"))
              .when(wins, F.lit("rollback"))
              .otherwise(F.lit("retrain")))
    diagnosis = (F.when(~F.col("breached") & ~F.col("decayed") & ~wins, F.lit("healthy"))
                 .when(wins & F.lit(not allow_rollback), F.lit("better_version_available"))
                 .when(wins, F.lit("regression"))
                 .when(F.col("breached"), F.lit("world_moved"))
                 .otherwise(F.lit("decayed")))
    return row.select(F.lit(champion).cast("bigint").alias("champion_version"), "champion_mae", "best_version",
                      "best_mae", "breached", "decayed", wins.alias("challenger_wins"), "drifted_columns",
                      action.alias("action"), diagnosis.alias("diagnosis"))


def candidates(decay_rows: DataFrame, decision: DataFrame) -> DataFrame:
    """Every version with its role; the decision's best version is marked."""
    row = decision.select(F.struct("champion_version", "best_version").alias("r")).scalar()
    role = F.when(F.col("version") == row["champion_version"], F.lit("champion")).otherwise(F.lit("challenger"))
    return decay_rows.select("version", role.alias("role"), (F.col("version") == row["best_version"]).alias("best_challenger"),
                             "test_mae", "live_mae", "decayed")


def incident(decay_rows: DataFrame, decision: DataFrame, target: str) -> DataFrame:
    """The run's finding in one row, with a line of text."""
    baseline = decay_rows.agg(F.collect_list(F.struct("version", "test_mae")).alias("v")).select(F.struct("v").alias("v")).scalar()
    own = F.filter("_recorded", lambda x: x["version"] == F.col("champion_version"))
    inputs = F.filter("drifted_columns", lambda c: c != target)
    return decision.withColumn("_recorded", baseline["v"]).withColumn("baseline_mae", F.get(own, F.lit(0))["test_mae"]).select(
        "action", "diagnosis", F.array_contains("drifted_columns", target).alias("target_drift"),
        (F.size(inputs) > 0).alias("input_drift"), inputs.alias("drifted_inputs"), "baseline_mae", "champion_mae",
        F.format_string("v%d %s: error %.2f against %.2f at release; best other v%d at %.2f", "champion_version", "diagnosis",
                        "champion_mae", "baseline_mae", "best_version", "best_mae").alias("detail"))


def apply_remedy(log: DataFrame, decision: DataFrame, model: str) -> DataFrame:
    """The stage log with the event of a rollback, a moment after its newest event, if one was decided."""
    newest = log.where(F.col("model_name") == model).agg((F.max("event_time") + F.expr("INTERVAL 1 SECOND")).alias("at"))
    at = newest.select("at").scalar()
    event = decision.where("action = 'rollback'").select(
        F.lit(model).alias("model_name"), F.col("best_version").cast("bigint").alias("version"),
        F.lit(PRODUCTION).alias("stage"), at.cast("timestamp_ntz").alias("event_time"), F.col("diagnosis").alias("reason"))
    return log.select(*event.columns).unionByName(event)


def _one_row(spark, *frames: DataFrame) -> DataFrame:
    """Side by side, the single rows of one-row aggregates, each as a scalar subquery."""
    cols = []
    for f in frames:
        value = f.select(F.struct(*f.columns).alias("v")).scalar()
        cols += [value[c].alias(c) for c in f.columns]
    return spark.range(1).select(*cols)
