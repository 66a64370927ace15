"""Leaderboards that say when a lead means nothing.

Newest run per learner (max recorded time joined back ``USING``), metrics
pivoted with declared values, ranked, champion flagged, and the winner's margin
over the runner-up turned into a verdict. Nothing is collected: best and
runner-up come from one conditional aggregate over the ranked board.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .latest import newest_by_join
from .ranking import global_row_number

# Margin needed to call a winner, ranking metric, reported metrics.
DECISIVE_MARGIN_PCT = 5.0
RANK_BY = "score_rmse"
REPORTED = ["train_rmse", "test_rmse", "test_mae", "test_r2", "score_rmse", "score_mae", "score_r2"]


class NoScores(RuntimeError):
    pass


def metrics_log_from_lines(lines: DataFrame) -> DataFrame:
    """A long metrics log with two runs per learner, derived from line aggregates
    (learner = return flag; run 1 = finished lines, run 2 = open lines)."""
    finished = F.col("l_linestatus") == "F"
    runs = lines.groupBy("l_returnflag", "l_linestatus").agg(
        F.min("l_shipdate").alias("_first"), F.max("l_shipdate").alias("_last"),
        (F.count("*") / F.lit(1000.0)).alias("train_seconds"),
        F.round(F.max("l_extendedprice") / 10000, 6).alias("train_rmse"),
        F.round(F.avg("l_extendedprice") / 1000, 6).alias("test_rmse"),
        F.round(F.avg("l_quantity"), 6).alias("test_mae"),
        F.round(F.avg("l_discount") * 10, 6).alias("test_r2"),
        F.round(F.stddev_pop("l_extendedprice") / 1000, 6).alias("score_rmse"),
        F.round(F.stddev_pop("l_quantity"), 6).alias("score_mae"),
        F.round(F.avg("l_tax") * 10, 6).alias("score_r2"))
    wide = runs.select(
        F.concat(F.lit("learner_"), F.lower("l_returnflag")).alias("framework"),
        F.concat(F.lit("fare_"), F.lower("l_returnflag")).alias("model_name"),
        F.when(finished, F.lit(1)).otherwise(F.lit(2)).alias("version"),
        F.when(finished, F.col("_first")).otherwise(F.col("_last")).alias("recorded_at"),
        "train_seconds", *REPORTED)
    pairs = ", ".join(f"'{m}', `{m}`" for m in REPORTED)
    return wide.selectExpr("framework", "model_name", "version", "recorded_at", "train_seconds",
                           f"stack({len(REPORTED)}, {pairs}) AS (metric, value)")


def latest_board(log: DataFrame) -> DataFrame:
    """Newest run per framework, pivoted to one row per learner (declared pivot values)."""
    newest = newest_by_join(log, ["framework"], "recorded_at")
    board = newest.groupBy("framework", "model_name", "version", "train_seconds").pivot("metric", REPORTED) \
        .agg(F.first("value"))
    return board.filter(F.col(RANK_BY).isNotNull())


def ranked(board: DataFrame) -> DataFrame:
    return global_row_number(board, RANK_BY, [F.col("framework").asc()], "rank")


def margin(rk: DataFrame) -> DataFrame:
    """One row: best score, runner-up, margin in percent (100 with a single entrant)."""
    top = rk.agg(F.max(F.when(F.col("rank") == 1, F.col(RANK_BY))).alias("best"),
                 F.max(F.when(F.col("rank") == 2, F.col(RANK_BY))).alias("runner_up"))
    pct = F.when(F.col("runner_up").isNull() | (F.col("runner_up") == 0), F.lit(100.0)) \
        .otherwise(F.lit(100.0) * (F.col("runner_up") - F.col("best")) / F.col("runner_up"))
    return top.select("best", "runner_up", F.round(pct, 6).alias("margin_pct"))


def board(log: DataFrame) -> DataFrame:
    entrants = latest_board(log)
    if entrants.isEmpty():
        raise NoScores(f"no run has a {RANK_BY}, so there is nothing to rank")
    rk = ranked(entrants)
    out = rk.withColumn("margin_pct", margin(rk).select("margin_pct").scalar())
    verdict = F.when(F.col("margin_pct") >= DECISIVE_MARGIN_PCT, F.lit("clear win")).otherwise(F.lit("too close to call"))
    return out.select("framework", "model_name", "version", "train_seconds", *REPORTED, "rank",
                      (F.col("rank") == 1).alias("is_champion"), F.lit(RANK_BY).alias("ranked_on"), "margin_pct",
                      verdict.alias("verdict"))
