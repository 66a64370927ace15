"""Drift, decay, candidate evaluation, remedy decision (E11-E13, K15-K17, D6, G4) and
the leaderboard (E7, E8, F2, F3, F5, K18)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..catalog import query
from ..functions.numeric import money_total
from ..operators import leaderboard, monitor, psi, registry
from ..operators.split import split_label
from ..plans.sizing import broadcast_if_small
from ..session import landed
from ..sources.tables import read_table

# The live window of the drift scenario (prices inflated by 35 %),
# the monitored inputs and target.
LIVE_FACTOR = 1.35
INPUTS = ["l_quantity", "l_discount", "l_tax"]
TARGET = "l_extendedprice"

_KEY = ("concat_ws('|', CAST(l_orderkey AS VARCHAR), CAST(l_linenumber AS VARCHAR), CAST(l_partkey AS VARCHAR), "
        "CAST(l_suppkey AS VARCHAR))")
_BUCKET = f"(CAST(('0x' || substr(sha256({_KEY}), 1, 8)) AS UBIGINT) % 100)"


def _windows(spark, d, columns, factor=LIVE_FACTOR):
    """(lines with their split, live window): versions are fitted on ``train``; the live window is
    the ``score`` split, whose rows no version has seen, with inflated prices. The lines are
    written once with the ``columns`` wanted, so the hash behind the split is computed once."""
    li = read_table(spark, d, "lineitem")
    cols = [F.col("l_orderkey"), F.col("l_linenumber"), F.col("l_partkey"), F.col("l_suppkey")]
    lines = landed(li.select(*columns, split_label(cols).alias("split")), "monitored-lines")
    live = lines.where("split = 'score'").withColumn(TARGET, F.col(TARGET) * F.lit(factor))
    return lines, live


def _drift(spark, d, columns):
    lines, live = _windows(spark, d, columns)
    return psi.psi_table(lines.where("split = 'train'"), live, columns)


# ---------------------------------------------------------------- E11, E12, E13, K15

_DECILES = "[0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9]"


@query("quantile_edges", f"""
SELECT CAST(i AS INTEGER) AS edge_index, round(q[i], 6) AS edge
FROM (SELECT quantile_cont(l_extendedprice, {_DECILES}) AS q FROM lineitem), range(1, 10) t(i)
""")
def quantile_edges(spark, d):
    ref = psi.unpivot(read_table(spark, d, "lineitem"), [TARGET])
    e = psi.quantile_edges(ref)
    return e.select(F.posexplode("edges").alias("i", "edge")).select(
        (F.col("i") + 1).alias("edge_index"), F.round("edge", 6).alias("edge"))


@query("histogram_fixed", f"""
WITH e AS (SELECT quantile_cont(l_extendedprice, {_DECILES}) AS edges FROM lineitem)
SELECT CAST(len(list_filter(e.edges, lambda x: l.l_extendedprice >= x)) AS INTEGER) AS bucket, count(*) AS n
FROM lineitem l, e GROUP BY 1
""")
def histogram_fixed(spark, d):
    li = read_table(spark, d, "lineitem")
    edges = psi.collect_edges(psi.quantile_edges(psi.unpivot(li, [TARGET])))
    return psi.histogram(li, edges).select("bucket", "n")


def _drift_sql(features: list[str], target: str, factor: float) -> str:
    def side(live: bool) -> str:
        parts = []
        for c in features:
            expr = f"{c} * CAST({factor} AS DOUBLE)" if (live and c == target) else c
            window = f"{_BUCKET} >= 85" if live else f"{_BUCKET} < 70"
            parts.append(f"SELECT '{c}' AS feature, CAST({expr} AS DOUBLE) AS value FROM lineitem "
                         f"WHERE {c} IS NOT NULL AND {window}")
        return " UNION ALL ".join(parts)

    return f"""
WITH dref AS ({side(False)}), dlive AS ({side(True)}),
edges AS (SELECT feature, quantile_cont(value, {_DECILES}) AS edges FROM dref GROUP BY feature),
spine AS (SELECT feature, unnest(range(10)) AS bucket FROM edges),
rc AS (SELECT r.feature, len(list_filter(e.edges, lambda x: r.value >= x)) AS bucket, count(*) AS n
       FROM dref r JOIN edges e ON e.feature = r.feature GROUP BY 1, 2),
lc AS (SELECT r.feature, len(list_filter(e.edges, lambda x: r.value >= x)) AS bucket, count(*) AS n
       FROM dlive r JOIN edges e ON e.feature = r.feature GROUP BY 1, 2),
j AS (SELECT s.feature, s.bucket, coalesce(rc.n, 0) AS ref_n, coalesce(lc.n, 0) AS live_n
      FROM spine s LEFT JOIN rc ON rc.feature = s.feature AND rc.bucket = s.bucket
      LEFT JOIN lc ON lc.feature = s.feature AND lc.bucket = s.bucket),
sh AS (SELECT feature,
              greatest(ref_n / greatest(sum(ref_n) OVER (PARTITION BY feature), 1), 1e-6) AS r,
              greatest(live_n / greatest(sum(live_n) OVER (PARTITION BY feature), 1), 1e-6) AS c FROM j),
p AS (SELECT feature, sum((c - r) * ln(c / r)) AS psi FROM sh GROUP BY feature)"""


_DRIFT_ALL = _drift_sql([*INPUTS, TARGET], TARGET, LIVE_FACTOR)
_STATUS = "CASE WHEN psi > 0.25 THEN 'breach' WHEN psi > 0.10 THEN 'warn' ELSE 'stable' END"


@query("psi_drift", _drift_sql([TARGET], TARGET, LIVE_FACTOR) + f"""
SELECT round(psi, 6) AS psi, {_STATUS} AS status FROM p
""")
def psi_drift(spark, d):
    """Target PSI between the training prices and the live window's, inflated by 35 %."""
    t = _drift(spark, d, [TARGET])
    return t.select(F.round("psi", 6).alias("psi"), psi.status(F.col("psi")).alias("status"))


@query("drift_table", _DRIFT_ALL + f"""
SELECT feature, CASE WHEN feature = '{TARGET}' THEN 'target' ELSE 'input' END AS kind, round(psi, 6) AS psi,
       {_STATUS} AS status, psi > 0.25 AS breached FROM p
""")
def drift_table(spark, d):
    lines, live = _windows(spark, d, [*INPUTS, TARGET])
    t = psi.drift_table(lines.where("split = 'train'"), live, INPUTS, TARGET)
    return t.select("feature", "kind", F.round("psi", 6).alias("psi"), "status", "breached")


# ---------------------------------------------------------------- model versions (fitted by aggregation)

def fit_versions(train):
    """Three versions fitted by distributed aggregation on the training split:
    1 = one price per unit, 2 = price per unit of each part (fallback 1), 3 = mean line price.

    Returns ``(prepare, predictions)``: ``prepare`` attaches the fitted tables to a
    frame (the per-part table is broadcast only when small), ``predictions`` maps
    each version to its prediction expression, so all versions score in one pass.
    """
    overall = train.agg((money_total(TARGET).cast("double") / F.sum("l_quantity")).alias("rate"),
                        F.avg(TARGET).alias("mean_price"))
    per_part = train.groupBy("l_partkey").agg(
        (money_total(TARGET).cast("double") / F.sum("l_quantity")).alias("part_rate"))

    fitted = overall.select(F.struct("rate", "mean_price").alias("o")).scalar()

    def prepare(df):
        with_overall = df.withColumn("rate", fitted["rate"]).withColumn("mean_price", fitted["mean_price"])
        return with_overall.join(broadcast_if_small(per_part), "l_partkey", "left")

    predictions = {
        1: F.col("l_quantity") * F.col("rate"),
        2: F.col("l_quantity") * F.coalesce(F.col("part_rate"), F.col("rate")),
        3: F.col("mean_price"),
    }
    return prepare, predictions


_VERSIONS_SQL = f"""
WITH ref AS (SELECT *, {_BUCKET} AS b FROM lineitem),
tr AS (SELECT * FROM ref WHERE b < 70),
o AS (SELECT CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) / sum(l_quantity) AS rate,
             CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) / count(*) AS mean_price FROM tr),
pp AS (SELECT l_partkey, CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) / sum(l_quantity) AS part_rate
       FROM tr GROUP BY l_partkey),
pred AS (
  SELECT 1 AS version, x.b, x.l_extendedprice AS y, x.l_quantity * o.rate AS p FROM ref x, o
  UNION ALL
  SELECT 2, x.b, x.l_extendedprice, x.l_quantity * coalesce(pp.part_rate, o.rate) FROM ref x CROSS JOIN o
    LEFT JOIN pp ON pp.l_partkey = x.l_partkey
  UNION ALL
  SELECT 3, x.b, x.l_extendedprice, o.mean_price FROM ref x, o),
recorded AS (SELECT version, avg(abs(p - y)) AS test_mae FROM pred WHERE b >= 70 AND b < 85 GROUP BY version),
live AS (SELECT version, avg(abs(p - y * CAST({LIVE_FACTOR} AS DOUBLE))) AS live_mae, count(*) AS rows FROM pred WHERE b >= 85 GROUP BY version),
dec AS (SELECT l.version, r.test_mae, l.live_mae, l.rows, l.live_mae / r.test_mae AS error_multiple,
               coalesce(r.test_mae > 0 AND l.live_mae > 3.0 * r.test_mae, false) AS decayed
        FROM live l LEFT JOIN recorded r ON r.version = l.version)"""


def _decay_rows(spark, d, lines=None):
    """(errors, decay) of all versions: the test and the live window are scored in one pass, and the
    result, a row per window and version, is written for both uses."""
    if lines is None:
        lines, _ = _windows(spark, d, ["l_partkey", "l_quantity", TARGET])
    prepare, predictions = fit_versions(lines.where("split = 'train'"))
    price = F.when(F.col("split") == "score", F.col(TARGET) * F.lit(LIVE_FACTOR)).otherwise(F.col(TARGET))
    unseen = prepare(lines.where("split <> 'train'").withColumn(TARGET, price))
    scores = landed(monitor.candidate_errors_columns(unseen, predictions, TARGET, by=["split"]), "version-errors")
    errors = scores.where("split = 'score'").drop("split")
    recorded = scores.where("split = 'test'").select("version", F.col("live_mae").alias("test_mae"))
    return errors, monitor.decay(errors, recorded)


@query("model_candidates", _VERSIONS_SQL + """
SELECT version, round(live_mae, 6) AS live_mae, rows FROM live
""")
def model_candidates(spark, d):
    """Every version scored on the same live rows; one aggregate gives each version's error."""
    errors, _ = _decay_rows(spark, d)
    return errors.select("version", F.round("live_mae", 6).alias("live_mae"), "rows")


@query("decay_check", _VERSIONS_SQL + """
SELECT version, round(test_mae, 6) AS test_mae, round(live_mae, 6) AS live_mae,
       round(error_multiple, 6) AS error_multiple, decayed FROM dec
""")
def decay_check(spark, d):
    _, dec = _decay_rows(spark, d)
    return dec.select("version", F.round("test_mae", 6).alias("test_mae"), F.round("live_mae", 6).alias("live_mae"),
                      F.round("error_multiple", 6).alias("error_multiple"), "decayed")


def stage_events(spark, d):
    """The registry of the monitored model, dated by the order book: v1 at its first order, v2 at
    its last, v3 staged a day later."""
    span = read_table(spark, d, "orders").agg(F.min("o_orderdate").alias("a"), F.max("o_orderdate").alias("b"))
    events = F.array(*[
        F.struct(F.lit("price").alias("model_name"), F.lit(v).cast("bigint").alias("version"), F.lit(stage).alias("stage"),
                 at.cast("timestamp_ntz").alias("event_time"), F.lit(why).alias("reason"))
        for v, stage, at, why in ((1, registry.PRODUCTION, F.col("a"), "initial"),
                                  (2, registry.PRODUCTION, F.col("b"), "passed gate"),
                                  (3, registry.STAGING, F.col("b") + F.expr("INTERVAL 1 DAY"), "candidate"))])
    return span.select(F.inline(events))


def _decision(spark, d):
    """(stage events, candidate rows, drift rows, decision row) of one monitoring run."""
    log = stage_events(spark, d)
    champion = registry.production_version(log, "price")
    lines, live = _windows(spark, d, ["l_partkey", *INPUTS, TARGET])
    # A row per monitored column; read several times by what follows.
    drift = landed(psi.drift_table(lines.where("split = 'train'"), live, INPUTS, TARGET), "drift")
    _, dec = _decay_rows(spark, d, lines)
    return log, dec, drift, monitor.decide(dec, drift, champion)


_DECISION_SQL = _VERSIONS_SQL + "," + _DRIFT_ALL.strip()[len("WITH"):] + """,
ch AS (SELECT live_mae AS champion_mae, decayed FROM dec WHERE version = 2),
ot AS (SELECT version AS best_version, live_mae AS best_mae FROM dec WHERE version <> 2 ORDER BY live_mae, version LIMIT 1),
dr AS (SELECT coalesce(max(CASE WHEN psi > 0.25 THEN 1 ELSE 0 END), 0) = 1 AS breached,
              list_sort(list(feature) FILTER (WHERE psi > 0.25)) AS drifted_columns FROM p),
x AS (SELECT *, coalesce(best_mae < champion_mae * 0.9, false) AS wins FROM ch, ot, dr),
decision AS (
  SELECT *, CASE WHEN NOT breached AND NOT decayed AND NOT wins THEN 'none' WHEN wins THEN 'rollback' ELSE 'retrain' END AS action,
         CASE WHEN NOT breached AND NOT decayed AND NOT wins THEN 'healthy' WHEN wins THEN 'regression'
              WHEN breached THEN 'world_moved' ELSE 'decayed' END AS diagnosis
  FROM x)
"""


@query("monitor_decision", _DECISION_SQL + """
SELECT CAST(2 AS BIGINT) AS champion_version, round(champion_mae, 6) AS champion_mae, best_version,
       round(best_mae, 6) AS best_mae, breached, decayed, wins AS challenger_wins, drifted_columns, action, diagnosis
FROM decision
""")
def monitor_decision(spark, d):
    """Champion from the registry; drift, decay and challengers decide none/alert/rollback/retrain."""
    out = _decision(spark, d)[3]
    return out.withColumn("champion_mae", F.round("champion_mae", 6)).withColumn("best_mae", F.round("best_mae", 6))


@query("monitoring_candidates", _DECISION_SQL + """
SELECT dec.version, CASE WHEN dec.version = 2 THEN 'champion' ELSE 'challenger' END AS role,
       dec.version = decision.best_version AS best_challenger, round(dec.test_mae, 6) AS test_mae,
       round(dec.live_mae, 6) AS live_mae, dec.decayed
FROM dec, decision
""")
def monitoring_candidates(spark, d):
    """Every version on the live window, with its role and whether it is the best challenger."""
    _, dec, _, row = _decision(spark, d)
    return monitor.candidates(dec, row).withColumn("test_mae", F.round("test_mae", 6)).withColumn(
        "live_mae", F.round("live_mae", 6))


@query("monitoring_incidents", _DECISION_SQL + f"""
SELECT action, diagnosis, list_contains(drifted_columns, '{TARGET}') AS target_drift,
       len(list_filter(drifted_columns, lambda c: c <> '{TARGET}')) > 0 AS input_drift,
       list_filter(drifted_columns, lambda c: c <> '{TARGET}') AS drifted_inputs,
       round((SELECT test_mae FROM dec WHERE version = 2), 6) AS baseline_mae, round(champion_mae, 6) AS champion_mae,
       printf('v2 %s: error %.2f against %.2f at release; best other v%d at %.2f', diagnosis, champion_mae,
              (SELECT test_mae FROM dec WHERE version = 2), best_version, best_mae) AS detail
FROM (SELECT * REPLACE (coalesce(drifted_columns, []) AS drifted_columns) FROM decision)
""")
def monitoring_incidents(spark, d):
    """What a run found, in one row: drift of inputs and target, errors, and a line of text."""
    _, dec, _, row = _decision(spark, d)
    return monitor.incident(dec, row, TARGET).withColumn("baseline_mae", F.round("baseline_mae", 6)).withColumn(
        "champion_mae", F.round("champion_mae", 6))


@query("registry_after_rollback", _DECISION_SQL + """
SELECT 'price' AS model_name, CASE WHEN action = 'rollback' THEN best_version ELSE 2 END AS version,
       CASE WHEN action = 'rollback' THEN diagnosis ELSE 'passed gate' END AS reason
FROM decision
""")
def registry_after_rollback(spark, d):
    """Production after the remedy: a rollback appends an event that moves it to the best version."""
    log, _, _, row = _decision(spark, d)
    after = monitor.apply_remedy(log, row, "price")
    newest = F.max_by(F.struct("version", "reason"), F.struct("event_time", "version"))
    return after.where(F.col("stage") == registry.PRODUCTION).groupBy("model_name").agg(newest.alias("b")).select(
        "model_name", "b.version", "b.reason")


# ---------------------------------------------------------------- leaderboard

_LOG_SQL = """
WITH runs AS (
  SELECT 'learner_' || lower(l_returnflag) AS framework, 'fare_' || lower(l_returnflag) AS model_name,
         CASE WHEN l_linestatus = 'F' THEN 1 ELSE 2 END AS version,
         CASE WHEN l_linestatus = 'F' THEN min(l_shipdate) ELSE max(l_shipdate) END AS recorded_at,
         count(*) / CAST(1000 AS DOUBLE) AS train_seconds,
         round(max(l_extendedprice) / 10000, 6) AS train_rmse, round(avg(l_extendedprice) / 1000, 6) AS test_rmse,
         round(avg(l_quantity), 6) AS test_mae, round(avg(l_discount) * 10, 6) AS test_r2,
         round(stddev_pop(l_extendedprice) / 1000, 6) AS score_rmse, round(stddev_pop(l_quantity), 6) AS score_mae,
         round(avg(l_tax) * 10, 6) AS score_r2
  FROM lineitem GROUP BY l_returnflag, l_linestatus),
latest AS (SELECT framework, max(recorded_at) AS recorded_at FROM runs GROUP BY framework),
board AS (SELECT r.* FROM runs r JOIN latest USING (framework, recorded_at) WHERE score_rmse IS NOT NULL),
ranked AS (SELECT *, row_number() OVER (ORDER BY score_rmse, framework) AS rank FROM board),
top AS (SELECT max(CASE WHEN rank = 1 THEN score_rmse END) AS best, max(CASE WHEN rank = 2 THEN score_rmse END) AS runner FROM ranked)
"""


@query("leaderboard", _LOG_SQL + """
SELECT framework, model_name, version, train_seconds, train_rmse, test_rmse, test_mae, test_r2, score_rmse, score_mae, score_r2, rank, rank = 1 AS is_champion,
       'score_rmse' AS ranked_on,
       round(CASE WHEN runner IS NULL OR runner = 0 THEN 100.0 ELSE 100.0 * (runner - best) / runner END, 6) AS margin_pct,
       CASE WHEN (CASE WHEN runner IS NULL OR runner = 0 THEN 100.0 ELSE 100.0 * (runner - best) / runner END) >= 5.0
            THEN 'clear win' ELSE 'too close to call' END AS verdict
FROM ranked, top
""")
def leaderboard_q(spark, d):
    log = leaderboard.metrics_log_from_lines(read_table(spark, d, "lineitem"))
    return leaderboard.board(log)


@query("win_margin", _LOG_SQL + """
SELECT best, runner AS runner_up,
       round(CASE WHEN runner IS NULL OR runner = 0 THEN 100.0 ELSE 100.0 * (runner - best) / runner END, 6) AS margin_pct
FROM top
""")
def win_margin(spark, d):
    """Winner's margin over the runner-up, from the ranked board (no collect)."""
    log = leaderboard.metrics_log_from_lines(read_table(spark, d, "lineitem"))
    return leaderboard.margin(leaderboard.ranked(leaderboard.latest_board(log)))
