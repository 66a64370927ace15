"""Remedy decision ladder and challenger choice."""


from lakeloom.operators import monitor


def decide(spark, rows, drift_breached=False, champion=2, allow_rollback=True):
    dec = spark.createDataFrame(rows, "version bigint, test_mae double, live_mae double, error_multiple double, decayed boolean")
    drift = spark.createDataFrame([("x", drift_breached)], "feature string, breached boolean")
    return monitor.decide(dec, drift, champion, allow_rollback).first()


def test_healthy(spark):
    r = decide(spark, [(1, 1.0, 1.05, 1.05, False), (2, 1.0, 1.0, 1.0, False)])
    assert (r["action"], r["diagnosis"]) == ("none", "healthy")


def test_lowest_error_wins_ties_to_lowest_version(spark):
    r = decide(spark, [(3, 1.0, 0.5, 0.5, False), (1, 1.0, 0.5, 0.5, False), (2, 1.0, 6.0, 6.0, True)])
    assert r["best_version"] == 1 and (r["action"], r["diagnosis"]) == ("rollback", "regression")


def test_small_improvement_is_not_enough(spark):
    r = decide(spark, [(1, 1.0, 0.98, 0.98, False), (2, 1.0, 1.0, 1.0, False)])
    assert not r["challenger_wins"] and r["action"] == "none"


def test_alert_only_when_rollback_disabled(spark):
    r = decide(spark, [(1, 1.0, 0.5, 0.5, False), (2, 1.0, 1.0, 1.0, False)], allow_rollback=False)
    assert (r["action"], r["diagnosis"]) == ("alert_only", "better_version_available")


def test_drift_means_retrain(spark):
    r = decide(spark, [(1, 1.0, 4.0, 4.0, True), (2, 1.0, 4.0, 4.0, True)], drift_breached=True)
    assert (r["action"], r["diagnosis"]) == ("retrain", "world_moved")


def test_decay_without_drift(spark):
    r = decide(spark, [(1, 1.0, 4.0, 4.0, True), (2, 1.0, 4.0, 4.0, True)])
    assert (r["action"], r["diagnosis"]) == ("retrain", "decayed")


def test_no_challengers(spark):
    r = decide(spark, [(2, 1.0, 1.0, 1.0, False)])
    assert r["best_version"] is None and r["action"] == "none"


def test_decay_needs_positive_baseline(spark):
    errors = spark.createDataFrame([(1, 5.0, 10), (2, 5.0, 10)], "version bigint, live_mae double, rows bigint")
    recorded = spark.createDataFrame([(1, 1.0), (2, 0.0)], "version bigint, test_mae double")
    got = {r["version"]: r["decayed"] for r in monitor.decay(errors, recorded).collect()}
    assert got == {1: True, 2: False}
