import numpy as np
import pytest
from pyspark.sql import functions as F

from lakeloom.operators import metrics, scale


def frame(spark, y, p):
    return spark.createDataFrame([(float(a), float(b)) for a, b in zip(y, p)], "y double, p double")


def m(spark, y, p):
    return metrics.regression_metrics(frame(spark, y, p), "y", "p").first()


def test_perfect_prediction(spark):
    r = m(spark, [1, 2, 3, 4], [1, 2, 3, 4])
    assert (r["rmse"], r["mae"], r["r2"], r["rows"]) == (0.0, 0.0, 1.0, 4)


def test_mean_predictor_r2_zero(spark):
    y = np.arange(1, 101, dtype=float)
    r = m(spark, y, np.full(100, y.mean()))
    assert r["r2"] == pytest.approx(0.0, abs=1e-12)


def test_one_big_miss(spark):
    y = np.zeros(100)
    p = y.copy()
    p[0] = 50
    r = m(spark, y, p)
    assert r["mae"] == pytest.approx(0.5) and r["rmse"] == pytest.approx(5.0)


def test_constant_target_is_finite(spark):
    r = m(spark, [3, 3, 3], [1, 2, 3])
    assert r["r2"] == 0.0


def test_shuffled_predictions_score_badly(spark):
    rng = np.random.default_rng(0)
    y = rng.normal(size=500)
    assert m(spark, y, rng.permutation(y))["r2"] < 0


def test_classification_recall_absent_class(spark):
    df = spark.createDataFrame([(1, 1), (1, 0), (1, 1)], "label int, pred int")
    rows = {(r["metric"], r["class_label"]): r["value"] for r in metrics.classification_metrics(df, "label", "pred").collect()}
    assert rows[("accuracy", None)] == pytest.approx(2 / 3)
    assert rows[("recall", 1)] == pytest.approx(2 / 3)
    assert ("recall", 0) not in rows


def test_scaler_population_std_and_reuse(spark):
    train = spark.createDataFrame([(1.0, 5.0), (2.0, 5.0), (3.0, 5.0)], "a double, b double")
    stats = scale.fit(train, ["a", "b"])
    s = stats.first()
    assert s["a__mean"] == 2.0 and s["a__std"] == pytest.approx(np.std([1, 2, 3]))
    assert s["b__std"] == 1.0  # constant column maps to 0, not a division by zero
    new = spark.createDataFrame([(4.0, 7.0)], "a double, b double")
    z = scale.transform(new, stats, ["a", "b"]).first()
    assert z["a_z"] == pytest.approx((4 - 2) / np.std([1, 2, 3])) and z["b_z"] == 2.0


def test_long_form(spark):
    wide = spark.createDataFrame([("x", 1.0, 2.0)], "k string, rmse double, mae double")
    rows = {r["metric"]: r["value"] for r in metrics.long_form(wide, ["k"], ["rmse", "mae"], "test_").collect()}
    assert rows == {"test_rmse": 1.0, "test_mae": 2.0}
