"""Training gate: a learnable target passes, a shuffled one fails before registration; versions; save/load is exact."""

import numpy as np
import pytest

from lakeloom.operators import gate, registry, train
from lakeloom.operators.features import FEATURES, TARGET
from lakeloom.session import scratch_path
from lakeloom.sinks import Sink


def frame(spark, learnable: bool, n: int = 3000):
    rng = np.random.default_rng(11)
    x = {"quantity": rng.uniform(1, 50, n), "days_to_ship": rng.integers(1, 181, n), "order_hour": rng.integers(0, 24, n),
         "order_dow": rng.integers(1, 8, n), "customer_nation": rng.integers(0, 25, n),
         "supplier_nation": rng.integers(0, 25, n), "part_size": rng.integers(1, 51, n)}
    y = 900.0 * x["quantity"] + 20.0 * x["part_size"] + rng.normal(0, 500, n)
    if not learnable:
        rng.shuffle(y)
    split = np.where(np.arange(n) % 5 == 0, "test", "train")
    rows = [tuple(float(x[c][i]) for c in FEATURES) + (float(y[i]), str(split[i])) for i in range(n)]
    return spark.createDataFrame(rows, ", ".join(f"{c} double" for c in [*FEATURES, TARGET]) + ", split string")


def store(spark):
    return Sink(mode="append", path=scratch_path(spark, "log")), scratch_path(spark, "models")


def test_versions_grow_from_the_log_and_the_last_one_scores(spark):
    log, model_dir = store(spark)
    df = frame(spark, True)
    out, gate_rows, first = train.train_gate_register(df, log, model_dir)
    assert {r["metric"]: r["value"] for r in out.collect()}["test_r2"] > 0.95
    assert all(r["passed"] for r in gate_rows.collect())
    _, _, second = train.train_gate_register(df, log, model_dir, kind="linear")
    assert (first, second) == (1, 2)
    preds = Sink(mode="overwrite_partitions", path=scratch_path(spark, "p"), partition_by=["scored_on"], require_rows=True)
    for day in ("2024-01-01", "2024-01-02", "2024-01-02"):
        assert train.score_in_production(df.limit(100), log, model_dir, preds, day) == 2
    rows = preds.read(spark).groupBy("scored_on", "model_version").count().collect()
    assert sorted((str(r[0]), r[1], r[2]) for r in rows) == [("2024-01-01", 2, 100), ("2024-01-02", 2, 100)]


def test_scoring_needs_a_version_in_production(spark):
    log, model_dir = store(spark)
    preds = Sink(mode="append", path=scratch_path(spark, "p"))
    with pytest.raises(registry.NoProductionVersion):
        train.score_in_production(frame(spark, True, 50), log, model_dir, preds, "2024-01-01")
    assert not preds.exists(spark)


def test_shuffled_target_fails_gate_before_registration(spark):
    log, model_dir = store(spark)
    with pytest.raises(gate.GateFailed, match="test_r2"):
        train.train_gate_register(frame(spark, False), log, model_dir)
    assert not log.exists(spark)
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(model_dir)
    assert not p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p)


def test_boosting_stops_before_it_learns_noise(spark):
    noise = train.learner("gbt").fit(train.held_back(frame(spark, False, 1000)))
    assert noise.stages[-1].getNumTrees < 30


def texts(spark, shuffled: bool):
    """400 texts, one in ten of the rare class, whose words differ between the classes."""
    rng = np.random.default_rng(3)
    labels = (np.arange(400) % 10 == 0).astype(int)
    words = [["river", "stone", "field"], ["melody", "chord", "rhythm"]]
    bodies = [" ".join(rng.choice(words[k] + ["the", "of"], 12)) for k in labels]
    if shuffled:
        rng.shuffle(labels)
    return spark.createDataFrame([(i, bodies[i], int(labels[i]), "test" if i // 10 % 4 == 0 else "train")
                                  for i in range(400)], "doc_id long, text string, label int, split string")


def test_text_gate_is_enforced(spark):
    _, m, gate_rows, facts = train.fit_text_classifier(texts(spark, False))
    assert facts == {"train_rows": 300, "test_rows": 100, "minority": 1}
    assert {r["bar"]: r["passed"] for r in gate_rows.collect()} == {"min_accuracy": True, "min_minority_recall": True}
    with pytest.raises(gate.GateFailed, match="minority_recall"):
        train.fit_text_classifier(texts(spark, True))
    with pytest.raises(train.NotEnoughData):
        train.fit_text_classifier(texts(spark, False).limit(8))


def test_save_load_predicts_equally(spark):
    from pyspark.ml import PipelineModel

    df = frame(spark, True, 600)
    model = train.learner("gbt").fit(train.held_back(df))
    path = scratch_path(spark, "model-roundtrip")
    model.write().overwrite().save(path)
    again = PipelineModel.load(path)
    a = [r["prediction"] for r in model.transform(df).orderBy("quantity").select("prediction").collect()]
    b = [r["prediction"] for r in again.transform(df).orderBy("quantity").select("prediction").collect()]
    assert a == b


def test_gate_bars_inclusive(spark):
    long = spark.createDataFrame([("test_rmse", 2.0), ("test_r2", 0.8)], "metric string, value double")
    rows = {r["bar"]: r["passed"] for r in gate.evaluate(long, gate.bars_frame(spark, {
        "max_test_rmse": 2.0, "min_test_r2": 0.8, "max_test_mae": 1.0})).collect()}
    assert rows == {"max_test_rmse": True, "min_test_r2": True, "max_test_mae": False}
    with pytest.raises(ValueError):
        gate.bars_frame(spark, {"best_rmse": 1.0})
