"""Training, gating, registration and batch scoring with Spark MLlib.

Fitting is distributed (tree learners aggregate split statistics on executors;
linear models use distributed L-BFGS). Predictions stay a column of the same
row as the truth, so truth and prediction can never be misaligned.
"""

from __future__ import annotations

import time

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import HashingTF, IDF, RegexTokenizer, StandardScaler, VectorAssembler
from pyspark.ml.regression import GBTRegressor, LinearRegression, RandomForestRegressor
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import WHITESPACE_CLASS
from ..session import landed
from ..sinks import Sink, write
from . import gate, metrics, registry
from .features import FEATURES, TARGET

# Promotion bars of the charge model on the held-out split, learner settings. A model that learned
# nothing has an r2 of 0 and an error as large as the target's spread (about 13,600).
MODEL_NAME = "list_charge"
CHARGE_BARS = {"max_test_rmse": 2500.0, "min_test_r2": 0.95}
SEED = 42
HELD_BACK = 10  # one training row in so many decides when boosting stops


def learner(kind: str, features: list[str] = FEATURES, label: str = TARGET) -> Pipeline:
    assemble = VectorAssembler(inputCols=features, outputCol="features", handleInvalid="error")
    if kind == "gbt":
        est = GBTRegressor(featuresCol="features", labelCol=label, predictionCol="prediction", maxIter=30, stepSize=0.3,
                           maxDepth=5, seed=SEED, validationIndicatorCol="held_back", validationTol=0.01)
        return Pipeline(stages=[assemble, est])
    if kind == "random_forest":
        est = RandomForestRegressor(featuresCol="features", labelCol=label, predictionCol="prediction",
                                    numTrees=30, maxDepth=8, seed=SEED)
        return Pipeline(stages=[assemble, est])
    if kind == "linear":
        # The scaler is fitted with the model and saved with it.
        scaled = StandardScaler(inputCol="features", outputCol="scaled", withMean=True)
        est = LinearRegression(featuresCol="scaled", labelCol=label, predictionCol="prediction", regParam=0.0)
        return Pipeline(stages=[assemble, scaled, est])
    raise ValueError(f"unknown learner {kind!r}")


def held_back(train: DataFrame, features: list[str] = FEATURES) -> DataFrame:
    """``train`` plus ``held_back``: the rows, picked by a hash of their inputs, whose error ends boosting early."""
    return train.withColumn("held_back", F.pmod(F.xxhash64(*features), F.lit(HELD_BACK)) == 0)


def fit_and_score(kind: str, train: DataFrame, evaluate_on: dict[str, DataFrame],
                  features: list[str] = FEATURES) -> tuple[PipelineModel, DataFrame, float]:
    """Fit on ``train``; return the model, long metrics per named split, and fit seconds."""
    t0 = time.time()
    model = learner(kind, features).fit(held_back(train, features))
    seconds = time.time() - t0
    parts = None
    for name, frame in {"train": train, **evaluate_on}.items():
        m = metrics.regression_metrics(model.transform(frame), TARGET, "prediction")
        long = metrics.long_form(m, [], ["rmse", "mae", "r2", "rows"], prefix=f"{name}_")
        parts = long if parts is None else parts.unionByName(long)
    return model, parts, seconds


def train_gate_register(features: DataFrame, log: Sink, model_dir: str, model_name: str = MODEL_NAME,
                        kind: str = "gbt", bars: dict | None = None):
    """Train on ``train``, validate on ``test``, gate, save as the log's next version, append a Production event.

    Returns (metrics_long, gate_rows, version). Raises ``GateFailed`` before any
    registration when a bar is missed. The event is written last: a run that ends before it
    leaves a folder that the next run, which gets the same version, writes anew.
    """
    spark = features.sparkSession
    train = features.filter(F.col("split") == "train")
    test = features.filter(F.col("split") == "test")
    model, long, seconds = fit_and_score(kind, train, {"test": test})
    long = landed(long, "metrics")
    gate_rows = landed(gate.evaluate(long, gate.bars_frame(spark, bars or CHARGE_BARS)), "gate")
    gate.enforce(gate_rows)
    version = registry.next_version(log.read(spark), model_name) if log.exists(spark) else 1
    model.write().overwrite().save(f"{model_dir}/{model_name}/v{version}")
    write(registry.event(spark, model_name, version, registry.PRODUCTION, "passed gate"), log)
    out = long.select(F.lit(model_name).alias("model_name"), F.lit(version).cast("bigint").alias("version"),
                      F.lit(kind).alias("learner"), "metric", "value", F.lit(seconds).alias("train_seconds"))
    return out, gate_rows, version


def score_in_production(frame: DataFrame, log: Sink, model_dir: str, out: Sink, run_date: str,
                        model_name: str = MODEL_NAME) -> int:
    """Score ``frame`` with the stored model in production and write the run's partition; returns the version.

    Trains nothing; without a version in production nothing is written.
    """
    spark = frame.sparkSession
    if not log.exists(spark):
        raise registry.NoProductionVersion(f"no production version of {model_name}")
    version = registry.production_version(log.read(spark), model_name)
    model = PipelineModel.load(f"{model_dir}/{model_name}/v{version}")
    write(score(model, frame, version).withColumn("scored_on", F.lit(run_date).cast("date")), out)
    return version


def score(model: PipelineModel, frame: DataFrame, version: int) -> DataFrame:
    """Append ``predicted_charge``, ``prediction_error`` and the model version."""
    return model.transform(frame).select(
        *frame.columns, F.col("prediction").alias("predicted_charge"),
        (F.col("prediction") - F.col(TARGET)).alias("prediction_error"),
        F.lit(version).cast("bigint").alias("model_version"))


def text_pipeline(num_features: int = 1 << 16) -> Pipeline:
    tok = RegexTokenizer(inputCol="text", outputCol="tokens", pattern=WHITESPACE_CLASS, toLowercase=True)
    tf = HashingTF(inputCol="tokens", outputCol="tf", numFeatures=num_features)
    idf = IDF(inputCol="tf", outputCol="features")
    lr = LogisticRegression(featuresCol="features", labelCol="label", predictionCol="prediction", maxIter=50,
                            regParam=0.01, family="binomial", weightCol="weight")
    return Pipeline(stages=[tok, tf, idf, lr])


# Minimum examples and enforced quality bars of the text classifier. Guessing the larger class
# passes neither.
MIN_TRAIN_ROWS, MIN_TEST_ROWS = 20, 5
TEXT_BARS = {"min_accuracy": 0.85, "min_minority_recall": 0.75}


class NotEnoughData(RuntimeError):
    pass


def fit_text_classifier(labelled: DataFrame, bars: dict | None = None):
    """(model, metrics, gate rows, facts) of a two-class text classifier on ``labelled`` (text, label, split).

    Classes weigh the same in training however rare they are. ``facts``: train_rows, test_rows and
    minority, the rarer label (ties: the smaller). Raises ``NotEnoughData`` or ``GateFailed``.
    """
    spark = labelled.sparkSession
    counts = {(r["split"], r["label"]): r["n"] for r in
              labelled.groupBy("split", "label").agg(F.count("*").alias("n")).collect()}  # two splits by two labels
    of = lambda name: {label: n for (s, label), n in counts.items() if s == name}
    train_n, test_n = of("train"), of("test")
    facts = {"train_rows": sum(train_n.values()), "test_rows": sum(test_n.values())}
    if facts["train_rows"] < MIN_TRAIN_ROWS or facts["test_rows"] < MIN_TEST_ROWS or len(train_n) < 2:
        raise NotEnoughData(f"need {MIN_TRAIN_ROWS}/{MIN_TEST_ROWS} rows of two labels, have {counts}")
    totals = {label: train_n[label] + test_n.get(label, 0) for label in train_n}
    facts["minority"] = min(totals, key=lambda label: (totals[label], label))
    weight = F.lit(None).cast("double")
    for label, n in train_n.items():
        weight = F.when(F.col("label") == label, F.lit(facts["train_rows"] / (len(train_n) * n))).otherwise(weight)
    rows = labelled.withColumn("weight", weight).withColumn("label", F.col("label").cast("double"))
    model = text_pipeline().fit(rows.filter(F.col("split") == "train"))
    pred = model.transform(rows.filter(F.col("split") == "test")).select(
        F.col("label").cast("int"), F.col("prediction").cast("int"))
    m = landed(metrics.classification_metrics(pred, "label", "prediction"), "metrics")
    long = m.select(F.when(F.col("metric") == "accuracy", F.lit("accuracy"))
                    .when(F.col("class_label") == facts["minority"], F.lit("minority_recall"))
                    .otherwise(F.concat(F.lit("recall_"), F.col("class_label").cast("string"))).alias("metric"),
                    "value")
    gate_rows = landed(gate.evaluate(long, gate.bars_frame(spark, bars or TEXT_BARS)), "gate")
    gate.enforce(gate_rows)
    return model, m, gate_rows, facts
