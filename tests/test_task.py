import pytest
from pyspark.sql import functions as F

from lakeloom.session import scratch_path
from lakeloom.sinks import Sink
from lakeloom.task import Source, Task, TaskError, run
from tests.conftest import SF_SMALL


class Revenue(Task):
    inputs = {"lines": Source(sql="SELECT l_returnflag, l_extendedprice * :factor AS p FROM li", views={"li": "lineitem"})}
    defaults = {"factor": 1.0, "data_dir": SF_SMALL}

    def transform(self, sources, params):
        return {"by_flag": sources["lines"].groupBy("l_returnflag").agg(F.sum("p").alias("p"))}


def test_run_writes_declared_outputs(spark):
    t = Revenue()
    t.outputs = {"by_flag": Sink(mode="overwrite", path=scratch_path(spark, "task"), require_rows=True)}
    landed = run(t, spark, {"factor": 2.0})
    assert landed == {"by_flag": 3}


def test_output_names_must_match(spark):
    t = Revenue()
    t.outputs = {"other": Sink(mode="overwrite", path=scratch_path(spark, "task"))}
    with pytest.raises(TaskError, match="do not match"):
        run(t, spark)


def test_unknown_profile(spark):
    with pytest.raises(TaskError, match="profile"):
        run(Revenue(), spark, profile="STAGING")


def test_revenue_task_rerun_changes_nothing(spark):
    from lakeloom.operators.fingerprint import fingerprint
    from lakeloom.operators.revenue import CustomerRevenue

    seller, product = scratch_path(spark, "seller"), scratch_path(spark, "product")
    task = CustomerRevenue.build(SF_SMALL, seller, product)
    run(task, spark)
    first = [fingerprint(spark.read.parquet(p)).first()["fingerprint"] for p in (seller, product)]
    run(task, spark)
    second = [fingerprint(spark.read.parquet(p)).first()["fingerprint"] for p in (seller, product)]
    assert first == second
    assert spark.read.parquet(product).select("revenue_month").distinct().count() > 1
