import os

from lakeloom import session


def test_checkpoint_dir_and_scratch(spark):
    base = session.checkpoint_dir(spark)
    assert base
    a, b = session.scratch_path(spark, "x"), session.scratch_path(spark, "x")
    assert a != b and a.startswith(base.rstrip("/"))


def test_package_shipped_once(spark):
    session.ship_package(spark)
    assert spark.sparkContext.applicationId in session._SHIPPED
    # Python workers can import the package through the shipped zip.
    got = spark.sparkContext.parallelize([1], 1).map(lambda _: __import__("lakeloom").__name__).collect()
    assert got == ["lakeloom"]


def test_local_path_strips_scheme():
    assert session.local_path("file:///tmp/a") == os.path.abspath("/tmp/a")
