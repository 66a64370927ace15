"""Spark session and shared-storage helpers.

Every job runs against whatever session the caller hands in. Settings that
matter for correctness (UTC session time zone, ANSI mode) and for scale (AQE,
skew-join handling) are applied with :func:`tune`, which overrides a value
the cluster has already set for the time zone alone.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Settings applied only where the cluster has not set them already.
DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def get_session(master: str | None = None, app: str = "lakeloom", shuffle_partitions: int | None = None,
                extra: dict | None = None) -> SparkSession:
    """Build (or reuse) a session. ``master`` is left to the platform unless given."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    conf = dict(DEFAULTS)
    conf["spark.ui.enabled"] = "false"
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    tune(spark)
    return spark


def tune(spark: SparkSession) -> SparkSession:
    """Apply :data:`DEFAULTS` and ship this package to the executors' Python workers."""
    for key, value in DEFAULTS.items():
        # Results are defined in UTC, so the time zone alone is always set.
        if key == "spark.sql.session.timeZone" or spark.conf.get(key, None) is None:
            spark.conf.set(key, value)
    ship_package(spark)
    return spark


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Add a zip of ``lakeloom`` to the context's Python path (once per application).

    Functions run inside ``mapInPandas`` refer to helpers of this package; Python
    workers on executors must be able to import it wherever the driver runs from.
    Skipped when the package is already importable from an installed location.
    """
    sc = spark.sparkContext
    app = sc.applicationId
    if app in _SHIPPED:
        return
    pkg_dir = os.path.dirname(os.path.abspath(__file__))
    if "site-packages" in pkg_dir:
        _SHIPPED.add(app)
        return
    import zipfile

    out = os.path.join(tempfile.mkdtemp(prefix="lakeloom-pyfiles-"), "lakeloom.zip")
    root = os.path.dirname(pkg_dir)
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as zf:
        for folder, _, names in os.walk(pkg_dir):
            if "__pycache__" in folder:
                continue
            for name in names:
                if name.endswith(".py"):
                    full = os.path.join(folder, name)
                    zf.write(full, os.path.relpath(full, root))
    sc.addPyFile(out)
    _SHIPPED.add(app)


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    On a cluster this is set by the platform and must be shared storage; it is
    read from the session. Only when it is unset (local tests) is a private
    folder created and registered.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = sc.getConf().get("spark.checkpoint.dir", None) or spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        if not sc.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a shared folder on a cluster")
        configured = tempfile.mkdtemp(prefix="lakeloom-ckpt-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique folder under the shared checkpoint dir for staged writes."""
    base = checkpoint_dir(spark).rstrip("/")
    return f"{base}/lakeloom-scratch/{name}-{uuid.uuid4().hex}"


def landed(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to a fresh scratch folder and read back: computed once, nothing cached."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def local_path(path: str) -> str:
    """Strip a ``file:`` scheme so local tests can inspect written files."""
    if path.startswith("file:"):
        path = path[len("file:"):]
        while path.startswith("//"):
            path = path[1:]
    return os.path.abspath(path)
