"""JDBC sources: whole table, pushed-down query, partitioned range reads.

``partitionColumn/lowerBound/upperBound/numPartitions`` cut the key range into
parallel reads; the bounds do not filter — rows outside them land in the first
or last range. Spark refuses a partial set of the three range options, and a
``numPartitions`` alone silently reads with one connection, so both are checked
here before the read starts.
"""

from __future__ import annotations

import logging
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

log = logging.getLogger(__name__)

DERBY_DRIVER = "org.apache.derby.iapi.jdbc.AutoloadedDriver"


def _reader(spark: SparkSession, url: str, driver: str | None, fetchsize: int):
    r = spark.read.format("jdbc").option("url", url).option("fetchsize", str(fetchsize))
    if driver:
        r = r.option("driver", driver)
    return r


def read_table(spark: SparkSession, url: str, table: str, driver: str | None = DERBY_DRIVER,
               fetchsize: int = 10_000) -> DataFrame:
    return _reader(spark, url, driver, fetchsize).option("dbtable", table).load()


def read_query(spark: SparkSession, url: str, sql: str, driver: str | None = DERBY_DRIVER,
               fetchsize: int = 10_000) -> DataFrame:
    """Projection and WHERE run inside the database; only the result crosses the wire."""
    return _reader(spark, url, driver, fetchsize).option("dbtable", f"({sql}) Q").load()


def read_partitioned(spark: SparkSession, url: str, table: str, column: str, lower: int, upper: int,
                     partitions: int, driver: str | None = DERBY_DRIVER, fetchsize: int = 10_000) -> DataFrame:
    if column is None or lower is None or upper is None:
        raise ValueError("partitioned read needs column, lower and upper together")
    if partitions < 2:
        log.warning("partitioned JDBC read with %d partition(s) reads through one connection", partitions)
    return (_reader(spark, url, driver, fetchsize).option("dbtable", table)
            .option("partitionColumn", column).option("lowerBound", str(lower)).option("upperBound", str(upper))
            .option("numPartitions", str(partitions)).load())


def read_parallelism(df: DataFrame, warn_below: int = 2) -> int:
    """How many parallel reads the scan will make; warns when it is a single one."""
    n = df.rdd.getNumPartitions()
    if n < warn_below:
        log.warning("JDBC read runs in %d partition(s): one connection does all the work", n)
    return n


def _derby_type(dt: T.DataType) -> str:
    if isinstance(dt, T.StringType):
        return "VARCHAR(32000)"
    if isinstance(dt, T.LongType):
        return "BIGINT"
    if isinstance(dt, T.IntegerType):
        return "INTEGER"
    if isinstance(dt, T.DoubleType):
        return "DOUBLE"
    if isinstance(dt, (T.TimestampType, T.TimestampNTZType)):
        return "TIMESTAMP"
    raise TypeError(f"no Derby column type for {dt}")


def derby_copy(spark: SparkSession, tables: dict[str, DataFrame]) -> str:
    """Copy frames into a fresh in-process Derby database (test fixture; no server, no port).

    Column names are upper-cased so SQL against the copy needs no quoting.
    Returns the JDBC URL.
    """
    url = f"jdbc:derby:memory:lakeloom_{uuid.uuid4().hex};create=true"
    for name, df in tables.items():
        up = df.select(*[df[c].alias(c.upper()) for c in df.columns])
        types = ", ".join(f"{f.name} {_derby_type(f.dataType)}" for f in up.schema.fields)
        (up.write.format("jdbc").option("url", url).option("driver", DERBY_DRIVER).option("dbtable", name)
         .option("createTableColumnTypes", types).option("batchsize", "10000").option("isolationLevel", "NONE")
         .mode("overwrite").save())
    return url
