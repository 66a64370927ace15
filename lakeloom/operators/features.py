"""Inputs and target of the charge model: what a sales line will cost the customer at list price.

The target is the list price of the line's quantity after its discount and tax. No price, discount
or tax is among the inputs: a model knows the quantity, the days from order to shipment, hour and
day of week (1 = Sunday) of the order, the nations of customer and supplier and the size of the
part. Lines shipped within 1 to 180 days are plausible; rows without an input or target are dropped.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import split

# Accepted days to shipment, feature set version, model inputs, target.
MIN_DAYS, MAX_DAYS = 1, 180
FEATURE_SET_VERSION = "v2"
FEATURES = ["quantity", "days_to_ship", "order_hour", "order_dow", "customer_nation", "supplier_nation", "part_size"]
TARGET = "list_charge"
KEYS = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]

# SQL source: the joins, projection and pushed range filter run before the transform.
SOURCE_SQL = """
SELECT l.l_orderkey, l.l_linenumber, l.l_partkey, l.l_suppkey, l.l_quantity, l.l_discount, l.l_tax,
       p.p_retailprice, p.p_size, o.o_orderdate, l.l_shipdate, c.c_nationkey, s.s_nationkey
FROM lineitem l
JOIN orders o ON o.o_orderkey = l.l_orderkey
LEFT JOIN part p ON p.p_partkey = l.l_partkey
LEFT JOIN customer c ON c.c_custkey = o.o_custkey
LEFT JOIN supplier s ON s.s_suppkey = l.l_suppkey
WHERE l.l_shipdate BETWEEN TIMESTAMP_NTZ '1995-01-01 00:00:00' AND TIMESTAMP_NTZ '2001-12-31 00:00:00'
"""


def source(spark: SparkSession) -> DataFrame:
    return spark.sql(SOURCE_SQL)


def engineer(raw: DataFrame) -> DataFrame:
    out = raw.select(
        *KEYS, F.to_date("l_shipdate").alias("shipped_on"),
        F.col("l_quantity").cast("double").alias("quantity"),
        F.timestamp_diff("DAY", F.col("o_orderdate"), F.col("l_shipdate")).cast("double").alias("days_to_ship"),
        F.hour("o_orderdate").alias("order_hour"),
        F.dayofweek("o_orderdate").alias("order_dow"),
        F.col("c_nationkey").cast("int").alias("customer_nation"),
        F.col("s_nationkey").cast("int").alias("supplier_nation"),
        F.col("p_size").cast("int").alias("part_size"),
        (F.col("l_quantity") * F.col("p_retailprice") * (1 - F.col("l_discount")) * (1 + F.col("l_tax"))).alias(TARGET),
    )
    return (out.filter(F.col("days_to_ship").between(MIN_DAYS, MAX_DAYS))
            .dropna(subset=[*FEATURES, TARGET]))


def with_split(features: DataFrame) -> DataFrame:
    """70/15/15 by a hash of the row's own key values; no randomness, same split every run."""
    return features.withColumn("split", split.split_label([F.col(k) for k in KEYS], split.THREE_WAY)) \
        .withColumn("feature_set_version", F.lit(FEATURE_SET_VERSION))
