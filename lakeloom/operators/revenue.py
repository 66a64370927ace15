"""Monthly revenue by seller and by product (sales facts = lineitem ⋈ orders ⟕ customer)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.numeric import money_ratio, money_sum, money_total
from ..plans.sizing import broadcast_if_small, parts_for
from ..session import landed
from ..sources.tables import read_table, sql_source
from .ranking import rank_within

# The SQL source: the join and projection run before the transform sees rows.
TRANSACTIONS_SQL = """
SELECT l.l_orderkey   AS transaction_id,
       o.o_custkey    AS customer_id,
       l.l_suppkey    AS seller_id,
       l.l_partkey    AS product_id,
       l.l_shipdate   AS sold_at,
       l.l_quantity   AS quantity,
       l.l_extendedprice AS total_price,
       c.c_nationkey  AS customer_nation,
       c.c_mktsegment AS customer_segment
FROM lineitem l
JOIN orders o ON o.o_orderkey = l.l_orderkey
LEFT JOIN customer c ON c.c_custkey = o.o_custkey
"""


def transactions(spark: SparkSession) -> DataFrame:
    """Sales facts from the registered ``lineitem``/``orders``/``customer`` views."""
    return spark.sql(TRANSACTIONS_SQL)


# What the monthly revenue needs: the order gives the customer, the customer's row nothing.
SALES_SQL = """
SELECT l.l_orderkey AS transaction_id, o.o_custkey AS customer_id, l.l_suppkey AS seller_id, l.l_partkey AS product_id,
       l.l_shipdate AS sold_at, l.l_quantity AS quantity, l.l_extendedprice AS total_price
FROM lineitem l JOIN orders o ON o.o_orderkey = l.l_orderkey
"""


# Compressed bytes of lines a task may get: sorting and grouping them takes up to some eighty times as much memory.
BYTES_PER_PART = 6 * 1024 * 1024


def _dealt(df: DataFrame, parts: int, *keys: str) -> DataFrame:
    """``df`` dealt over ``parts`` by ``keys``, where they are more than Spark would take by itself."""
    least = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions", "200"))
    return df.repartition(parts, *keys) if parts > least else df


def sales(spark: SparkSession, data_dir: str) -> tuple[DataFrame, int]:
    """Rows of :data:`SALES_SQL` and the number of parts they lie in, which grows with the lines; all lines of an
    order are in one part."""
    lines, orders = read_table(spark, data_dir, "lineitem"), read_table(spark, data_dir, "orders")
    parts = parts_for(lines, BYTES_PER_PART)
    return sql_source(spark, SALES_SQL, views={"lineitem": _dealt(lines, parts, "l_orderkey"),
                                               "orders": _dealt(orders, parts, "o_orderkey")}), parts


def with_month(df: DataFrame, ts: str = "sold_at") -> DataFrame:
    return df.withColumn("revenue_month", F.date_format(F.col(ts), "yyyy-MM"))


def revenue_by_seller(monthly: DataFrame, sellers: DataFrame, parts: int = 0) -> DataFrame:
    """Revenue, units, transactions and customers per seller and month.

    Lines are first summed per transaction, which has one customer, then per customer (over ``parts``, see
    :func:`sales`); customers are then rows to count.
    """
    month = ["seller_id", "revenue_month"]
    sales = monthly.groupBy(*month, "transaction_id").agg(
        money_total("total_price").alias("paid"), F.sum("quantity").alias("units"),
        F.min("customer_id").alias("customer_id"))
    buyers = _dealt(sales, parts, *month, "customer_id").groupBy(*month, "customer_id").agg(
        F.sum("paid").alias("paid"), F.sum("units").alias("units"), F.count("*").alias("transactions"))
    totals = buyers.groupBy(*month).agg(
        F.sum("paid").alias("paid"), F.sum("units").alias("items_sold"), F.sum("transactions").alias("transactions"),
        F.count("customer_id").alias("customers"))
    named = sellers.select(F.col("s_suppkey").alias("seller_id"), F.col("s_name").alias("seller_name"),
                           F.col("s_nationkey").alias("seller_nation"))
    return totals.join(broadcast_if_small(named), "seller_id", "left").select(
        *month, "items_sold", "transactions", "customers", "seller_name", "seller_nation",
        F.col("paid").cast("double").alias("revenue"),
        money_ratio(F.col("paid"), F.col("transactions")).alias("avg_transaction_value"))


def revenue_by_product(monthly: DataFrame) -> DataFrame:
    """Revenue per product and month (lines need no join), ranked within the month; ties share
    a rank. See :func:`rank_within` for months that hold very many products. The aggregate, far smaller
    than the lines, is written once and ranked from there."""
    sold = landed(monthly.groupBy("product_id", "revenue_month").agg(
        money_sum("total_price").alias("revenue"), F.sum("quantity").alias("units"),
        F.count_distinct("transaction_id").alias("transactions")), "product-months")
    return rank_within(sold, ["revenue_month"], "revenue", "revenue_rank", descending=True)


class CustomerRevenue:
    """The revenue task in task form: two outputs from one SQL source.

    ``seller_revenue`` is merged on (seller_id, revenue_month) so a re-run corrects
    rows instead of duplicating them; ``product_revenue`` is written with dynamic
    partition overwrite by month, so a backfill of one month leaves the others.
    """

    @staticmethod
    def build(data_dir: str, seller_path: str, product_path: str):
        from ..sinks import Sink
        from ..task import Source, Task

        class _Task(Task):
            inputs = {
                "transactions": Source(fn=lambda spark, params: sales(spark, params["data_dir"])[0]),
                "sellers": Source(table="supplier"),
            }
            outputs = {
                "seller_revenue": Sink(mode="merge", path=seller_path, merge_keys=["seller_id", "revenue_month"],
                                       options={"mergeSchema": "true"}),
                "product_revenue": Sink(mode="overwrite_partitions", path=product_path, partition_by=["revenue_month"]),
            }
            defaults = {"data_dir": data_dir}

            def transform(self, sources, params):
                monthly = with_month(sources["transactions"])
                parts = parts_for(read_table(monthly.sparkSession, params["data_dir"], "lineitem"), BYTES_PER_PART)
                return {"seller_revenue": revenue_by_seller(monthly, sources["sellers"], parts),
                        "product_revenue": revenue_by_product(monthly)}

        return _Task()
