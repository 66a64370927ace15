"""Sinks (B1-B9), partition-pruned scans (A11) and JDBC sources."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..catalog import query
from ..operators import bands, split
from ..session import scratch_path
from ..sinks import Sink, write
from ..sources.tables import read_table

_ORDER_COLS = ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority"]


def _merge_batch(orders):
    """Corrections for finished orders and first sight of pending ones."""
    return orders.filter(F.col("o_orderstatus").isin("F", "P")).select(
        "o_orderkey", "o_custkey", "o_orderstatus", (F.col("o_totalprice") + F.lit(100.0)).alias("o_totalprice"),
        "o_orderdate", F.lit("MERGED").alias("o_orderpriority"))


_MERGED_SQL = """
SELECT o_orderkey, o_custkey, o_orderstatus,
       CASE WHEN o_orderstatus IN ('F', 'P') THEN o_totalprice + 100.0 ELSE o_totalprice END AS o_totalprice,
       o_orderdate, CASE WHEN o_orderstatus IN ('F', 'P') THEN 'MERGED' ELSE o_orderpriority END AS o_orderpriority
FROM orders
"""


def _merged(spark, d, runs: int):
    orders = read_table(spark, d, "orders").select(*_ORDER_COLS)
    sink = Sink(mode="merge", path=scratch_path(spark, "merge"), merge_keys=["o_orderkey"])
    write(orders.filter(F.col("o_orderstatus").isin("O", "F")), Sink(mode="overwrite", path=sink.path))
    for _ in range(runs):
        write(_merge_batch(orders), sink)
    return sink.read(spark)


@query("merge_upsert", _MERGED_SQL)
def merge_upsert(spark, d):
    """Target = open and finished orders; the batch replaces finished ones and inserts pending ones."""
    return _merged(spark, d, 1)


@query("merge_idempotent", _MERGED_SQL)
def merge_idempotent(spark, d):
    """The same merge applied twice leaves the same table as applying it once."""
    return _merged(spark, d, 2)


@query("overwrite_partitions", """
SELECT o_orderkey, o_orderstatus, o_totalprice, strftime(o_orderdate, '%Y-%m') AS order_month,
       o_orderpriority FROM orders WHERE year(o_orderdate) <> 1998
UNION ALL
SELECT o_orderkey, o_orderstatus, o_totalprice, strftime(o_orderdate, '%Y-%m'), 'RELOADED'
FROM orders WHERE year(o_orderdate) = 1998 AND o_orderstatus <> 'P'
""")
def overwrite_partitions(spark, d):
    """A backfill of 1998 replaces exactly the months it carries; every other month stands."""
    orders = read_table(spark, d, "orders").select(
        "o_orderkey", "o_orderstatus", "o_totalprice", "o_orderpriority",
        F.date_format("o_orderdate", "yyyy-MM").alias("order_month"))
    sink = Sink(mode="overwrite_partitions", path=scratch_path(spark, "by-month"), partition_by=["order_month"])
    write(orders, Sink(mode="overwrite", path=sink.path, partition_by=["order_month"]))
    backfill = orders.filter(F.col("order_month").between("1998-01", "1998-12") & (F.col("o_orderstatus") != "P")) \
        .withColumn("o_orderpriority", F.lit("RELOADED"))
    write(backfill, sink)
    return sink.read(spark).select("o_orderkey", "o_orderstatus", "o_totalprice", "order_month", "o_orderpriority")


@query("overwrite_table", """
SELECT l_linestatus AS flag, count(*) AS n_lines FROM lineitem GROUP BY l_linestatus
""")
def overwrite_table(spark, d):
    li = read_table(spark, d, "lineitem")
    sink = Sink(mode="overwrite", path=scratch_path(spark, "overwrite"))
    write(li.groupBy(F.col("l_returnflag").alias("flag")).agg(F.count("*").alias("n_lines")), sink)
    write(li.groupBy(F.col("l_linestatus").alias("flag")).agg(F.count("*").alias("n_lines")), sink)
    return sink.read(spark)


@query("append_log", """
SELECT 1 AS run, 'lines' AS metric, l_returnflag AS key, CAST(count(*) AS DOUBLE) AS value FROM lineitem GROUP BY l_returnflag
UNION ALL
SELECT 2, 'quantity', l_returnflag, sum(l_quantity) FROM lineitem GROUP BY l_returnflag
""")
def append_log(spark, d):
    """A long-form metrics log: each run appends; nothing already logged changes."""
    li = read_table(spark, d, "lineitem")
    sink = Sink(mode="append", path=scratch_path(spark, "metrics-log"))
    write(li.groupBy(F.col("l_returnflag").alias("key")).agg(F.count("*").cast("double").alias("value"))
          .select(F.lit(1).alias("run"), F.lit("lines").alias("metric"), "key", "value"), sink)
    write(li.groupBy(F.col("l_returnflag").alias("key")).agg(F.sum("l_quantity").alias("value"))
          .select(F.lit(2).alias("run"), F.lit("quantity").alias("metric"), "key", "value"), sink)
    return sink.read(spark)


@query("schema_evolution", """
SELECT c_custkey, c_name, NULL AS c_mktsegment FROM customer
UNION ALL
SELECT c_custkey, c_name, c_mktsegment FROM customer WHERE c_acctbal > 5000
""")
def schema_evolution(spark, d):
    """A later batch adds a column; old rows read back with NULL in it (Parquet schema merge)."""
    c = read_table(spark, d, "customer")
    sink = Sink(mode="append", path=scratch_path(spark, "evolving"), options={"mergeSchema": "true"})
    write(c.select("c_custkey", "c_name"), sink)
    write(c.filter(F.col("c_acctbal") > 5000).select("c_custkey", "c_name", "c_mktsegment"), sink)
    return sink.read(spark).select("c_custkey", "c_name", "c_mktsegment")


_SPLIT_KEY = "concat_ws('|', CAST(l_orderkey AS VARCHAR), CAST(l_linenumber AS VARCHAR), CAST(l_partkey AS VARCHAR), CAST(l_suppkey AS VARCHAR))"
_BUCKET = f"CAST(('0x' || substr(sha256({_SPLIT_KEY}), 1, 8)) AS UBIGINT) % 100"


def lines_with_split(spark, d):
    li = read_table(spark, d, "lineitem")
    cols = [F.col("l_orderkey"), F.col("l_linenumber"), F.col("l_partkey"), F.col("l_suppkey")]
    return li.withColumn("split", split.split_label(cols, split.THREE_WAY))


@query("split_scan", f"""
SELECT l_orderkey, l_linenumber, l_extendedprice, 'train' AS split FROM lineitem WHERE {_BUCKET} < 70
""")
def split_scan(spark, d):
    """Write once partitioned by split; each consumer's ``split = 'train'`` prunes to one folder."""
    path = scratch_path(spark, "lines-by-split")
    write(lines_with_split(spark, d).select("l_orderkey", "l_linenumber", "l_extendedprice", "split"),
          Sink(mode="overwrite", path=path, partition_by=["split"]))
    return spark.read.parquet(path).filter(F.col("split") == "train")


# ---------------------------------------------------------------- sinks: moved keys, landed rows, new columns

@query("merge_partition_move", """
SELECT c_custkey, c_name, CASE WHEN c_acctbal < 0 THEN 'WATCH' ELSE c_mktsegment END AS c_mktsegment FROM customer
""")
def merge_partition_move(spark, d):
    """A merge moves customers in debt to another partition: each key stays in one partition only."""
    c = read_table(spark, d, "customer").select("c_custkey", "c_name", "c_mktsegment", "c_acctbal")
    sink = Sink(mode="merge", path=scratch_path(spark, "moves"), merge_keys=["c_custkey"], partition_by=["c_mktsegment"])
    write(c.drop("c_acctbal"), sink)
    write(c.where("c_acctbal < 0").drop("c_acctbal").withColumn("c_mktsegment", F.lit("WATCH")), sink)
    return sink.read(spark).select("c_custkey", "c_name", "c_mktsegment")


@query("landed_rows", """
SELECT 'all' AS batch, count(*) AS landed FROM orders
UNION ALL SELECT 'open', count(*) FROM orders WHERE o_orderstatus = 'O'
""")
def landed_rows(spark, d):
    """Rows landed by two runs into one target, counted from each run's own batch."""
    o = read_table(spark, d, "orders").select("o_orderkey", "o_orderstatus")
    path = scratch_path(spark, "landed")
    counts = []
    for name, batch, mode in (("all", o, "overwrite"), ("open", o.where("o_orderstatus = 'O'"), "overwrite_partitions")):
        counts.append((name, write(batch, Sink(mode=mode, path=path, partition_by=["o_orderstatus"], require_rows=True))))
    return spark.createDataFrame(counts, "batch string, landed bigint")
