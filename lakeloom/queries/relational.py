"""Scans, SQL sources, projections, filters, joins, aggregates, windows, sorts, sets, scalars."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..catalog import query
from ..functions.numeric import money_ratio, money_sum, money_total
from ..operators import bands, latest, revenue
from ..operators.ranking import global_row_number, rank_within
from ..plans.sizing import broadcast_if_small
from ..sources.tables import read_table, register_tables, sql_source


def _views(spark, d, *names):
    return register_tables(spark, d, names)


# ---------------------------------------------------------------- 2.A sources

@query("scan_table", "SELECT * FROM orders")
def scan_table(spark, d):
    return read_table(spark, d, "orders")


@query("sql_source_join", revenue.TRANSACTIONS_SQL)
def sql_source_join(spark, d):
    _views(spark, d, "lineitem", "orders", "customer")
    return revenue.transactions(spark)


PARAM_SQL = """
SELECT l_orderkey, l_linenumber, l_partkey, l_extendedprice * :factor AS live_price
FROM lineitem
"""


@query("sql_param_scale", """
SELECT l_orderkey, l_linenumber, l_partkey, l_extendedprice * CAST(1.35 AS DOUBLE) AS live_price
FROM lineitem
""")
def sql_param_scale(spark, d):
    _views(spark, d, "lineitem")
    return sql_source(spark, PARAM_SQL, params={"factor": 1.35})


# ---------------------------------------------------------------- 2.C projections and filters

@query("project_cast", """
SELECT CAST(c_custkey AS INTEGER) AS customer_id, c_name AS name,
       CAST(c_nationkey AS BIGINT) AS nation_id,
       CAST(c_acctbal AS DECIMAL(12,2)) AS balance, lower(c_mktsegment) AS segment
FROM customer
""")
def project_cast(spark, d):
    c = read_table(spark, d, "customer")
    return c.select(
        F.col("c_custkey").cast("int").alias("customer_id"),
        F.col("c_name").alias("name"),
        F.col("c_nationkey").cast("bigint").alias("nation_id"),
        F.col("c_acctbal").cast("decimal(12,2)").alias("balance"),
        F.lower("c_mktsegment").alias("segment"),
    )


@query("project_derived", """
SELECT l_orderkey, l_linenumber,
       CAST(CAST(l_extendedprice AS DECIMAL(18,2)) * (1 - CAST(l_discount AS DECIMAL(4,2))) AS DECIMAL(18,4)) AS net_price,
       'lineitem' AS source_table,
       l_tax > 0 AS taxed
FROM lineitem
""")
def project_derived(spark, d):
    li = read_table(spark, d, "lineitem")
    net = (F.col("l_extendedprice").cast("decimal(18,2)") * (F.lit(1) - F.col("l_discount").cast("decimal(4,2)")))
    return li.select(
        "l_orderkey", "l_linenumber",
        net.cast("decimal(18,4)").alias("net_price"),
        F.lit("lineitem").alias("source_table"),
        (F.col("l_tax") > 0).alias("taxed"),
    )


@query("filter_range", """
SELECT l_orderkey, l_linenumber, l_shipdate, l_extendedprice FROM lineitem
WHERE l_shipdate BETWEEN TIMESTAMP '1996-01-01 00:00:00' AND TIMESTAMP '1996-12-31 00:00:00'
""")
def filter_range(spark, d):
    li = read_table(spark, d, "lineitem")
    return li.filter(
        F.col("l_shipdate").between(F.lit("1996-01-01").cast("timestamp_ntz"), F.lit("1996-12-31").cast("timestamp_ntz"))
    ).select("l_orderkey", "l_linenumber", "l_shipdate", "l_extendedprice")


@query("dropna_subset", """
SELECT c.c_custkey, c.c_name, o.o_orderkey, o.o_totalprice
FROM customer c LEFT JOIN orders o ON o.o_custkey = c.c_custkey
WHERE o.o_orderkey IS NOT NULL AND o.o_totalprice IS NOT NULL
""")
def dropna_subset(spark, d):
    c = read_table(spark, d, "customer")
    o = read_table(spark, d, "orders")
    joined = c.join(o, o.o_custkey == c.c_custkey, "left").select("c_custkey", "c_name", "o_orderkey", "o_totalprice")
    return joined.dropna(subset=["o_orderkey", "o_totalprice"])


@query("filter_not_null", """
SELECT d.doc_id, d.source, l.quality FROM documents d LEFT JOIN labels l USING (doc_id)
WHERE l.quality IS NOT NULL AND d.text IS NOT NULL
""")
def filter_not_null(spark, d):
    """Documents that have a rating: the matched side of a left join, tested for NULL."""
    docs = read_table(spark, d, "documents").select("doc_id", "source", "text")
    rated = docs.join(read_table(spark, d, "labels").select("doc_id", "quality"), "doc_id", "left")
    return rated.filter(F.col("quality").isNotNull() & F.col("text").isNotNull()).select("doc_id", "source", "quality")


# The priorities an urgent-order report accepts.
URGENT = ["1-urgent", "2-high"]


@query("filter_isin", """
SELECT o_orderkey, o_orderpriority, lower(o_orderpriority) IN ('1-urgent', '2-high') AS is_urgent
FROM orders WHERE NOT (lower(o_orderpriority) IN ('1-urgent', '2-high')) OR o_orderstatus = 'F'
""")
def filter_isin(spark, d):
    o = read_table(spark, d, "orders")
    urgent = F.lower("o_orderpriority").isin(URGENT)
    return o.filter(~urgent | (F.col("o_orderstatus") == "F")).select(
        "o_orderkey", "o_orderpriority", urgent.alias("is_urgent"))


@query("filter_string", """
SELECT p_partkey, p_name, p_brand FROM part
WHERE (p_name LIKE 'small%' OR contains(p_name, 'red')) AND length(p_brand) > 0
""")
def filter_string(spark, d):
    p = read_table(spark, d, "part")
    return p.filter((F.col("p_name").like("small%") | F.col("p_name").contains("red")) & (F.length("p_brand") > 0)) \
        .select("p_partkey", "p_name", "p_brand")


@query("case_ladder", """
SELECT event_id, value,
  CASE WHEN event_type = 'error' THEN 'failure'
       WHEN value >= 90 THEN 'very high'
       WHEN value >= 50 THEN 'high'
       WHEN value >= 10 THEN 'moderate'
       ELSE 'low' END AS band
FROM events
""")
def case_ladder(spark, d):
    e = read_table(spark, d, "events")
    band = (F.when(F.col("event_type") == "error", "failure")
            .when(F.col("value") >= 90, "very high")
            .when(F.col("value") >= 50, "high")
            .when(F.col("value") >= 10, "moderate")
            .otherwise("low"))
    return e.select("event_id", "value", band.alias("band"))


@query("interval_bands", f"""
SELECT doc_id, n_chars, {bands.sql_case('n_chars', bands.LENGTH_BANDS)} AS length_band FROM documents
""")
def interval_bands(spark, d):
    docs = read_table(spark, d, "documents")
    return docs.select("doc_id", "n_chars", bands.band_of(F.col("n_chars"), bands.LENGTH_BANDS).alias("length_band"))


@query("flag_to_bool", """
SELECT l_orderkey, l_linenumber, upper(l_returnflag) = 'R' AS is_returned FROM lineitem
""")
def flag_to_bool(spark, d):
    li = read_table(spark, d, "lineitem")
    return li.select("l_orderkey", "l_linenumber", (F.upper("l_returnflag") == "R").alias("is_returned"))


# ---------------------------------------------------------------- 2.D joins

JOIN_LEFT_SQL = """
SELECT o.o_orderkey, o.o_totalprice, c.c_name, c.c_mktsegment
FROM orders o LEFT JOIN customer c ON c.c_custkey = o.o_custkey
"""


@query("join_left_sql", JOIN_LEFT_SQL)
def join_left_sql(spark, d):
    _views(spark, d, "orders", "customer")
    return spark.sql(JOIN_LEFT_SQL)


@query("join_broadcast_left", """
SELECT a.l_suppkey, a.revenue, a.lines, s.s_name, s.s_nationkey
FROM (SELECT l_suppkey, CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) AS revenue, count(*) AS lines
      FROM lineitem GROUP BY l_suppkey) a
LEFT JOIN supplier s ON s.s_suppkey = a.l_suppkey
""")
def join_broadcast_left(spark, d):
    li = read_table(spark, d, "lineitem")
    sup = read_table(spark, d, "supplier").select("s_suppkey", "s_name", "s_nationkey")
    agg = li.groupBy("l_suppkey").agg(money_sum("l_extendedprice").alias("revenue"), F.count("*").alias("lines"))
    return agg.join(broadcast_if_small(sup), agg.l_suppkey == sup.s_suppkey, "left") \
        .select("l_suppkey", "revenue", "lines", "s_name", "s_nationkey")


@query("join_latest_using", """
WITH latest AS (SELECT user_id, event_type, max(ts) AS ts FROM events GROUP BY user_id, event_type)
SELECT user_id, event_type, ts, e.event_id, e.value FROM events e JOIN latest USING (user_id, event_type, ts)
""")
def join_latest_using(spark, d):
    return latest.newest_by_join(read_table(spark, d, "events"), ["user_id", "event_type"], "ts") \
        .select("user_id", "event_type", "ts", "event_id", "value")


@query("incremental_anti", """
SELECT d.doc_id, d.lang FROM documents d WHERE NOT EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = d.doc_id)
""")
def incremental_anti(spark, d):
    """Documents that still lack a label: only these go to the (expensive) labeller."""
    docs = read_table(spark, d, "documents").select("doc_id", "lang")
    done = read_table(spark, d, "labels").select("doc_id")
    return docs.join(done, "doc_id", "left_anti")


# ---------------------------------------------------------------- 2.E aggregations

@query("agg_group_sum", """
SELECT l_returnflag, l_linestatus,
       sum(l_quantity) AS sum_qty,
       CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) AS sum_price,
       count(*) AS n_lines
FROM lineitem GROUP BY l_returnflag, l_linestatus
""")
def agg_group_sum(spark, d):
    li = read_table(spark, d, "lineitem")
    return li.groupBy("l_returnflag", "l_linestatus").agg(
        F.sum("l_quantity").alias("sum_qty"), money_sum("l_extendedprice").alias("sum_price"),
        F.count("*").alias("n_lines"))


@query("agg_count_distinct", """
SELECT l_returnflag, count(DISTINCT l_orderkey) AS orders, count(DISTINCT l_partkey) AS parts,
       count(DISTINCT l_suppkey) AS suppliers
FROM lineitem GROUP BY l_returnflag
""")
def agg_count_distinct(spark, d):
    li = read_table(spark, d, "lineitem")
    return li.groupBy("l_returnflag").agg(
        F.countDistinct("l_orderkey").alias("orders"), F.countDistinct("l_partkey").alias("parts"),
        F.countDistinct("l_suppkey").alias("suppliers"))


@query("agg_profile", """
SELECT lang, count(*) AS n_docs, min(n_chars) AS min_chars, round(avg(n_chars), 1) AS avg_chars,
       max(n_chars) AS max_chars
FROM documents GROUP BY lang
""")
def agg_profile(spark, d):
    docs = read_table(spark, d, "documents")
    return docs.groupBy("lang").agg(
        F.count("*").alias("n_docs"), F.min("n_chars").alias("min_chars"),
        F.round(F.avg("n_chars"), 1).alias("avg_chars"), F.max("n_chars").alias("max_chars"))


@query("agg_ratio", """
SELECT o_orderpriority, CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS revenue, count(*) AS n_orders,
       CAST(CAST((2 * CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) * 100 AS BIGINT) + count(*)) // (2 * count(*)) AS DECIMAL(18,2)) * 0.01 AS DECIMAL(18,2)) AS avg_order_value
FROM orders GROUP BY o_orderpriority
""")
def agg_ratio(spark, d):
    o = read_table(spark, d, "orders")
    return o.groupBy("o_orderpriority").agg(
        money_total("o_totalprice").alias("_revenue"), F.count("*").alias("n_orders")
    ).select("o_orderpriority", F.col("_revenue").cast("double").alias("revenue"), "n_orders",
             money_ratio(F.col("_revenue"), F.col("n_orders")).alias("avg_order_value"))


@query("agg_group_count", """
SELECT event_type, count(*) AS n FROM events GROUP BY event_type ORDER BY n DESC
""")
def agg_group_count(spark, d):
    return read_table(spark, d, "events").groupBy("event_type").agg(F.count("*").alias("n")).orderBy(F.desc("n"))


@query("agg_global", """
SELECT max(l_shipdate) AS last_ship, CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) AS total_price,
       round(avg(abs(l_discount - 0.05)), 6) AS mean_abs_dev, count(*) AS n_lines
FROM lineitem
""")
def agg_global(spark, d):
    li = read_table(spark, d, "lineitem")
    return li.agg(
        F.max("l_shipdate").alias("last_ship"), money_sum("l_extendedprice").alias("total_price"),
        F.round(F.avg(F.abs(F.col("l_discount") - F.lit(0.05))), 6).alias("mean_abs_dev"),
        F.count("*").alias("n_lines"))


# The event types a pivoted user profile declares as columns.
EVENT_TYPES = ["click", "error", "purchase", "signup", "view"]


@query("agg_pivot", """
SELECT user_id,
  CAST(sum(CAST(value AS DECIMAL(18,2))) FILTER (WHERE event_type = 'click') AS DOUBLE) AS click,
  CAST(sum(CAST(value AS DECIMAL(18,2))) FILTER (WHERE event_type = 'error') AS DOUBLE) AS error,
  CAST(sum(CAST(value AS DECIMAL(18,2))) FILTER (WHERE event_type = 'purchase') AS DOUBLE) AS purchase,
  CAST(sum(CAST(value AS DECIMAL(18,2))) FILTER (WHERE event_type = 'signup') AS DOUBLE) AS signup,
  CAST(sum(CAST(value AS DECIMAL(18,2))) FILTER (WHERE event_type = 'view') AS DOUBLE) AS "view"
FROM events GROUP BY user_id
""")
def agg_pivot(spark, d):
    """Declared pivot values: no extra job to discover them, one column per type."""
    e = read_table(spark, d, "events")
    return e.groupBy("user_id").pivot("event_type", EVENT_TYPES).agg(money_sum("value"))


@query("agg_distinct", "SELECT DISTINCT user_id, event_type FROM events")
def agg_distinct(spark, d):
    return read_table(spark, d, "events").select("user_id", "event_type").distinct()


# ---------------------------------------------------------------- 2.F windows

@query("win_rank", """
SELECT o_custkey, o_orderkey, o_totalprice,
       rank() OVER (PARTITION BY o_custkey ORDER BY o_totalprice DESC) AS price_rank
FROM orders
""")
def win_rank(spark, d):
    """Rank of each order within its customer; a customer with a huge share of orders is
    ranked in value sub-ranges rather than in one task."""
    o = read_table(spark, d, "orders").select("o_custkey", "o_orderkey", "o_totalprice")
    return rank_within(o, ["o_custkey"], "o_totalprice", "price_rank")


@query("win_row_number", """
WITH board AS (
  SELECT l_suppkey, CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) AS revenue FROM lineitem GROUP BY l_suppkey)
SELECT l_suppkey, revenue, row_number() OVER (ORDER BY revenue DESC, l_suppkey) AS position FROM board
""")
def win_row_number(spark, d):
    """Row number over a whole board, computed without a single-partition window."""
    li = read_table(spark, d, "lineitem")
    board = li.groupBy("l_suppkey").agg(money_sum("l_extendedprice").alias("revenue"))
    return global_row_number(board, "revenue", [F.col("l_suppkey").asc()], "position", descending=True)


@query("latest_run", """
SELECT user_id, event_id, ts, event_type FROM (
  SELECT user_id, event_id, ts, event_type,
         rank() OVER (PARTITION BY user_id ORDER BY ts DESC) AS r FROM events) WHERE r = 1
""")
def latest_run(spark, d):
    return latest.newest_by_rank(read_table(spark, d, "events"), ["user_id"], "ts") \
        .select("user_id", "event_id", "ts", "event_type")


# ---------------------------------------------------------------- 2.G sorts and limits

@query("sort_topn", """
SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 10
""")
def sort_topn(spark, d):
    """Top-n report (the limit is the feature): TakeOrderedAndProject, a per-partition heap."""
    return read_table(spark, d, "orders").orderBy(F.desc("o_totalprice"), "o_orderkey").limit(10) \
        .select("o_orderkey", "o_totalprice")


@query("sort_first", """
SELECT max_by(event_id, struct_pack(ts := ts, event_id := event_id)) AS last_event_id, max(ts) AS last_ts FROM events
""")
def sort_first(spark, d):
    """Newest row without sorting the table: ``max_by`` keeps one candidate per partition."""
    e = read_table(spark, d, "events")
    return e.agg(F.max_by("event_id", F.struct("ts", "event_id")).alias("last_event_id"), F.max("ts").alias("last_ts"))


@query("limit_n", "SELECT event_id, ts, event_type FROM events ORDER BY ts, event_id LIMIT 200")
def limit_n(spark, d):
    """A repeatable sample of n rows: ordered first so every run returns the same rows."""
    return read_table(spark, d, "events").orderBy("ts", "event_id").limit(200).select("event_id", "ts", "event_type")


# ---------------------------------------------------------------- 2.H set operations

@query("union_by_name", """
SELECT c_custkey AS party_id, c_name AS name, c_nationkey AS nation_id, c_acctbal AS balance,
       c_mktsegment AS segment, 'customer' AS kind FROM customer
UNION ALL
SELECT s_suppkey, s_name, s_nationkey, s_acctbal, NULL, 'supplier' FROM supplier
""")
def union_by_name(spark, d):
    c = read_table(spark, d, "customer").select(
        F.col("c_custkey").alias("party_id"), F.col("c_name").alias("name"), F.col("c_nationkey").alias("nation_id"),
        F.col("c_acctbal").alias("balance"), F.col("c_mktsegment").alias("segment"), F.lit("customer").alias("kind"))
    s = read_table(spark, d, "supplier").select(
        F.col("s_name").alias("name"), F.col("s_suppkey").alias("party_id"), F.lit("supplier").alias("kind"),
        F.col("s_acctbal").alias("balance"), F.col("s_nationkey").alias("nation_id"))
    return c.unionByName(s, allowMissingColumns=True)


# ---------------------------------------------------------------- 2.I scalar functions

@query("scalar_string", """
SELECT p_partkey,
       concat_ws('::', p_brand, p_type) AS brand_type,
       split_part(p_name, ' ', 2) AS noun,
       trim('  ' || p_name || '  ') AS trimmed,
       lower(p_brand) AS brand_lower, upper(p_name) AS name_upper, length(p_name) AS name_len,
       contains(p_type, 'ECON') AS economy
FROM part
""")
def scalar_string(spark, d):
    p = read_table(spark, d, "part")
    return p.select(
        "p_partkey",
        F.concat_ws("::", "p_brand", "p_type").alias("brand_type"),
        F.coalesce(F.element_at(F.split("p_name", " "), 2), F.lit("")).alias("noun"),
        F.trim(F.concat(F.lit("  "), F.col("p_name"), F.lit("  "))).alias("trimmed"),
        F.lower("p_brand").alias("brand_lower"), F.upper("p_name").alias("name_upper"),
        F.length("p_name").alias("name_len"), F.col("p_type").contains("ECON").alias("economy"))


@query("scalar_hash", "SELECT doc_id, sha256(text) AS text_sha FROM documents")
def scalar_hash(spark, d):
    return read_table(spark, d, "documents").select("doc_id", F.sha2("text", 256).alias("text_sha"))


@query("scalar_array", """
WITH per_user AS (
  SELECT user_id, event_id // 168 AS block, list(event_type ORDER BY ts, event_id) AS types,
         list(value ORDER BY ts, event_id) AS vals
  FROM events GROUP BY user_id, event_id // 168)
SELECT user_id, block, len(types) AS n_events, types[-1] AS last_type,
       list_slice(types, 1, 3) AS first_three,
       list_sum(list_slice(vals, 1, 3)) AS first_three_value,
       len(list_filter(types, lambda t: t = 'error')) AS n_errors,
       range(0, len(types), 10) AS starts
FROM per_user
""")
def scalar_array(spark, d):
    """Array functions over per-user event blocks (at most 168 consecutive event ids each,
    so no array grows with a heavy user)."""
    e = read_table(spark, d, "events")
    per_user = e.groupBy("user_id", F.floor(F.col("event_id") / 168).alias("block")).agg(
        F.sort_array(F.collect_list(F.struct("ts", "event_id", "event_type", "value"))).alias("seq"))
    types = F.transform("seq", lambda s: s["event_type"])
    vals = F.transform("seq", lambda s: s["value"])
    return per_user.select(
        "user_id", "block", F.size(types).alias("n_events"), F.element_at(types, -1).alias("last_type"),
        F.slice(types, 1, 3).alias("first_three"),
        F.aggregate(F.slice(vals, 1, 3), F.lit(0.0), lambda acc, x: acc + x).alias("first_three_value"),
        F.size(F.filter(types, lambda t: t == "error")).alias("n_errors"),
        F.sequence(F.lit(0), F.greatest(F.size(types) - 1, F.lit(0)), F.lit(10)).cast("array<bigint>").alias("starts"))


@query("scalar_datetime", """
SELECT o_orderkey, strftime(o_orderdate, '%Y-%m') AS order_month, CAST(o_orderdate AS DATE) AS order_day,
       hour(o_orderdate) AS order_hour, dayofweek(o_orderdate) + 1 AS order_dow,
       date_diff('minute', o_orderdate, o_orderdate + INTERVAL 90 MINUTE) AS minutes,
       epoch(o_orderdate)::BIGINT AS epoch_seconds
FROM orders
""")
def scalar_datetime(spark, d):
    o = read_table(spark, d, "orders")
    ts = F.col("o_orderdate")
    later = ts + F.expr("INTERVAL 90 MINUTES")
    return o.select(
        "o_orderkey", F.date_format(ts, "yyyy-MM").alias("order_month"), F.to_date(ts).alias("order_day"),
        F.hour(ts).alias("order_hour"), F.dayofweek(ts).alias("order_dow"),
        F.timestamp_diff("MINUTE", ts, later).alias("minutes"),
        F.unix_timestamp(ts.cast("timestamp")).alias("epoch_seconds"))


@query("scalar_math", """
SELECT l_orderkey, l_linenumber, l_extendedprice / l_quantity AS unit_price, abs(l_discount - CAST(0.05 AS DOUBLE)) AS disc_dev,
       l_orderkey % 7 AS key_mod, greatest(l_tax, l_discount) AS top_rate,
       round(ln(l_extendedprice), 6) AS log_price, sqrt(l_quantity) AS sqrt_qty,
       CAST(trunc(l_quantity / 4) AS INTEGER) AS qty_quarter
FROM lineitem
""")
def scalar_math(spark, d):
    li = read_table(spark, d, "lineitem")
    return li.select(
        "l_orderkey", "l_linenumber", (F.col("l_extendedprice") / F.col("l_quantity")).alias("unit_price"),
        F.abs(F.col("l_discount") - F.lit(0.05)).alias("disc_dev"), (F.col("l_orderkey") % 7).alias("key_mod"),
        F.greatest("l_tax", "l_discount").alias("top_rate"), F.round(F.log("l_extendedprice"), 6).alias("log_price"),
        F.sqrt("l_quantity").alias("sqrt_qty"), (F.col("l_quantity") / 4).cast("int").alias("qty_quarter"))


@query("scalar_conditional", """
SELECT o_orderkey,
       CASE WHEN o_orderstatus = 'F' THEN 'done' WHEN o_orderstatus = 'O' THEN 'open' ELSE NULL END AS state,
       o_totalprice BETWEEN 100000 AND 200000 AS mid_value,
       CAST(NULL AS VARCHAR) AS note, 'v1' AS rule_version,
       (CASE WHEN o_orderstatus = 'P' THEN NULL ELSE o_orderstatus END) IS NULL AS pending
FROM orders
""")
def scalar_conditional(spark, d):
    o = read_table(spark, d, "orders")
    state = F.when(F.col("o_orderstatus") == "F", "done").when(F.col("o_orderstatus") == "O", "open")
    return o.select(
        "o_orderkey", state.alias("state"), F.col("o_totalprice").between(100000, 200000).alias("mid_value"),
        F.lit(None).cast("string").alias("note"), F.lit("v1").alias("rule_version"),
        F.when(F.col("o_orderstatus") != "P", F.col("o_orderstatus")).isNull().alias("pending"))


# ---------------------------------------------------------------- 2.K revenue pipelines

@query("revenue_by_supplier_month", """
WITH t AS (
  SELECT l.l_orderkey AS transaction_id, o.o_custkey AS customer_id, l.l_suppkey AS seller_id,
         strftime(l.l_shipdate, '%Y-%m') AS revenue_month, l.l_quantity AS quantity, l.l_extendedprice AS total_price
  FROM lineitem l JOIN orders o ON o.o_orderkey = l.l_orderkey),
a AS (
  SELECT seller_id, revenue_month, CAST(sum(CAST(total_price AS DECIMAL(18,2))) AS DOUBLE) AS revenue,
         sum(quantity) AS items_sold, count(DISTINCT transaction_id) AS transactions,
         count(DISTINCT customer_id) AS customers
  FROM t GROUP BY seller_id, revenue_month)
SELECT a.*, s.s_name AS seller_name, s.s_nationkey AS seller_nation,
       CAST(CAST((2 * CAST(a.revenue * 100 AS BIGINT) + a.transactions) // (2 * a.transactions) AS DECIMAL(18,2)) * 0.01 AS DECIMAL(18,2)) AS avg_transaction_value
FROM a LEFT JOIN supplier s ON s.s_suppkey = a.seller_id
""")
def revenue_by_supplier_month(spark, d):
    rows, parts = revenue.sales(spark, d)
    return revenue.revenue_by_seller(revenue.with_month(rows), read_table(spark, d, "supplier"), parts)


REVENUE_BY_PART_SQL = """
WITH a AS (
  SELECT l_partkey AS product_id, strftime(l_shipdate, '%Y-%m') AS revenue_month,
         CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) AS revenue, sum(l_quantity) AS units,
         count(DISTINCT l_orderkey) AS transactions
  FROM lineitem
  GROUP BY l_partkey, strftime(l_shipdate, '%Y-%m'))
SELECT *, rank() OVER (PARTITION BY revenue_month ORDER BY revenue DESC) AS revenue_rank FROM a
"""


@query("revenue_by_part_month", REVENUE_BY_PART_SQL)
def revenue_by_part_month(spark, d):
    lines = read_table(spark, d, "lineitem").select(
        F.col("l_orderkey").alias("transaction_id"), F.col("l_partkey").alias("product_id"),
        F.col("l_shipdate").alias("sold_at"), F.col("l_quantity").alias("quantity"),
        F.col("l_extendedprice").alias("total_price"))
    return revenue.revenue_by_product(revenue.with_month(lines))
