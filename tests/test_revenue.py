"""Revenue per seller and month: the parts grow with the lines, and rows don't depend on them."""

import datetime as dt

from lakeloom.operators import revenue


def tables(spark, path):
    day = dt.datetime(2024, 1, 5)
    lines = [(i % 40, i % 3, i % 7, day + dt.timedelta(days=i % 60), float(i % 5), 1.0 + i) for i in range(400)]
    lines += [(41, 1, 1, None, 2.0, 3.0), (42, None, 1, day, 2.0, 3.0), (99, 1, 1, day, 9.0, 9.0)]
    spark.createDataFrame(lines, "l_orderkey long, l_suppkey long, l_partkey long, l_shipdate timestamp_ntz, l_quantity double, "
                          "l_extendedprice double").write.parquet(f"{path}/lineitem.parquet")
    orders = [(i, None if i % 11 == 0 else i % 6) for i in range(43)]
    spark.createDataFrame(orders, "o_orderkey long, o_custkey long").write.parquet(f"{path}/orders.parquet")
    return spark.createDataFrame([(0, "a", 1), (1, "b", 2)], "s_suppkey long, s_name string, s_nationkey int")


def test_parts_grow_with_the_lines(spark, tmp_path, monkeypatch):
    sellers = tables(spark, str(tmp_path))
    rows, parts = revenue.sales(spark, str(tmp_path))
    plain = revenue.revenue_by_seller(revenue.with_month(rows), sellers, parts)
    want = sorted(map(str, plain.collect()))
    bought = {}
    for r in revenue.with_month(rows).collect():
        bought.setdefault((r["seller_id"], r["revenue_month"]), []).append(r)
    assert {(r["seller_id"], r["revenue_month"]): (r["transactions"], r["customers"]) for r in plain.collect()} == {
        k: (len({r["transaction_id"] for r in v}), len({r["customer_id"] for r in v} - {None})) for k, v in bought.items()}
    monkeypatch.setattr(revenue, "BYTES_PER_PART", 100)
    rows, many = revenue.sales(spark, str(tmp_path))
    assert many > 8 >= parts
    dealt = revenue.revenue_by_seller(revenue.with_month(rows), sellers, many)
    assert sorted(map(str, dealt.collect())) == want
    assert dealt._jdf.queryExecution().executedPlan().toString().count(f", {many})") >= 3
