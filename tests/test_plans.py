"""Plan checks: pushdown, pruning, broadcast guards, no Python in native operators."""

from pyspark.sql import functions as F

from lakeloom.catalog import queries
from lakeloom.plans import broadcast_if_small, estimated_bytes, has_broadcast, pushed_filters, read_schema
from tests.conftest import SF_SMALL


def test_range_filter_pushed_and_columns_pruned(spark):
    df = queries()["filter_range"](spark, SF_SMALL)
    assert any("l_shipdate" in f for f in pushed_filters(df))
    schema = read_schema(df)[0]
    assert "l_orderkey" in schema and "l_comment" not in schema and "l_tax" not in schema


def test_dimension_broadcast_only_when_small(spark):
    df = queries()["join_broadcast_left"](spark, SF_SMALL)
    assert has_broadcast(df)
    big = spark.range(0, 10)
    assert estimated_bytes(big) > 0
    assert broadcast_if_small(big, max_bytes=1) is big


def test_split_scan_prunes_partitions(spark):
    df = queries()["split_scan"](spark, SF_SMALL)
    from lakeloom.plans import plan_text
    assert "PartitionFilters: [isnotnull(split" in plan_text(df)


def test_topk_keeps_group_limit(spark):
    from lakeloom.plans import plan_text
    txt = plan_text(queries()["topk_cosine"](spark, SF_SMALL))
    assert "MapInPandas" in txt and "CartesianProduct" not in txt and "BroadcastNestedLoopJoin" not in txt


def test_jdbc_partitioned_read_keeps_all_rows(spark):
    import pytest

    from lakeloom.sources import jdbc

    df = spark.range(0, 200).selectExpr("id AS k", "CAST(id AS DOUBLE) AS v")
    url = jdbc.derby_copy(spark, {"T": df})
    got = jdbc.read_partitioned(spark, url, "T", "K", lower=50, upper=60, partitions=4)
    assert jdbc.read_parallelism(got) == 4
    assert got.count() == 200  # bounds cut ranges, they do not filter
    with pytest.raises(ValueError):
        jdbc.read_partitioned(spark, url, "T", "K", lower=None, upper=60, partitions=4)
    pushed = jdbc.read_query(spark, url, "SELECT K FROM T WHERE K < 10")
    assert pushed.count() == 10
