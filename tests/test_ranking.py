from pyspark.sql import Window
from pyspark.sql import functions as F

from lakeloom.operators.ranking import cumulative_within, global_row_number, rank_within


def test_global_row_number_matches_window(spark):
    df = spark.range(0, 5000).select(
        F.when(F.col("id") % 50 > 0, F.col("id") * 7919 % 101).alias("score"), "id", F.lit("payload").alias("p"))
    for down in (True, False):
        lead = F.col("score").desc() if down else F.col("score").asc()
        want = df.withColumn("pos", F.row_number().over(Window.orderBy(lead, F.col("id")))).collect()
        got = global_row_number(df, "score", [F.col("id").asc()], "pos", descending=down, slices=7).collect()
        assert {r["id"]: r["pos"] for r in got} == {r["id"]: r["pos"] for r in want}


def test_positions_are_gapless_with_payload_columns(spark):
    n = 3_000_000
    df = spark.range(n).select((F.col("id") * 7919 % 1_000_003).alias("score"), "id", F.md5(F.col("id").cast("string")).alias("p"))
    pos = global_row_number(df, "score", [F.col("id").asc()], "pos", descending=True)
    row = pos.agg(F.min("pos"), F.max("pos"), F.count_distinct("pos")).first()
    assert tuple(row) == (1, n, n)


def test_rank_within_splits_hot_groups_exactly(spark):
    # group 0 is hot; many ties; a NULL group and NULL values
    df = spark.range(0, 6000).select(
        F.when(F.col("id") % 11 > 0, (F.col("id") % 7 == 1).cast("int")).alias("g"), "id",
        F.when(F.col("id") % 13 > 0, (F.col("id") * 7919 % 113).cast("double")).alias("v"))
    for down in (True, False):
        w = Window.partitionBy("g").orderBy(F.col("v").desc() if down else F.col("v").asc())
        want = {r["id"]: r["r"] for r in df.withColumn("r", F.rank().over(w)).collect()}
        got = {r["id"]: r["r"] for r in rank_within(df, ["g"], "v", "r", descending=down, slices=16).collect()}
        assert got == want


def test_cumulative_within_counts_smaller_values(spark):
    df = spark.range(0, 900).select((F.col("id") % 2).alias("g"), F.col("id").cast("double").alias("v"), F.lit(2).alias("c"))
    got = cumulative_within(df, ["g"], "v", "c", "before", slices=9).collect()
    assert all(r["before"] == 2 * (int(r["v"]) // 2) for r in got)


def test_ranges_split_ties_and_hot_groups(spark):
    # one value fills half of the rows, one group nine tenths of them
    df = spark.range(4000).select(
        (F.col("id") % 10 == 0).cast("int").alias("g"), "id", F.when(F.col("id") % 2 > 0, F.col("id") % 97).otherwise(5).alias("v"))
    numbered = global_row_number(df, "v", [F.col("id").asc()], "pos", slices=13)
    want = df.withColumn("pos", F.row_number().over(Window.orderBy("v", "id")))
    assert {r["id"]: r["pos"] for r in numbered.collect()} == {r["id"]: r["pos"] for r in want.collect()}
    ranked = {r["id"]: r["rank"] for r in rank_within(df, ["g"], "v", slices=13).collect()}
    want = df.withColumn("rank", F.rank().over(Window.partitionBy("g").orderBy(F.col("v").desc())))
    assert ranked == {r["id"]: r["rank"] for r in want.collect()}


def test_text_values_and_empty_tables(spark):
    df = spark.createDataFrame([("a", 1), ("b", 2), (None, 3)], "v string, id long")
    assert {r["id"]: r["row_number"] for r in global_row_number(df, "v", [F.col("id").asc()]).collect()} == {3: 1, 1: 2, 2: 3}
    assert global_row_number(df.where("false"), "v", []).count() == 0
    assert rank_within(df.where("false"), ["id"], "v").count() == 0
