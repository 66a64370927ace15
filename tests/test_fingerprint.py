from pyspark.sql import functions as F

from lakeloom.operators import fingerprint


def fp(df):
    return fingerprint.fingerprint(df).first()["fingerprint"]


def test_layout_and_order_free(spark):
    df = spark.range(0, 1000).select(F.col("id"), (F.col("id") % 7).cast("string").alias("s"))
    assert fp(df) == fp(df.repartition(13).orderBy(F.desc("id")))
    assert fingerprint.layout_check(df).first()["n_distinct"] == 1


def test_duplicates_and_types_change_fingerprint(spark):
    a = spark.createDataFrame([(1, "x"), (2, "y")], "k long, v string")
    dup = spark.createDataFrame([(1, "x"), (2, "y"), (2, "y"), (2, "y")], "k long, v string")
    assert fp(a) != fp(dup)
    as_int = spark.createDataFrame([(1, "x"), (2, "y")], "k int, v string")
    assert fp(a) != fp(as_int)
    nulls = spark.createDataFrame([(1, None)], "k long, v string")
    assert fingerprint.fingerprint(nulls).first()["n_rows"] == 1


def test_numbers_are_told_apart_at_any_size_and_depth(spark):
    values = ["1e-12D", "2e-12D", "1e30D", "1.0000000000000002e30D", "double('NaN')", "double('Infinity')", "-double('Infinity')",
              "0.1D", "0.10000000000000002D", "0D", "cast(null as double)", "711.56D", "4.9e-324D", "1e16D", "1.0000000000000002e16D"]
    shapes = ["{}", "array(1D, {})", "named_struct('b', {}, 'a', 1)", "map('k', {})", "array(named_struct('m', map(1, array({}))))"]
    for shape in shapes:
        prints = {fp(spark.sql(f"SELECT 1 AS id, {shape.format(v)} AS v")) for v in values}
        assert len(prints) == len(values), shape
    assert fp(spark.sql("SELECT -0.0D AS v")) == fp(spark.sql("SELECT 0.0D AS v"))
    floats = {fp(spark.sql(f"SELECT float('{v}') AS v")) for v in ("0.1", "0.10000001", "1e-12", "2e-12", "3e38", "NaN")}
    assert len(floats) == 6


def test_order_of_map_entries_does_not_count(spark):
    a = spark.sql("SELECT map('x', 1D, 'y', 2D) AS m, named_struct('p', 1, 'q', cast(null as int)) AS s")
    b = spark.sql("SELECT map('y', 2D, 'x', 1D) AS m, named_struct('p', 1, 'q', cast(null as int)) AS s")
    c = spark.sql("SELECT map('x', 2D, 'y', 1D) AS m, named_struct('p', 1, 'q', cast(null as int)) AS s")
    assert fp(a) == fp(b) != fp(c)
    nothing = spark.sql("SELECT cast(null as map<string,double>) AS m, cast(null as struct<p:int,q:int>) AS s")
    assert len({fp(nothing), fp(a)}) == 2
    assert fingerprint.layout_check(a.union(c).union(nothing).withColumn("id", F.monotonically_increasing_id()).drop("m")).first()[
        "n_distinct"] == 1
