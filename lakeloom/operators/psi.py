"""Population Stability Index, computed for many columns in one set of jobs.

Columns are unpivoted to ``(feature, value)`` rows, so one grouped aggregate
gives every column's reference deciles, one grouped count gives every
histogram, and one small join gives every PSI.

* Edges: the 10-quantiles of the *reference* (linear interpolation, like
  ``numpy.quantile``); the outer edges are -inf/+inf so out-of-range live values
  land in the end buckets instead of vanishing.
* Bucket of a value = number of interior edges ``<= value`` — the rule
  ``numpy.histogram`` applies, repeated edges included. The edges (9 numbers per
  column) become literals, so bucketing is plain codegen'd arithmetic.
* PSI = Σ (live − ref) · ln(live / ref) over bucket shares, each share floored at
  1e-6; an empty side counts as 1 row so shares stay finite.

Exact quantiles take two passes: mergeable sketches say between which values every wanted
position lies, then only the values in those brackets are counted one by one.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import landed

# Bucket count, share floor and status thresholds.
BUCKETS = 10
SHARE_FLOOR = 1e-6
PSI_WARN = 0.10
PSI_BREACH = 0.25


def unpivot(df: DataFrame, columns: list[str]) -> DataFrame:
    """Wide numeric columns → ``(feature, value)`` rows (NULL values dropped)."""
    pairs = ", ".join(f"'{c}', CAST(`{c}` AS DOUBLE)" for c in columns)
    return df.selectExpr(f"stack({len(columns)}, {pairs}) AS (feature, value)").filter(F.col("value").isNotNull())


def quantile_edges(ref_long: DataFrame, buckets: int = BUCKETS, exact: bool = True,
                   accuracy: int = 100_000) -> DataFrame:
    """One row per feature: ``edges`` = the ``buckets - 1`` interior quantile edges.

    Exact: see :func:`exact_quantiles`.
    """
    if exact:
        return exact_quantiles(ref_long, [i / buckets for i in range(1, buckets)])
    probs = F.array(*[F.lit(i / buckets) for i in range(1, buckets)])
    return ref_long.groupBy("feature").agg(
        F.percentile_approx(F.col("value"), probs, accuracy).cast("array<double>").alias("edges"))


# Size of the sketches: their rank error is below a thousandth. Rows per bracket that are counted value by value
# in one task; larger brackets are sketched again.
SKETCH_K = 4096
SLICES = 500
BRACKET_ROWS = 2_000_000


def _segment(cuts: dict[str, list[tuple[float, float]]]) -> Column:
    """Segment of a row's value: 2i + 1 inside the feature's bracket i (ends included), even between brackets."""
    out = F.lit(None).cast("int")
    for feature, brackets in cuts.items():
        number = F.lit(0)
        for low, high in brackets:
            number = number + (F.col("value") >= F.lit(low)).cast("int") + (F.col("value") > F.lit(high)).cast("int")
        out = F.when(F.col("feature") == feature, number).otherwise(out)
    return out


def _brackets(rows: list, targets: list[tuple[int, int]], slices: int, margin: int) -> list[tuple[float, float]]:
    """Brackets of one feature around all ``targets`` (pairs of neighbouring positions), from its segments in
    order with their counts and, for brackets, the values at i / slices of the ranks."""
    found, start = [], 0
    for row in rows:
        if row["grid"] is not None:
            n, grid = row["n"], row["grid"]
            for low, high in targets:
                if start <= high and low < start + n:
                    first = math.floor((low - start) / n * slices) - margin
                    last = math.ceil((high + 1 - start) / n * slices) + margin
                    found.append((grid[first] if first > 0 else row["least"],
                                  grid[last] if last < slices else row["most"]))
        start += row["n"]
    merged: list[tuple[float, float]] = []
    for low, high in sorted(found):
        if merged and low <= merged[-1][1]:
            merged[-1] = (merged[-1][0], max(high, merged[-1][1]))
        else:
            merged.append((low, high))
    return merged


def _cuts(long: DataFrame, probs: list[float], slices: int, margin: int) -> tuple[dict, dict]:
    """(brackets, wanted positions) per feature."""
    ranks = F.array(*[F.lit(i / slices) for i in range(slices + 1)])
    inside = F.when(F.col("_seg") % 2 == 1, F.col("value"))
    grid = F.when(F.col("_seg") % 2 == 1, F.kll_sketch_get_quantile_double("s", ranks))
    cuts: dict[str, list[tuple[float, float]]] = {}
    while True:
        sketched = long.withColumn("_seg", _segment(cuts) if cuts else F.lit(1)).groupBy("feature", "_seg").agg(
            F.count("*").alias("n"), F.kll_sketch_agg_double(inside, SKETCH_K).alias("s"), F.min(inside).alias("least"),
            F.max(inside).alias("most"))
        by_feature: dict[str, list] = {}
        for row in sketched.select("feature", "_seg", "n", "least", "most", grid.alias("grid")).collect():
            by_feature.setdefault(row["feature"], []).append(row)
        positions, narrower, largest = {}, {}, 0
        for feature, rows in by_feature.items():
            rows.sort(key=lambda r: r["_seg"])
            n = sum(r["n"] for r in rows)
            positions[feature] = [p * (n - 1) for p in probs]
            targets = [(math.floor(x), math.ceil(x)) for x in positions[feature]]
            narrower[feature] = _brackets(rows, targets, slices, margin)
            largest = max([largest, *[2 * (margin + 1) * r["n"] / slices for r in rows if r["grid"] is not None]])
        # A bracket of one value, however frequent, does not get narrower: it is one row when counted.
        if largest <= BRACKET_ROWS or narrower == cuts:
            return narrower, positions
        cuts = narrower


def exact_quantiles(long: DataFrame, probs: list[float], slices: int | None = None) -> DataFrame:
    """Exact linear-interpolation quantiles per feature, fully distributed, nothing cached.

    1. one KLL sketch per feature (partial sketches, merged): its values at ``i / slices`` of the ranks, a
       row of fixed size, bracket the 0-based positions ``floor``/``ceil`` of ``p·(n−1)`` with a slice to spare;
    2. rows inside the brackets are counted per distinct value, those between them per gap. The counts
       say whether every position does lie in its bracket (a sketch errs with small probability; then both
       steps are taken again with wider brackets, at last with everything inside);
    3. ``lo + (hi − lo)·frac`` per probability, gathered into one array per feature.

    Brackets with more than ``BRACKET_ROWS`` rows are sketched again first, one more pass for every
    factor of about ``slices`` in the rows. NULL and NaN values don't count. ``long`` is read twice: hand in a
    written table where it is costly.
    """
    spark = long.sparkSession
    long = long.where(F.col("value").isNotNull() & ~F.isnan("value"))
    slices = slices or SLICES
    for margin in (1, 8, 64, slices):
        cuts, positions = _cuts(long, probs, slices, margin)
        counted = _counted(long, cuts)
        if not _missed(counted, positions):
            break
    return _at_positions(counted, positions, spark)


def _counted(long: DataFrame, cuts: dict) -> DataFrame:
    """(feature, seg, value, c): rows per distinct value inside brackets, per segment (value NULL) outside."""
    seg = _segment(cuts) if cuts else F.lit(0)
    value = F.when(F.col("_seg") % 2 == 1, F.col("value"))
    return landed(long.withColumn("_seg", seg).groupBy("feature", "_seg", value.alias("value")).agg(
        F.count("*").alias("c")), "quantiles")


def _starts(counted: DataFrame) -> DataFrame:
    """(feature, seg, start, n): rows before a segment and in it; a few rows per feature."""
    before = Window.partitionBy("feature").orderBy("_seg").rowsBetween(Window.unboundedPreceding, -1)
    totals = counted.groupBy("feature", "_seg").agg(F.sum("c").alias("_n"))
    return totals.withColumn("_start", F.coalesce(F.sum("_n").over(before), F.lit(0)))


def _missed(counted: DataFrame, positions: dict[str, list[float]]) -> set[str]:
    """Features with a position outside all brackets."""
    held: dict[str, list[tuple[int, int]]] = {}
    for row in _starts(counted).where(F.col("_seg") % 2 == 1).collect():
        held.setdefault(row["feature"], []).append((row["_start"], row["_start"] + row["_n"]))
    return {feature for feature, wanted in positions.items() for x in wanted for place in (math.floor(x), math.ceil(x))
            if not any(a <= place < b for a, b in held.get(feature, []))}


def _at_positions(counted: DataFrame, positions: dict[str, list[float]], spark) -> DataFrame:
    targets = F.broadcast(spark.createDataFrame(
        [(f, i, x, place) for f, wanted in positions.items() for i, x in enumerate(wanted)
         for place in {math.floor(x), math.ceil(x)}], "feature string, pi int, pos double, place bigint"))
    inside = Window.partitionBy("feature", "_seg").orderBy("value").rowsBetween(Window.unboundedPreceding, -1)
    values = counted.where(F.col("_seg") % 2 == 1).join(F.broadcast(_starts(counted)), ["feature", "_seg"])
    first = values.withColumn("first", F.col("_start") + F.coalesce(F.sum("c").over(inside), F.lit(0)))
    hit = first.join(targets, "feature").where(
        (F.col("first") <= F.col("place")) & (F.col("place") < F.col("first") + F.col("c")))
    q = hit.groupBy("feature", "pi", "pos").agg(F.min("value").alias("lo"), F.max("value").alias("hi")).select(
        "feature", "pi", (F.col("lo") + (F.col("hi") - F.col("lo")) * (F.col("pos") - F.floor("pos"))).alias("q"))
    return q.groupBy("feature").agg(
        F.transform(F.array_sort(F.collect_list(F.struct("pi", "q"))), lambda s: s["q"]).alias("edges"))


def collect_edges(edges: DataFrame) -> dict[str, list[float]]:
    """The edges table is one row per feature (``buckets - 1`` numbers each): bounded, safe to collect."""
    return {r["feature"]: list(r["edges"]) for r in edges.collect()}


def bucket_expr(value: Column, edges: list[float]) -> Column:
    """Number of interior edges ``<= value`` as one codegen'd sum of literal comparisons."""
    expr = F.lit(0)
    for e in edges:
        expr = expr + (value >= F.lit(float(e))).cast("int")
    return F.when(value.isNotNull(), expr)


def histogram(wide: DataFrame, edges: dict[str, list[float]]) -> DataFrame:
    """``(feature, bucket, n)`` counts over fixed edges, all features in one scan."""
    pairs = ", ".join(f"'{c}', `_b_{c}`" for c in edges)
    bucketed = wide.select(*[bucket_expr(F.col(c).cast("double"), e).alias(f"_b_{c}") for c, e in edges.items()])
    long = bucketed.selectExpr(f"stack({len(edges)}, {pairs}) AS (feature, bucket)").filter(F.col("bucket").isNotNull())
    return long.groupBy("feature", "bucket").agg(F.count("*").alias("n"))


def psi_table(reference: DataFrame, live: DataFrame, columns: list[str], buckets: int = BUCKETS,
              exact: bool = True) -> DataFrame:
    """``(feature, psi)`` for every column, bucketed on the reference's quantiles."""
    spark = reference.sparkSession
    edges = collect_edges(quantile_edges(unpivot(reference, columns), buckets, exact))
    spine = spark.createDataFrame([(c, b) for c in edges for b in range(buckets)], "feature string, bucket int")
    ref_c = histogram(reference, edges).withColumnRenamed("n", "ref_n")
    live_c = histogram(live, edges).withColumnRenamed("n", "live_n")
    j = (spine.join(ref_c, ["feature", "bucket"], "left").join(live_c, ["feature", "bucket"], "left")
         .fillna(0, ["ref_n", "live_n"]))
    per_col = Window.partitionBy("feature")
    ref_share = F.greatest(F.col("ref_n") / F.greatest(F.sum("ref_n").over(per_col), F.lit(1)), F.lit(SHARE_FLOOR))
    live_share = F.greatest(F.col("live_n") / F.greatest(F.sum("live_n").over(per_col), F.lit(1)), F.lit(SHARE_FLOOR))
    shares = j.select("feature", ref_share.alias("r"), live_share.alias("c"))
    return shares.groupBy("feature").agg(F.sum((F.col("c") - F.col("r")) * F.log(F.col("c") / F.col("r"))).alias("psi"))


def status(psi):
    return (F.when(psi > PSI_BREACH, F.lit("breach")).when(psi > PSI_WARN, F.lit("warn")).otherwise(F.lit("stable")))


def drift_table(reference: DataFrame, live: DataFrame, inputs: list[str], target: str, exact: bool = True) -> DataFrame:
    """PSI per input and target column with its status."""
    t = psi_table(reference, live, [*inputs, target], exact=exact)
    kind = F.when(F.col("feature") == target, F.lit("target")).otherwise(F.lit("input"))
    return t.select("feature", kind.alias("kind"), "psi", status(F.col("psi")).alias("status"),
                    (F.col("psi") > PSI_BREACH).alias("breached"))
