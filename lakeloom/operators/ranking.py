"""Ranks and positions over groups of any size, without a window over a whole group.

Rows are dealt by ranges of (group, value) and sorted, so a group that holds a third of the rows
lies in about a third of the partitions. The dealt rows are written once with their place
(partition and row of it), which fixes the partitions. A total per partition, one small row
each, gives every partition what comes before it; the rest is counted inside a partition. The
number of partitions is the session's; nothing is collected, and results don't depend on it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import landed

_ROW_BITS = 33  # of the place that Spark numbers rows with: partition above, row below


def _dealt(df: DataFrame, order: list[Column], slices: int | None) -> DataFrame:
    """``df`` in ranges of ``order``, with ``_part`` (the number of the range) and ``_row`` (the place in it)."""
    ranges = df.repartitionByRange(slices, *order) if slices else df.repartitionByRange(*order)
    place = F.monotonically_increasing_id()
    placed = landed(ranges.sortWithinPartitions(*order).withColumn("_place", place), "ranges")
    return placed.select(
        *df.columns, F.shiftright("_place", _ROW_BITS).alias("_part"),
        F.col("_place").bitwiseAND(F.lit((1 << _ROW_BITS) - 1)).alias("_row"))


def _null_safe(left: list[str], right: list[str]) -> Column:
    same = F.lit(True)
    for a, b in zip(left, right):
        same = same & F.col(a).eqNullSafe(F.col(b))
    return same


def _directed(col: str, descending: bool) -> Column:
    return F.col(col).desc() if descending else F.col(col).asc()


def cumulative_within(df: DataFrame, by: list[str], value: str, weight: str, name: str = "cum_before",
                      descending: bool = False, slices: int | None = None) -> DataFrame:
    """Sum of ``weight`` over rows of the same group with a strictly earlier ``value``.

    ``value`` must be unique within a group (a table of distinct values with counts). Group
    keys may be NULL. NULL values come first ascending, last descending.
    """
    dealt = _dealt(df, [*[F.col(b) for b in by], _directed(value, descending)], slices)
    keys = [*by, "_part"]
    sums = dealt.groupBy(*keys).agg(F.sum(weight).alias("_s"))
    before = Window.partitionBy(*by).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    names = [f"_o{i}" for i in range(len(keys))]
    offsets = sums.select(*[F.col(k).alias(n) for k, n in zip(keys, names)],
                          F.coalesce(F.sum("_s").over(before), F.lit(0)).alias("_offset"))
    inside = Window.partitionBy(*keys).orderBy("_row").rowsBetween(Window.unboundedPreceding, -1)
    local = dealt.withColumn("_local", F.coalesce(F.sum(weight).over(inside), F.lit(0)))
    return local.join(offsets, _null_safe(keys, names)).withColumn(
        name, F.col("_offset") + F.col("_local")).drop("_part", "_row", "_local", "_offset", *names)


def rank_within(df: DataFrame, by: list[str], value: str, name: str = "rank", descending: bool = True,
                slices: int | None = None) -> DataFrame:
    """``rank()`` within ``by`` ordered by ``value``: one plus the rows with a better value.

    Rows are first counted per distinct value (a partial aggregate, so a value that fills
    much of a group is one row), the counts are summed up, and the rank is joined back. ``df`` is
    read twice: hand in a written table where it is costly.
    """
    counts = df.groupBy(*by, value).agg(F.count("*").alias("_n"))
    ranked = cumulative_within(counts, by, value, "_n", "_before", descending, slices)
    keys = [*by, value]
    names = [f"_k{i}" for i in range(len(keys))]
    ranks = ranked.select(*[F.col(k).alias(n) for k, n in zip(keys, names)], (F.col("_before") + 1).cast("int").alias(name))
    return df.join(ranks, _null_safe(keys, names)).drop(*names)


def global_row_number(df: DataFrame, lead: str, rest: list[Column], name: str = "row_number",
                      descending: bool = False, slices: int | None = None) -> DataFrame:
    """Append ``name`` = 1-based position of each row ordered by ``lead``, then ``rest``.

    With ``rest`` the order must be total (end it with a unique column) for the numbering to be
    repeatable. Rows that tie on ``lead`` may lie in several partitions.
    """
    dealt = _dealt(df, [_directed(lead, descending), *rest], slices)
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    # One row per partition of the shuffle, whose number is a setting.
    offsets = F.broadcast(dealt.groupBy("_part").agg(F.count("*").alias("_n")).select(
        "_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset")))
    return dealt.join(offsets, "_part").withColumn(
        name, F.col("_offset") + F.col("_row") + 1).drop("_part", "_row", "_offset")
