"""Seeded orders and running sums that no hot key can pile into one task.

The order inside a group is that of a seeded digest of the row, so its leading hex digits
cut every group into slices of equal expected size. Slice totals (one small row per group
and slice) are summed up first; each slice is then numbered on its own and shifted by the
total of the slices before it. The slices only lay out the work: results don't depend on
their number.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

SLICE_DIGITS = 3


def digest(seed: int | str, *parts: Column) -> Column:
    """A seeded md5 of the parts; nulls count as the empty string."""
    texts = [F.coalesce(p.cast("string"), F.lit("")) for p in parts]
    return F.md5(F.concat_ws("|", F.lit(str(seed)), *texts).cast("binary"))


def fraction(digest_col: Column) -> Column:
    """A digest as a number in [0, 1) with 32 bits."""
    return F.conv(F.substring(digest_col, 1, 8), 16, 10).cast("double") / F.lit(4294967296.0)


def running_before(df: DataFrame, group: list[str], slice_col: str, order: list[Column], value: Column,
                   before: str, total: str) -> DataFrame:
    """Add ``before``, the sum of ``value`` over the rows of the same group that come earlier
    (by ``slice_col``, then ``order``), and ``total``, the sum over the whole group.

    ``group`` columns may be null. ``value`` is a whole number; ``order`` must tell rows
    apart, up to rows that are equal anyway.
    """
    v, own = "__value", df.withColumn("__value", value.cast("long"))
    names = [f"__g{i}" for i in range(len(group))] + ["__slice"]
    totals = own.groupBy(*[F.col(g).alias(n) for g, n in zip([*group, slice_col], names)]).agg(
        F.sum(v).alias("__sum"))
    by_group = Window.partitionBy(*names[:-1]) if group else Window.partitionBy(F.lit(0))
    offsets = totals.select(
        *names,
        (F.sum("__sum").over(by_group.orderBy("__slice")) - F.col("__sum")).alias("__offset"),
        F.sum("__sum").over(by_group).alias(total))
    if not group:  # at most one row per slice: 16 ** SLICE_DIGITS
        offsets = F.broadcast(offsets)
    within = Window.partitionBy(*group, slice_col).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    numbered = own.withColumn("__before", F.coalesce(F.sum(v).over(within), F.lit(0)))
    same = F.lit(True)
    for own_name, other in zip([*group, slice_col], names):
        same = same & F.col(own_name).eqNullSafe(F.col(other))
    return numbered.join(offsets, same).withColumn(before, F.col("__before") + F.col("__offset")).drop(
        *names, v, "__before", "__offset")
