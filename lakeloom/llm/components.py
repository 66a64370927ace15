"""Connected components of links, by alternating stars, in DataFrame operations only.

Every round hooks each node's neighbours to the least node around it; stars remain. No
neighbour list is ever built (a node's least neighbour is an aggregate, joined back), so a
node with very many links costs no task its whole list. Rounds are written to the shared
checkpoint folder, which cuts the lineage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common


def _round(links: DataFrame) -> DataFrame:
    # Large star: links both ways; every larger neighbour goes to the least node around.
    both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    large = both.where("b > a").join(least.hint("merge"), "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    # Small star: a node and its smaller neighbours go to the least of them.
    large = large.where("a <> b").distinct()
    least = large.groupBy("a").agg(F.min("b").alias("m"))
    small = large.join(least.hint("merge"), "a").select(F.explode(F.array(
        F.struct(F.col("b").alias("a"), F.col("m").alias("b")), F.struct(F.col("a"), F.col("m").alias("b")))).alias("e"))
    return small.select("e.a", "e.b").where("a <> b").distinct()


def components(links: DataFrame) -> DataFrame:
    """(node, root) of every node in ``links`` (a, b) but the roots themselves; ``root`` is the
    least node of the component. Links of a node to itself are ignored."""
    own = links.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    stars, state = common.staged(own, "links"), None
    while True:
        new = stars.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")), F.lit(0))).first()
        if state == new or new[0] == 0:
            return stars.select(F.col("a").alias("node"), F.col("b").alias("root"))
        state = new
        stars = common.staged(_round(stars), "links")
