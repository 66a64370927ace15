"""Repeatable splits decided by a hash of each row's own values (no RNG, no seed)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..functions.hashing import murmur_bucket, sha_bucket

# Split shares in percent.
THREE_WAY = (("train", 70), ("test", 15), ("score", 15))
TWO_WAY = (("train", 80), ("test", 20))


def split_label(cols: list[Column], shares=THREE_WAY, hash_kind: str = "sha") -> Column:
    """Label from a bucket in [0, 100): cumulative shares in order."""
    if sum(p for _, p in shares) != 100:
        raise ValueError("shares must add to 100")
    bucket = sha_bucket(*cols, buckets=100) if hash_kind == "sha" else murmur_bucket(*cols, buckets=100)
    expr, upto = None, 0
    for name, pct in shares[:-1]:
        upto += pct
        expr = F.when(bucket < upto, F.lit(name)) if expr is None else expr.when(bucket < upto, F.lit(name))
    return expr.otherwise(F.lit(shares[-1][0]))
